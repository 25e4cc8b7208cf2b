"""One query per operator over the given tables, with production parameters, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import divergence, language, licenses, mixing
from .decontaminate import contaminated
from .line_dedup import dedup_lines
from .minhash_forest import near_duplicates
from .nn_descent import near_vectors
from .packing import Capacity, pack_documents
from .resampling import resample
from .toxicity import fit, score
from .wavelet import round_trip
from .wrappers import extract

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(n: int):
    """crc32 of the id as text, modulo ``n``."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the later copies of repeated runs of lines."""
    return dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "text", F.col("__deleted").cast("long").alias("n_deleted"))


def op2_wrapper_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page, by the wrapper of its host."""
    return extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op3_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors of the whole table, cosine 0.9."""
    return near_vectors(table(spark, sf_dir, "embeddings"), at_least=0.9)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in any document, with their least edit distance and place."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")) \
        .select("doc_id", "item_id", "n_words", "n_edits", "start", "end")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; ids whose crc32 modulo 4 is 2 are held out of training."""
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, language.fit(docs, modulus=4, rest=2))
    return found.select("doc_id", crc_mod(4).eqNullSafe(2).alias("held_out"), "lang_pred", "score",
                        "rejected")


def op6_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token ids in wavelet-matrix shards, read back from the files."""
    return round_trip(table(spark, sf_dir, "documents"), TOKENIZER)


def op7_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents, 4-word shingles, similarity 0.8."""
    return near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=80)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; ids whose crc32 modulo 5 is 0 are held out of training."""
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels"), modulus=5, rest=0))
    return scored.select("doc_id", crc_mod(5).eqNullSafe(0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences named in any document, by sentence rules."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def op10_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens, chosen by how near tokens,
    documents and attention cost together come to full."""
    return pack_documents(table(spark, sf_dir, "documents"), TOKENIZER,
                          capacity=Capacity(weights=(1.0, 0.25, 0.25)))


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to 150 % of their words, sources weighing 3, 1, 2 in turn."""
    return mixing.plan_mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored towards the benchmark, 5 % of those with 20 words and more drawn."""
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source of every language against the others, and the terms that mark it."""
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_wrapper_extraction": op2_wrapper_extraction,
    "op3_nn_descent": op3_nn_descent,
    "op4_decontamination": op4_decontamination,
    "op5_language_id": op5_language_id,
    "op6_wavelet_tokens": op6_wavelet_tokens,
    "op7_minhash_forest": op7_minhash_forest,
    "op8_toxicity": op8_toxicity,
    "op9_license_scan": op9_license_scan,
    "op10_vector_packing": op10_vector_packing,
    "op11_mixing": op11_mixing,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_source_divergence": op13_source_divergence,
}

ORACLES = {
    "op9_license_scan": licenses.oracle(),
    "op11_mixing": mixing.oracle(),
    "op13_source_divergence": divergence.oracle(),
}
