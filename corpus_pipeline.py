"""The corpus pipeline: documents in, packed training sequences out.

Every stage takes what the one before it kept, written as Parquet, and its decisions take effect.
All but the last return the columns of ``documents``; ids may be null or repeated and further
columns are passed on. Empty tables pass through all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewake.llm import decontaminate, line_dedup, minhash_forest, packing, toxicity
from tradewake.llm.common import Stage, free_name


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose toxicity score is 0.5 or more. Ids whose crc32 modulo 5 is 0 are
    held out of training."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, model, threshold=0.5)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without later copies of repeated line runs of 8 words or more; a document of which nothing is
    left goes. ``n_chars`` follows the text."""
    out = line_dedup.dedup_lines(docs, min_lines=1, min_words=8)
    deleted, left = (F.col(free_name(docs, c)) for c in ("__deleted", "__left"))
    kept = out.where((deleted == 0) | (left > 0))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.when(deleted > 0, F.length("text"))
                               .otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return kept.select(*(f"`{c}`" for c in docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the least id; documents without
    an id come last. Every row counts by a key of its own, in the order of the ids."""
    key = free_name(docs, "__key")
    keyed = Stage(spark, "near").save(
        docs.orderBy(F.col("doc_id").asc_nulls_last(), F.xxhash64("text"))
        .withColumn(key, F.monotonically_increasing_id()))
    gone = minhash_forest.near_duplicates(
        keyed.select(F.col(key).alias("doc_id"), "text"), words=5, percent=80).where("not kept")
    return keyed.join(gone.select(F.col("doc_id").alias(key)), key, "left_anti").select(
        *(f"`{c}`" for c in docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold an item of the benchmark."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their place in sequences of at most 4096 tokens, chosen by
    what is left of tokens, documents and attention cost."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1,
                                  capacity=packing.Capacity(weights=(1.0, 0.25, 0.25)))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("minhash_near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: SQL can't express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written and read again."""
    stage = Stage(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, step in STAGES[:-1]:
        docs = stage.save(step(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
