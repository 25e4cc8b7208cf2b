"""Importance resampling towards a target: hashed n-gram buckets, log ratios, Gumbel top-k.

A text's features are its runs of one to three words. Each falls into the bucket of its CRC-32,
and a bucket's gain is the log ratio of its share in the target to its share in the corpus. The
sum of gains plus Gumbel noise ranks the documents; the highest are a sample without replacement.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stage, in_batches, only
from .running import running
from .spans import span_crcs

# Bytes of words: digits, a-z once A-Z are in lower case, and everything beyond ASCII.
_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32

#: Bytes of text hashed at a time; a word that is longer is taken whole.
PIECE = 1 << 17


def _words(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words of ``data`` start and end; none goes over a position of ``breaks``."""
    word = _WORD[data]
    fresh, last = word.copy(), word.copy()
    fresh[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    inner = breaks[(breaks > 0) & (breaks < len(data))]
    fresh[inner] = word[inner]
    last[inner - 1] = word[inner - 1]
    return np.flatnonzero(fresh), np.flatnonzero(last) + 1


def feature_crcs(data: np.ndarray, offsets: np.ndarray, longest: int = 3
                 ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """CRC-32 of the features of several texts, piece by piece.

    ``data`` holds the texts' bytes and ``offsets`` where each starts, with the end last. Yields
    the number of the text of every feature and its CRC; pieces are of bounded size and a
    feature that crosses two of them counts with the later.
    """
    starts, ends = _words(data, offsets)
    if not len(starts):
        return
    text = np.searchsorted(offsets, starts, side="right") - 1
    upto = np.cumsum(ends - starts + 1)
    first = 0
    while first < len(starts):
        before = int(upto[first - 1]) if first else 0
        stop = max(first + 1, int(np.searchsorted(upto, before + PIECE, side="right")))
        lead = min(first, longest - 1)  # words that features from here on may begin with
        a, b, t = (x[first - lead:stop] for x in (starts, ends, text))
        # The words again, with one space behind each.
        length = b - a
        at = np.cumsum(length + 1) - length - 1
        joined = np.full(int(at[-1] + length[-1] + 1), 0x20, dtype=np.uint8)
        flat = np.arange(int(length.sum()))
        own = np.cumsum(length) - length
        joined[flat + np.repeat(at - own, length)] = _LOWER[data[flat + np.repeat(a - own, length)]]
        for n in range(1, min(longest, len(a)) + 1):
            tail = np.arange(max(lead, n - 1), len(a))
            tail = tail[t[tail] == t[tail - n + 1]]
            if len(tail):
                yield t[tail], span_crcs(joined, at[tail - n + 1], at[tail] + length[tail])
        first = stop


def _column(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; null counts as empty."""
    raw = [b"" if x is None else x.encode("utf-8", "surrogatepass")
           for x in batch.column(name).to_pylist()]
    return (np.frombuffer(b"".join(raw), dtype=np.uint8),
            np.concatenate(([0], np.cumsum([len(x) for x in raw], dtype=np.int64))))


def _counted(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Features per bucket of all texts of a task."""
    total = np.zeros(buckets, dtype=np.int64)
    for batch in batches:
        for _, crcs in feature_crcs(*_column(batch, "text")):
            total += np.bincount(crcs % np.uint32(buckets), minlength=buckets)
    found = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(total[found])],
                                     names=["bucket", "n"])


def bucket_counts(texts: DataFrame, buckets: int) -> np.ndarray:
    """Features of all texts by bucket; a task sends one number per bucket."""
    rows = only(texts, "text").mapInArrow(partial(_counted, buckets=buckets),
                                          "bucket long, n long").groupBy("bucket").agg(F.sum("n"))
    out = np.zeros(buckets, dtype=np.int64)
    for bucket, n in rows.collect():  # as many rows as buckets at most
        out[bucket] = n
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares, per bucket."""
    every, wanted, n = float(corpus.sum()), float(target.sum()), len(corpus)
    return np.array([
        math.floor(1000 * math.log((float(t) + 1) * (every + n) / ((float(s) + 1) * (wanted + n))))
        for s, t in zip(corpus.tolist(), target.tolist())], dtype=np.int64)


def gumbel(doc_id: int | None, seed: int) -> int:
    """Thousandths of the noise of a document, from a hash of its id; null counts as no text."""
    text = f"{seed}:{'' if doc_id is None else doc_id}".encode()
    h = int(hashlib.sha256(text).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


_SCORED = pa.schema([("doc_id", pa.int64()), ("n_features", pa.int64()), ("n_words", pa.int64()),
                     ("weight", pa.int64()), ("score", pa.int64())])


def _scored(batches: Iterator[pa.RecordBatch], gains: np.ndarray, seed: int
            ) -> Iterator[pa.RecordBatch]:
    def rows():
        for batch in batches:
            data, offsets = _column(batch, "text")
            n = batch.num_rows
            weight, count = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
            for text, crcs in feature_crcs(data, offsets):
                gain = gains[crcs % np.uint32(len(gains))]
                # Texts come in order, so those of a piece are runs.
                runs = np.flatnonzero(np.diff(text, prepend=-1))
                weight[text[runs]] += np.add.reduceat(gain, runs)
                count += np.bincount(text, minlength=n)
            # n words have n, n - 1 and n - 2 runs of one, two and three words.
            words = np.where(count > 2, count // 3 + 1, (count + 1) // 2)
            for doc_id, f, w, g in zip(batch.column("doc_id").to_pylist(), count.tolist(),
                                       words.tolist(), weight.tolist()):
                yield doc_id, f, w, g, g + gumbel(doc_id, seed)
    return in_batches(_SCORED, rows())


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20,
             buckets: int = 10_000, seed: int = 42) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every row of ``docs``; both tables have a
    ``text``.

    Of the documents with at least ``least_words`` words, ``percent`` percent with the highest
    scores have a rank from 1 on, ties to the smaller id; the others' is null. Null and empty
    texts have no features and weight 0. Rows that repeat are rows of their own and have ranks
    of their own; a null ``doc_id`` counts as an id without digits and comes last among ties. An
    empty target leaves the corpus' own shares to rank by; an empty table gives an empty table.
    Other columns are ignored.
    """
    stage = Stage(docs.sparkSession, "resampling")
    gains = bucket_gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        partial(_scored, gains=gains, seed=seed),
        "doc_id long, n_features long, n_words long, weight long, score long")
    scored = stage.save(scored.select(
        "*", (F.col("n_words") < least_words).alias("short"),
        F.monotonically_increasing_id().alias("row"), F.lit(1).cast("long").alias("one")))
    drawn = scored.where("not short").count() * percent // 100
    ranked = running(scored, ["short", F.desc("score"), F.asc_nulls_last("doc_id"), "row"],
                     ["one"], stage)
    return ranked.select(
        "doc_id", "n_features", "weight", "score",
        F.when(F.col("before_one") < drawn, F.col("before_one") + 1).alias("rank"))


def drawn_documents(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose id is drawn, all their columns; ids are expected to be unique
    and not null."""
    ids = resample(docs, target, **options).where("rank is not null").select("doc_id")
    return docs.join(ids, "doc_id", "left_semi")
