"""Helpers the operators share: staged tables, word hashes, Arrow columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewake.session import shared_dir

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_MUL = np.uint64(0x9E3779B97F4A7C15)


class Stage:
    """Intermediate tables of one run, as Parquet below the cluster's shared folder.

    ``spark.checkpoint.dir`` names the folder; where it is unset, a session on this machine alone
    uses a local one, and on a cluster that is an error. A written table cuts the lineage, so a lost executor
    costs one step.
    """

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark = spark
        self.path = shared_dir(spark, purpose)
        self.count = 0
        # Batches between the JVM and Python are small, whatever the length of the texts.
        for key, most in (("maxRecordsPerBatch", 2000), ("maxBytesPerBatch", 8 << 20)):
            key = f"spark.sql.execution.arrow.{key}"
            now = spark.conf.get(key).rstrip("b")
            if not now.isdigit() or int(now) > most or int(now) == 0:
                spark.conf.set(key, most)

    def save(self, df: DataFrame) -> DataFrame:
        self.count += 1
        place = f"{self.path}/{self.count}"
        df.write.parquet(place)
        out = self.spark.read.schema(df.schema).parquet(place)
        out._stage_place = place
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete saved tables that no later step reads."""
        jvm = self.spark._jvm
        for table in tables:
            path = jvm.org.apache.hadoop.fs.Path(table._stage_place)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over all 64 output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_POWERS = np.ones(1, dtype=np.uint64)


def _powers(n: int) -> np.ndarray:
    """Powers of an odd number modulo 2**64; grown to the longest text of the worker."""
    global _POWERS
    if len(_POWERS) < n:
        grown = np.full(max(n, 2 * len(_POWERS), 4096), _MUL)
        grown[0] = 1
        _POWERS = np.multiply.accumulate(grown)
    return _POWERS


def word_hashes(raw: bytes, between: np.ndarray = _SPACE) -> np.ndarray:
    """64-bit hash of every word of ``raw``, in order: runs of bytes that aren't ``between``.

    By default words are ``[^\\x20\\x09-\\x0D]+``.
    """
    if not raw:
        return np.zeros(0, dtype=np.uint64)
    data = np.frombuffer(raw, dtype=np.uint8)
    word = ~between[data]
    edge = np.diff(np.concatenate(([0], word.view(np.int8), [0])))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    # A polynomial from each word's own start: position within the word, then a sum per word.
    lengths = ends - starts
    flat = data[word].astype(np.uint64)
    first = np.cumsum(lengths) - lengths
    within = np.arange(len(flat)) - np.repeat(first, lengths)
    flat = (flat + np.uint64(1)) * _powers(int(lengths.max()))[within]
    return mix(np.add.reduceat(flat, first) + lengths.astype(np.uint64) * _MUL)


def shingle_set(raw: bytes, size: int) -> np.ndarray:
    """Sorted distinct hashes of the ``size``-word shingles; a shorter text is one shingle."""
    words = word_hashes(raw)
    if not len(words):
        return words
    if len(words) < size:
        key = np.array([len(words)], dtype=np.uint64)
        for k in range(len(words)):
            key = mix(key * _MUL + words[k:k + 1])
        return key
    n = len(words) - size + 1
    key = np.full(n, np.uint64(size))
    for k in range(size):
        key = mix(key * _MUL + words[k:k + n])
    return np.unique(key)


def lower_ascii(text: str | None) -> bytes:
    """UTF-8 of a text with A-Z in lower case; null counts as empty."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass").lower()


def rows_of(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """Rows of Arrow batches as tuples of Python values."""
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in names))


def emit(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)


def in_batches(schema: pa.Schema, rows: Iterator[tuple], most: int = 4096,
               most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Rows in batches of bounded count and size."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, (bytes, str, list)))
        if len(held) >= most or size >= most_bytes:
            yield emit(schema, held)
            held, size = [], 0
    if held:
        yield emit(schema, held)


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns of a table that may have others, in other order."""
    return df.select(*(F.col(f"`{n}`") for n in names))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of the table has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
