"""Token ids in wavelet matrices: one file per shard, bit-planes with rank and select.

A wavelet matrix holds ids as one bit-plane per bit of the vocabulary, from the highest bit down;
every plane is followed by a stable partition of the ids into zeros and ones. With the counts of
ones at every 512 bits, a token is read, a symbol counted or its k-th place found in one step per
plane, without decoding the rest.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Stage, emit, in_batches, rows_of
from .tokens import encoded

STEP = 512


@dataclass
class WaveletMatrix:
    """``planes``: packed bits, lowest bit first, each padded to a multiple of 512 bits."""

    n: int
    bits: int
    planes: list[np.ndarray]
    zeros: list[int]
    ones: list[np.ndarray]

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        ids = np.asarray(ids, dtype=np.uint16 if bits <= 16 else np.uint32)
        n = len(ids)
        planes, zeros, ones = [], [], []
        size = -(-n // STEP) * STEP // 8
        for k in range(bits - 1, -1, -1):
            bit = (ids & ids.dtype.type(1 << k)) != 0
            plane = np.zeros(size, dtype=np.uint8)
            packed = np.packbits(bit, bitorder="little")
            plane[:len(packed)] = packed
            # Places first: picking by a mask of mixed bits costs several times as much.
            low, high = ids.take(np.flatnonzero(~bit)), ids.take(np.flatnonzero(bit))
            ids = np.concatenate([low, high])
            planes.append(plane)
            zeros.append(len(low))
            counts = np.bitwise_count(plane.view(np.uint64)).reshape(-1, STEP // 64).sum(axis=1)
            ones.append(np.concatenate(([0], np.cumsum(counts))).astype("<u4"))
        return cls(n, bits, planes, zeros, ones)

    def _bit(self, plane: int, at: np.ndarray) -> np.ndarray:
        return (self.planes[plane][at >> 3] >> (at & 7).astype(np.uint8)) & 1

    def _rank1(self, plane: int, at: np.ndarray) -> np.ndarray:
        """Ones before each place, from the directory and the words after it."""
        words = self.planes[plane].view(np.uint64)
        total = self.ones[plane][at // STEP].astype(np.int64)
        word = at // 64
        start = at // STEP * (STEP // 64)
        for k in range(STEP // 64):
            use = start + k < word
            if use.any():
                total[use] += np.bitwise_count(words[(start + k)[use]])
        rest = (at % 64).astype(np.uint64)
        use = rest > 0
        if use.any():
            mask = (np.uint64(1) << rest[use]) - np.uint64(1)
            total[use] += np.bitwise_count(words[word[use]] & mask)
        return total

    def access(self, at) -> np.ndarray:
        """Ids at the places ``at``."""
        at = np.array(at, dtype=np.int64, ndmin=1)
        out = np.zeros(len(at), dtype=np.int64)
        for p in range(self.bits):
            bit = self._bit(p, at).astype(bool)
            ones = self._rank1(p, at)
            at = np.where(bit, self.zeros[p] + ones, at - ones)
            out = out << 1 | bit
        return out

    def rank(self, symbol: int, end: int) -> int:
        """How often ``symbol`` occurs before place ``end``."""
        lo, hi = self._range(symbol, end)
        return hi - lo

    def _range(self, symbol: int, end: int) -> tuple[int, int]:
        if symbol < 0 or symbol >> self.bits:
            return 0, 0
        span = np.array([0, min(max(end, 0), self.n)])
        for p in range(self.bits):
            ones = self._rank1(p, span)
            bit = symbol >> (self.bits - 1 - p) & 1
            span = self.zeros[p] + ones if bit else span - ones
        return int(span[0]), int(span[1])

    def count(self, symbol: int) -> int:
        return self.rank(symbol, self.n)

    def select(self, symbol: int, k: int) -> int:
        """Place of the ``k``-th occurrence, from 0; -1 if there are fewer."""
        lo, hi = self._range(symbol, self.n)
        if not 0 <= k < hi - lo:
            return -1
        at = lo + k
        for p in range(self.bits - 1, -1, -1):
            bit = symbol >> (self.bits - 1 - p) & 1
            at = self._select(p, bit, at - self.zeros[p] if bit else at)
        return at

    def _select(self, plane: int, bit: int, k: int) -> int:
        ones = self.ones[plane].astype(np.int64)
        held = ones if bit else np.arange(len(ones)) * STEP - ones
        block = int(np.searchsorted(held, k, side="right")) - 1
        part = np.unpackbits(self.planes[plane][block * STEP // 8:(block + 1) * STEP // 8],
                             bitorder="little")
        return block * STEP + int(np.flatnonzero(part == bit)[k - held[block]])

    def occurrences(self, symbol: int) -> np.ndarray:
        """All places of ``symbol``, in rising order."""
        return np.array([self.select(symbol, k) for k in range(self.count(symbol))],
                        dtype=np.int64)

    def decode(self) -> np.ndarray:
        """All ids in order: the partitions undone from the lowest plane up."""
        kind = np.uint16 if self.bits <= 16 else np.uint32
        ids = np.zeros(self.n, dtype=kind)
        for p in range(self.bits - 1, -1, -1):
            bit = np.unpackbits(self.planes[p], count=self.n, bitorder="little").view(bool)
            up = np.empty(self.n, dtype=kind)
            up[np.flatnonzero(~bit)] = ids[:self.zeros[p]]
            up[np.flatnonzero(bit)] = ids[self.zeros[p]:] | kind(1 << (self.bits - 1 - p))
            ids = up
        return ids

    def row(self) -> tuple:
        return (self.n, self.bits, b"".join(p.tobytes() for p in self.planes), self.zeros,
                b"".join(o.tobytes() for o in self.ones))

    @classmethod
    def from_row(cls, n: int, bits: int, planes: bytes, zeros: list[int], ones: bytes
                 ) -> WaveletMatrix:
        size = -(-n // STEP) * STEP // 8
        data = np.frombuffer(planes, dtype=np.uint8)
        rank = np.frombuffer(ones, dtype="<u4")
        each = size * 8 // STEP + 1
        return cls(n, bits, [data[p * size:(p + 1) * size] for p in range(bits)], list(zeros),
                   [rank[p * each:(p + 1) * each] for p in range(bits)])


_SHARD = pa.schema([
    ("part", pa.int32()), ("number", pa.int32()), ("before", pa.int64()),
    ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int64())),
    ("n", pa.int64()), ("bits", pa.int32()), ("planes", pa.binary()),
    ("zeros", pa.list_(pa.int64())), ("ones", pa.binary())])
SHARD = ("part int, number int, before long, doc_ids array<long>, doc_tokens array<long>, n long, "
         "bits int, planes binary, zeros array<long>, ones binary")


def _shards(batches: Iterator[pa.RecordBatch], path: str, end_id: int, bits: int, most: int
            ) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    docs: list = []
    lengths: list[int] = []
    parts: list[np.ndarray] = []
    number = before = held = 0

    def shard():
        ids = np.concatenate(parts)
        return emit(_SHARD, [(part, number, before, docs, lengths,
                              *WaveletMatrix.build(ids, bits).row())])

    for doc_id, raw in encoded(rows_of(batches, "doc_id", "text"), path, end_id):
        ids = np.frombuffer(raw, dtype="<u4")
        if int(ids.max()) >> bits:
            raise ValueError(f"an id of document {doc_id} needs more than {bits} bits")
        if held and held + len(ids) > most:
            yield shard()
            before += held
            docs, lengths, parts, held, number = [], [], [], 0, number + 1
        docs.append(doc_id)
        lengths.append(len(ids))
        parts.append(ids.astype(np.uint16 if bits <= 16 else np.uint32))
        held += len(ids)
    if held:
        yield shard()


def write_shards(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, bits: int = 16,
                 most: int = 1 << 20) -> None:
    """Encode whole texts in ascending ``doc_id`` order and write wavelet-matrix shards to ``path``.

    Every row of the Parquet files is one shard of at most ``most`` ids: ``SHARD`` columns, that is
    the documents with their lengths, the bit-planes, the zeros of each plane and the counts of ones
    at every 512 bits. A document is never split; one longer than ``most`` is a shard of its own.
    Null and empty texts are the end id alone. ``before`` counts the ids of earlier shards of the
    same ``part``; parts follow each other by ``doc_id``. Rows with equal or null ids are kept, nulls
    first. Other columns are ignored; an empty table gives no shard.
    """
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    ordered.mapInArrow(partial(_shards, path=tokenizer, end_id=end_id, bits=bits, most=most),
                       SHARD).write.option("compression", "zstd").parquet(path)


_DOCS = pa.schema([("part", pa.int32()), ("within", pa.int64()), ("doc_id", pa.int64()),
                   ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for batch in batches:
            for k in range(batch.num_rows):
                part, _, before, doc_ids, lengths, *matrix = (
                    c[0].as_py() for c in batch.slice(k, 1).columns)
                ids = WaveletMatrix.from_row(*matrix).decode().astype("<u4")
                at = 0
                for doc_id, n in zip(doc_ids, lengths):
                    yield part, before + at, doc_id, n, zlib.crc32(ids[at:at + n].tobytes())
                    at += n
    return in_batches(_DOCS, rows())


def read_documents(spark, path: str) -> DataFrame:
    """Per document, from the files: ``doc_id, start, n_tokens, ids_crc32``."""
    shards = spark.read.schema(SHARD).parquet(path)
    # One row per part, and there are as many parts as tasks that wrote: small by construction.
    parts = shards.groupBy("part").agg(F.min(F.element_at("doc_ids", 1)).alias("first"),
                                       F.sum("n").alias("n"))
    order = Window.orderBy(F.col("first").asc_nulls_first(), "part")
    base = parts.select("part", (F.sum("n").over(order) - F.col("n")).alias("base"))
    rows = shards.mapInArrow(_read, "part int, within long, doc_id long, n_tokens long, "
                                    "ids_crc32 long")
    return rows.join(F.broadcast(base), "part").select(
        "doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")


def look_up(spark, path: str, symbol: int) -> DataFrame:
    """Places of one token id: ``doc_id, offset``, found by rank and select alone."""
    def find(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("offset", pa.int64())])

        def rows():
            for batch in batches:
                for k in range(batch.num_rows):
                    _, _, _, doc_ids, lengths, *matrix = (
                        c[0].as_py() for c in batch.slice(k, 1).columns)
                    ends = np.cumsum(lengths)
                    for at in WaveletMatrix.from_row(*matrix).occurrences(symbol):
                        d = int(np.searchsorted(ends, at, side="right"))
                        yield doc_ids[d], int(at - ends[d] + lengths[d])
        return in_batches(schema, rows())
    return spark.read.schema(SHARD).parquet(path).mapInArrow(find, "doc_id long, offset long")


def round_trip(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Write shards into the shared folder and read the documents back from them."""
    place = f"{Stage(docs.sparkSession, 'wavelet').path}/shards"
    write_shards(docs, place, tokenizer, **options)
    return read_documents(docs.sparkSession, place)
