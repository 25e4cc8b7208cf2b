"""Packing of token pieces into sequences by vector best fit.

A sequence has three capacities: tokens, documents, and attention cost (the sum of squared piece
lengths). Pieces are placed in falling order of length. Among the open sequences that a piece fits
under every constraint, the one with the least weighted norm of what is left, or with the largest
weighted dot-product of demand and residual, takes it; if none fits, a new one opens.

Pieces of full length fill a sequence each and need no search. The others are dealt evenly into
blocks by a hash, packed block by block, and the sequences that a block leaves poorly filled are
taken apart and packed again across blocks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stage, in_batches, rows_of
from .tokens import encoded


@dataclass(frozen=True)
class Capacity:
    """Limits of a sequence. ``documents`` and ``cost`` of None never bind."""

    tokens: int = 4096
    documents: int | None = None
    cost: int | None = None
    weights: tuple[float, float, float] = (1.0, 0.0, 0.0)
    rule: str = "norm"

    def limits(self) -> np.ndarray:
        return np.array([self.tokens, self.documents or self.tokens,
                         self.cost or self.tokens ** 2], dtype=np.float64)


def best_fit(lengths: np.ndarray, capacity: Capacity) -> np.ndarray:
    """Bin number of every piece. A piece larger than a limit gets a bin of its own."""
    limits = capacity.limits()
    weights = np.array(capacity.weights)
    lengths = np.asarray(lengths, dtype=np.float64)
    need = np.stack([lengths, np.ones(len(lengths)), lengths ** 2], axis=1) / limits
    place = np.empty(len(lengths), dtype=np.int64)
    left = np.ones((max(16, len(lengths)), 3))
    name = np.arange(len(left))
    open_bins = bins = 0
    smallest = need.min(axis=0) if len(need) else None
    eps = 1e-12
    for i in np.argsort(-lengths, kind="stable"):
        r = left[:open_bins]
        rest = r - need[i]
        fits = (rest >= -eps).all(axis=1)
        if fits.any():
            if capacity.rule == "dot":
                score = -((r * need[i]) @ weights)
            else:
                score = (rest * rest) @ weights
            k = int(np.argmin(np.where(fits, score, np.inf)))
            left[k] = rest[k]
        else:
            k = open_bins
            left[k], name[k] = 1 - need[i], bins
            open_bins += 1
            bins += 1
        place[i] = name[k]
        if (left[k] < smallest - eps).any():  # nothing fits any more: close it
            open_bins -= 1
            left[k], name[k] = left[open_bins], name[open_bins]
    return place


_PACKED = ("row long, length long, block long, bin long, offset long, fill long")


def _block(frame: pd.DataFrame, capacity: Capacity) -> pd.DataFrame:
    frame = frame.sort_values(["length", "row"], ascending=[False, True], kind="stable")
    frame = frame.assign(bin=best_fit(frame["length"].to_numpy(), capacity))
    by = frame.groupby("bin")["length"]
    return frame.assign(offset=by.cumsum() - frame["length"], fill=by.transform("sum"))[
        ["row", "length", "block", "bin", "offset", "fill"]]


def pack(pieces: DataFrame, capacity: Capacity, stage: Stage, block: int = 8192,
         full: float = 0.98) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; ``pieces`` has a ``length``.

    ``block`` pieces on average are packed together; sequences filled under ``full`` are packed
    once more, together with those of many blocks. Pieces of zero length take a place too.
    """
    numbered = stage.save(pieces.withColumn("row", F.monotonically_increasing_id()))
    limit = capacity.tokens
    small = numbered.where(F.col("length") < limit).select("row", "length")
    blocks = max(1, -(-small.count() // block))
    width = F.pmod(F.xxhash64("row"), F.lit(blocks))
    work = partial(_block, capacity=capacity)
    first = stage.save(small.withColumn("block", width).groupBy("block")
                       .applyInPandas(work, _PACKED))
    loose = first.where(F.col("fill") < full * limit)
    parts = max(1, -(-loose.count() // block))
    again = loose.select("row", "length", (F.pmod(F.col("block"), F.lit(parts)))
                         .alias("block")).groupBy("block").applyInPandas(work, _PACKED)
    # Even numbers for the first pass, odd ones for the second; full pieces below zero.
    placed = first.where(F.col("fill") >= full * limit).select(
        "row", (F.shiftleft("block", 33) + F.col("bin") * 2).alias("sequence_id"),
        "offset").union(again.select(
            "row", (F.shiftleft("block", 33) + F.col("bin") * 2 + 1).alias("sequence_id"),
            "offset"))
    alone = numbered.where(F.col("length") >= limit).select(
        "*", (-F.col("row") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return alone.union(numbered.where(F.col("length") < limit).join(placed, "row").select(
        *alone.columns)).drop("row")


_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                     ("length", pa.int64()), ("ids_crc32", pa.int64())])


def _pieces(batches: Iterator[pa.RecordBatch], path: str, end_id: int, longest: int
            ) -> Iterator[pa.RecordBatch]:
    def rows():
        for doc_id, ids in encoded(rows_of(batches, "doc_id", "text"), path, end_id):
            for piece, at in enumerate(range(0, len(ids), 4 * longest)):
                part = ids[at:at + 4 * longest]
                yield doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)
    return in_batches(_PIECES, rows())


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 1,
                   capacity: Capacity = Capacity(), block: int = 8192) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    A document is the ids of its whole text and ``end_id``; null and empty texts are the end id
    alone. Longer documents than ``capacity.tokens`` are cut into pieces of that length, the last
    may be shorter. Offsets in a sequence start at 0 and leave no gap. Repeated rows are packed as
    often as they occur; a null ``doc_id`` stays null; other columns are ignored; an empty table
    gives an empty table. Text stays in the task that reads it; only lengths are shuffled.
    """
    stage = Stage(docs.sparkSession, "packing")
    pieces = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        partial(_pieces, path=tokenizer, end_id=end_id, longest=capacity.tokens),
        "doc_id long, piece int, start long, length long, ids_crc32 long")
    return pack(pieces, capacity, stage, block)
