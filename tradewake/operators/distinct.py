"""Distinct counts that merge: sketches per window, rolled up without the ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a sketch; the standard error of a count is about 1.04 / 2 ** (bits / 2), so 1.6 %.
BITS = 12


def sketch_ids(rows: DataFrame, window: str, keys: Sequence[str], ids: Sequence[str],
               event_time: str = "_rowtime", bits: int = BITS) -> DataFrame:
    """``_w``, ``keys`` and a sketch of the distinct values of every column of ``ids``.

    Null ids don't count. The sketch of a hot key is combined before the shuffle, and in a stream
    it is all that a window keeps, however many ids it has seen: unlike deduplication, which keeps
    every id until the window closes.
    """
    return rows.groupBy(F.window(event_time, window).alias("_w"), *keys).agg(*(
        F.hll_sketch_agg(c, bits).alias(c) for c in ids))


def roll_up(sketches: DataFrame, window: str | None, keys: Sequence[str], ids: Sequence[str]
            ) -> DataFrame:
    """Sketches of longer windows, or of fewer keys, from those of shorter ones.

    ``window`` is a multiple of the windows there are; None makes one group of all time. The
    result is the sketch that the ids themselves would have given.
    """
    time = [F.window(F.col("_w.start"), window).alias("_w")] if window else []
    return sketches.groupBy(*time, *keys).agg(*(F.hll_union_agg(c).alias(c) for c in ids))


def counted(sketches: DataFrame, ids: Sequence[str]) -> list[Column]:
    """The columns of ``sketches`` with estimates in place of the sketches."""
    return [F.hll_sketch_estimate(c).alias(c) if c in ids else F.col(c)
            for c in sketches.columns]


def error_bound(bits: int = BITS, deviations: float = 4) -> float:
    """The relative error that an estimate keeps within so many standard deviations."""
    return deviations * 1.04 / 2 ** (bits / 2)
