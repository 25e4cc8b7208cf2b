"""Event-time interval join on an equal key."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOT = "_slot"
PART = "_part"


def _slot(ts: Column, width: int) -> Column:
    # Shifted by half a slot, so that day-precision times sit in the middle of one.
    return F.floor((F.unix_millis(ts) + width // 2) / width)


def interval_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                  left_time: str, right_time: str, lower_ms: int, upper_ms: int,
                  salts: int = 1) -> DataFrame:
    """Inner join where ``right_time`` lies in ``[left_time + lower, left_time + upper]``.

    Both ends are inclusive. The result carries the aliases ``l`` and ``r``. The same plan
    serves batch and stream; for streams both inputs need a watermark on their time column.

    Time is cut into slots, and the slot is part of the join key. That spreads a hot key over
    its time range and keeps the compared pairs to the neighbourhood of the interval. A right
    row has one slot and a left row at most two, so every match is found exactly once.

    What stays hot inside one slot is split by adaptive execution in batch. For streams
    ``salts`` spreads the right rows of a slot over that many parts and repeats the left rows
    in each; take it when the right side has the hot keys, as details of orders do.
    """
    if upper_ms < lower_ms:
        raise ValueError("upper bound below lower bound")
    width = max(4 * (upper_ms - lower_ms), 1000)
    lt, rt = F.col(left_time), F.col(right_time)
    low = F.expr(f"INTERVAL {lower_ms} MILLISECONDS")
    high = F.expr(f"INTERVAL {upper_ms} MILLISECONDS")

    slots = F.sequence(_slot(lt + low, width), _slot(lt + high, width))
    keys = [SLOT]
    l, r = left.withColumn(SLOT, F.explode(slots)), right.withColumn(SLOT, _slot(rt, width))
    if salts > 1:
        keys.append(PART)
        l = l.withColumn(PART, F.explode(F.array(*[F.lit(i) for i in range(salts)])))
        # From the row itself and not from a random number, so that a repeated task agrees.
        r = r.withColumn(PART, F.pmod(F.xxhash64(*right.columns), F.lit(salts)).cast("int"))
    l, r = l.alias("l"), r.alias("r")
    l_time, r_time = F.col(f"l.{left_time}"), F.col(f"r.{right_time}")
    return l.join(
        r,
        (F.col(f"l.{left_key}") == F.col(f"r.{right_key}"))
        & reduce(and_, [F.col(f"l.{k}") == F.col(f"r.{k}") for k in keys])
        & (r_time >= l_time + low)
        & (r_time <= l_time + high),
        "inner",
    )
