"""Broadcast of a side whose size has been checked."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def broadcast_if_small(df: DataFrame, max_rows: int = 10_000, max_bytes: int = 32 << 20
                       ) -> DataFrame:
    """``df`` with a broadcast hint when it has at most ``max_rows`` rows and ``max_bytes`` bytes
    of text, else unchanged: the join is then Spark's choice, with the same rows.

    For tables Spark has no size of, such as JDBC tables. No more than ``max_rows`` + 1 rows
    are looked at.
    """
    size = F.coalesce(F.sum(F.length(F.to_json(F.struct("*")))), F.lit(0))
    rows, size = df.limit(max_rows + 1).agg(F.count("*"), size).first()
    return F.broadcast(df) if rows <= max_rows and size <= max_bytes else df
