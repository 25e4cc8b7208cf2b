"""One row per key (S3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                  newest: bool = False) -> DataFrame:
    """The first (or newest) whole row of every key.

    An aggregate rather than a ranking window: every task keeps one row per key before the
    shuffle, so a key that owns most of the table costs the receiving task one row per sender.
    """
    pick = F.max_by if newest else F.min_by
    rest = [c for c in df.columns if c not in keys]
    row = pick(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(row).select(*keys, "_row.*").select(*df.columns)
