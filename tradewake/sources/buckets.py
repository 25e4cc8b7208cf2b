"""Dimensions too large to broadcast, stored in buckets of their key.

A look-up shuffles the facts to the buckets and nothing else: the dimension lies in them already,
sorted. So a micro-batch moves its own rows, however large the dimension is.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewake.operators.keyed import first_per_key

KEY = "_key"


class BucketedDimension:
    """A catalog table with one row per key, as text in ``_key``."""

    def __init__(self, spark: SparkSession, name: str, path: str, buckets: int):
        """``buckets``: so many that one is a task's work. ``path`` is a folder all tasks see."""
        self.spark, self.name, self.path, self.buckets = spark, name, path, buckets

    def store(self, rows: DataFrame, key: str, order: Sequence[str] = ()) -> None:
        """Replace the table. Of rows that share a key the first by ``order`` is the hit; without
        one, the least by all columns, so that a key has one row in any case. Rows without a key
        can't be found and are left out."""
        keyed = rows.withColumn(KEY, F.col(key).cast("string")).dropna(subset=[KEY])
        kinds = ("map", "variant")  # columns that can't be ordered
        order = order or [f.name for f in rows.schema if f.dataType.typeName() not in kinds]
        one = first_per_key(keyed, [KEY], order)
        one.repartition(self.buckets, KEY).write.mode("overwrite").option("path", self.path) \
            .bucketBy(self.buckets, KEY).sortBy(KEY).saveAsTable(self.name)

    def look_up(self, facts: DataFrame, key: str, columns: Mapping[str, str | Column]) -> DataFrame:
        """``facts`` with ``columns`` (new name to column of the table); nulls where nothing is
        found. The join is told to merge, so that the side with buckets stays where it is."""
        taken = {n: F.col(c) if isinstance(c, str) else c for n, c in columns.items()}
        table = self.spark.table(self.name).select(KEY, *(c.alias(f"_d_{n}") for n, c in taken.items()))
        sent = facts.withColumn(KEY, F.col(key).cast("string")).repartition(self.buckets, KEY)
        joined = sent.join(table.hint("merge"), KEY, "left")
        return joined.select(*(F.col(f"`{c}`") for c in facts.columns if c not in taken),
                             *(F.col(f"_d_{n}").alias(n) for n in taken))
