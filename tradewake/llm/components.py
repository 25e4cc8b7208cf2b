"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stage


def _print(links: DataFrame):
    row = links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
    return tuple(row)


def components(links: DataFrame, stage: Stage) -> DataFrame:
    """Rows ``(node, component)`` for every node of ``links(a, b)``.

    The component is its least node. Every round hangs the larger neighbours of a node on the
    least one, then the smaller ones, so chains shrink by halves; links stay distributed and
    each round is written to the shared folder. Links of a node with itself, repeated links and
    links with a null are ignored; an empty table gives an empty table.
    """
    now = stage.save(
        links.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = _print(now)
    while True:
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u"), F.least("u", "m").alias("m"))
        # Larger neighbours v of u hang on u's least neighbour.
        large = now.select(F.col("b").alias("u"), F.col("a").alias("v")).join(least, "u").select(
            F.col("v").alias("a"), F.col("m").alias("b"))
        # Smaller neighbours of a, and a itself, hang on the least of them.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")),
                              F.struct(F.col("b").alias("a"), F.col("m").alias("b"))))
            .alias("e")).select("e.*").where("a <> b").distinct()
        after_table = stage.save(small)
        after = _print(after_table)
        stage.drop(now)
        now = after_table
        if after == before:
            break
        before = after
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(now.select(F.col("b").alias("node"), F.col("b").alias("component"))
                       .distinct())
