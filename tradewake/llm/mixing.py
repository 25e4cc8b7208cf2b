"""A mix of sources to target weights: hash-random order, prefix sums, exact cuts.

Documents get hash-random keys and are range-sorted by source and key. Distributed prefix sums of
their sizes say how many words of the source come before each; where the source's budget ends,
the mix ends. A budget larger than the source takes whole epochs first.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewake.operators.sides import broadcast_if_small

from .common import Stage, only
from .running import running

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def _key(seed: int) -> Column:
    """60 random bits of a document's id and text."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string"),
                               F.md5("text")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, stage: Stage, weights: Sequence[int], share: float, most: int
            ) -> DataFrame:
    """``sizes`` (columns ``none``, ``src``, ``source_size``) with the ``target`` of each source.

    Weights go to the sources in order of code points, the null source last, and repeat. All
    targets are filled in proportion to their weights, like vessels, until they hold ``share``
    times all sizes; a source is full at ``most`` times its size. The level they fill to is
    found by prefix sums over the sources in the order in which they fill up.
    """
    found = stage.save(sizes.withColumn("one", F.lit(1).cast("long")))
    ranked = running(found, ["none", "src"], ["one"], stage)
    kinds = F.array(*(F.lit(int(w)).cast("long") for w in weights))
    weighted = stage.save(
        ranked.withColumn("weight", F.get(kinds, (F.col("before_one") % len(weights)).cast("int")))
        .withColumn("cap", F.col("source_size") * F.lit(int(most)))
        .withColumn("full_at", F.col("cap").cast("double") / F.col("weight")))
    total = weighted.agg(F.sum("source_size"), F.sum("weight")).first()
    wanted, weight = share * (total[0] or 0), total[1] or 1
    filled = running(weighted, ["full_at", "none", "src"], ["cap", "weight"], stage)
    level = (F.lit(float(wanted)) - F.col("before_cap")) / (F.lit(weight) - F.col("before_weight"))
    level = filled.select(level.alias("level"), "full_at").where("level <= full_at") \
        .agg(F.max("level")).first()[0]
    cap = F.col("cap").cast("double")
    target = cap if level is None else F.least(cap, F.lit(level) * F.col("weight"))
    return weighted.withColumn("target", target)


def _planned(docs: DataFrame, rows: Column, stage: Stage, weights: Sequence[int], share: float,
             most: int, seed: int) -> DataFrame:
    digest = stage.save(docs.select(
        F.col("doc_id"), F.col("source"), F.col("source").isNull().alias("none"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("src"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        _key(seed).alias("key"), rows.alias("row")))
    # The row's own number tells equal rows apart, so that they can go to several tasks.
    ordered = running(digest, ["none", "src", "key", "doc_id", "size", "row"], ["size"], stage)
    sizes = stage.save(ordered.groupBy("none", "src").agg(
        F.sum("size").alias("source_size"), F.min("before_size").alias("first")))
    known = targets(sizes, stage, weights, share, most).select(
        "none", "src", "source_size", "first", "target", F.floor("target").alias("budget"))
    epochs = F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(F.lit(0))
    rest = F.col("budget") - epochs * F.col("source_size")
    place = F.col("before_size") - F.col("first")
    last = F.greatest(F.lit(0), F.least(F.col("size"), rest - place))
    return ordered.join(broadcast_if_small(known), ["none", "src"]).select(
        "row", "doc_id", "source", "size", "source_size", "target",
        (epochs * F.col("size") + last).cast("long").alias("taken"))


def plan_mix(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5,
             most: int = 2, seed: int = 42) -> DataFrame:
    """How many words of every document the mix takes.

    Returns ``doc_id, source, size, source_size, target, taken``. The words taken of a source sum
    to its target without the fraction; a document at the cut gives its first words, and none
    gives more than ``most`` times its size. The order is that of a hash of id and text, so
    reruns agree. Null and empty texts have size 0 and give nothing; the null source is a source
    of its own, other than the empty one. Rows that repeat are rows of their own; those of a
    repeated id are told apart by text. An empty table gives an empty table; other columns are
    ignored.
    """
    stage = Stage(docs.sparkSession, "mixing")
    return _planned(only(docs, "doc_id", "text", "source"), F.monotonically_increasing_id(), stage,
                    weights, share, most, seed).drop("row")


def first_words(text: pd.Series, n: pd.Series) -> pd.Series:
    """The text up to the end of its n-th word."""
    def cut(t, k):
        for i, found in enumerate(re.finditer(WORD, t), 1):
            if i == k:
                return t[:found.end()]
        return t
    return pd.Series([cut(t, k) for t, k in zip(text, n)])


def mix(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: int = 2,
        seed: int = 42) -> DataFrame:
    """The mix itself: the columns of ``docs`` and ``__epoch``, a row per document and epoch.

    The document at a source's cut ends with the last word taken; all other texts are whole.
    Documents without words are in no mix. Columns called ``__epoch``, ``__words``, ``__size``,
    ``__taken`` or ``__row`` are replaced.
    """
    stage = Stage(docs.sparkSession, "mixture")
    names = [c for c in docs.columns
             if c not in ("__epoch", "__words", "__size", "__taken", "__row")]
    numbered = stage.save(only(docs, *names).withColumn("__row", F.monotonically_increasing_id()))
    plan = _planned(only(numbered, "doc_id", "text", "source", "__row"), F.col("__row"), stage,
                    weights, share, most, seed)
    taken = plan.where("taken > 0").select(
        F.col("row").alias("__row"), F.col("size").alias("__size"), F.col("taken").alias("__taken"))
    epochs = F.sequence(F.lit(0).cast("long"), F.expr("(__taken - 1) div __size"))
    copies = numbered.join(taken, "__row").withColumn("__epoch", F.explode(epochs)).withColumn(
        "__words", F.least(F.col("__size"), F.col("__taken") - F.col("__epoch") * F.col("__size")))
    whole = copies.where("__words = __size")
    cut = copies.where("__words < __size").withColumn(
        "text", F.pandas_udf(first_words, "string")("text", "__words"))
    return whole.unionByName(cut).select(*(F.col(f"`{c}`") for c in names), "__epoch")


def oracle(weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: int = 2, seed: int = 42
           ) -> str:
    """DuckDB SQL for the rows of :func:`plan_mix`."""
    return f"""
WITH d AS (
  SELECT doc_id, source, CAST(CASE WHEN text IS NULL THEN 0 ELSE
      len(regexp_extract_all(text, '{WORD}')) END AS BIGINT) AS size,
    CAST('0x' || substr(md5(concat_ws(':', '{seed}', CAST(doc_id AS VARCHAR), md5(text))), 1, 15)
      AS BIGINT) AS key
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, {list(map(int, weights))}[1 + CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1)
    % {len(weights)} AS INTEGER)] AS weight, source_size * {int(most)} AS cap FROM s),
f AS (
  SELECT *, CAST(cap AS DOUBLE) / weight AS full_at,
    coalesce(sum(cap) OVER before, 0) AS cap_before,
    coalesce(sum(weight) OVER before, 0) AS weight_before
  FROM w WINDOW before AS (ORDER BY CAST(cap AS DOUBLE) / weight, source NULLS LAST
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (
  SELECT max(level) AS level FROM (
    SELECT ({share} * (SELECT CAST(sum(source_size) AS DOUBLE) FROM s) - CAST(cap_before AS DOUBLE))
      / ((SELECT CAST(sum(weight) AS DOUBLE) FROM w) - CAST(weight_before AS DOUBLE)) AS level,
      full_at FROM f) WHERE level <= full_at),
t AS (
  SELECT source, source_size, coalesce(least(CAST(cap AS DOUBLE), level * weight),
    CAST(cap AS DOUBLE)) AS target FROM w, l),
p AS (
  SELECT d.doc_id, d.source, d.size, t.source_size, t.target,
    CAST(floor(t.target) AS BIGINT) AS budget,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS place
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CAST(CASE WHEN source_size = 0 THEN 0 ELSE budget // source_size * size
    + greatest(0, least(size, budget % source_size - place)) END AS BIGINT) AS taken
FROM p"""
