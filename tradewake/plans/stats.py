"""Visitor, product and keyword statistics."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewake.constants import KEYWORD_SEARCH, PAGE_SEARCH
from tradewake.functions.times import (processing_millis, rowtime_millis, rowtime_seconds,
                                       time_text, window_bounds)
from tradewake.operators import measures as M
from tradewake.operators.enrich import Dimension, enrich_all
from tradewake.operators.lateral import explode_counts, explode_words
from tradewake.schemas import KEYWORD_STATS, PRODUCT_STATS, VISITOR_STATS

WINDOW = "10 seconds"


def timed(rows: DataFrame, delay: str) -> DataFrame:
    return rows.withColumn("_rowtime", rowtime_millis("ts")).withWatermark("_rowtime", delay)


def union_all(inputs: Sequence[DataFrame]) -> DataFrame:
    """Measure rows united by name, duplicates kept.

    Each input brings its own watermark, so that a slow one (bounces come late by nature)
    holds the common watermark back instead of losing its rows.
    """
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), inputs)


def visitor_stats(page: DataFrame, unique_visits: DataFrame, bounces: DataFrame,
                  window: str = WINDOW, as_of_ms: int | None = None,
                  delay: str = "2 seconds") -> DataFrame:
    """Visits, pages, sessions, bounces and time spent per window, version, channel, area, flag."""
    inputs = (M.page_and_session_rows(page), M.unique_visit_rows(unique_visits),
              M.jump_rows(bounces))
    rows = union_all([timed(df, delay) for df in inputs])
    sums = [F.sum(m).alias(m) for m in M.VISITOR_MEASURES]
    totals = rows.groupBy(F.window("_rowtime", window), *M.VISITOR_DIMS).agg(*sums)
    return totals.select(
        *window_bounds(), *M.VISITOR_DIMS, *M.VISITOR_MEASURES,
        processing_millis(as_of_ms).alias("ts"),
    ).select(*VISITOR_STATS.fieldNames())


def count_ids_once(rows: DataFrame, count: str) -> DataFrame:
    """Windowed measure rows whose ``count`` adds up to the distinct ``_id`` per window and SKU.

    In batch one row per window, SKU and id, which spreads a hot SKU; the rows of a SKU are left to
    the sums that follow, so that they are shuffled for these alone. In a stream rows pass on as
    they are and a deduplicated copy carries the count, since streams have no distinct aggregates;
    state goes when the window closes.
    """
    if not rows.isStreaming:
        sums = [F.sum(c).alias(c) for c in rows.columns if c not in ("_w", "sku_id", "_id")]
        one = F.when(F.col("_id").isNotNull(), 1).otherwise(0).cast("bigint")
        return rows.groupBy("_w", "sku_id", "_id").agg(*sums).withColumn(count, one).drop("_id")
    ids = rows.filter(F.col("_id").isNotNull()).select("_w", "sku_id", "_id")
    once = ids.dropDuplicates(["_w", "sku_id", "_id"])
    counted = once.select("_w", "sku_id", F.lit(1).cast("bigint").alias(count))
    return rows.drop("_id").unionByName(counted, allowMissingColumns=True)


def mark_ids(rows: DataFrame, count: str) -> DataFrame:
    """Windowed measure rows with 1 as ``count`` where they have an ``_id``, else 0."""
    return rows.withColumn(count, F.when(F.col("_id").isNotNull(), 1).otherwise(0).cast("bigint"))


def product_rows(page: DataFrame | None = None, favor: DataFrame | None = None,
                 cart: DataFrame | None = None, order_wide: DataFrame | None = None,
                 payment_wide: DataFrame | None = None, refund: DataFrame | None = None,
                 comment: DataFrame | None = None, window: str = WINDOW,
                 delay: str = "2 seconds",
                 ids: Callable[[DataFrame, str], DataFrame] = count_ids_once) -> list[DataFrame]:
    """Measure rows with their window ``_w``; rows whose SKU is no number are left out. ``ids``
    gives rows with an ``_id`` the count of these."""
    def measured(source, rows):
        known = timed(rows(source), delay).filter(F.col("sku_id").isNotNull())
        return known.withColumn("_w", F.window("_rowtime", window)).drop("_rowtime", "ts")

    found = []
    for source, rows in ((page, M.click_and_display_rows), (favor, M.favor_rows),
                         (cart, M.cart_rows), (comment, M.comment_rows)):
        if source is not None:
            found.append(measured(source, rows))
    for source, rows, count in ((order_wide, M.order_rows, "order_ct"),
                                (payment_wide, M.payment_rows, "paid_order_ct"),
                                (refund, M.refund_rows, "refund_order_ct")):
        if source is not None:
            found.append(ids(measured(source, rows), count))
    if not found:
        raise ValueError("product statistics need at least one input")
    return found


def product_stats(page: DataFrame | None = None, favor: DataFrame | None = None,
                  cart: DataFrame | None = None, order_wide: DataFrame | None = None,
                  payment_wide: DataFrame | None = None, refund: DataFrame | None = None,
                  comment: DataFrame | None = None, window: str = WINDOW,
                  dims: Sequence[Dimension] = (), as_of_ms: int | None = None,
                  delay: str = "2 seconds") -> DataFrame:
    """All product measures per window and SKU, named through ``dims``.

    Measures no input delivers are zero. Rows whose SKU is no number are left out.
    """
    rows = union_all(product_rows(
        page, favor, cart, order_wide, payment_wide, refund, comment, window, delay))
    return product_totals(rows, dims, as_of_ms)


def product_parts(**inputs) -> DataFrame:
    """The measures of a stream per window, SKU and id, for :func:`product_totals`.

    Takes what :func:`product_rows` takes. One state holds the sums and tells equal ids, and a hot
    SKU is spread by its ids. The parts of a window come in one micro-batch, when it closes, so the
    totals of a micro-batch (or of all that was put out) are whole.
    """
    rows = union_all(product_rows(**inputs, ids=mark_ids))
    keys = [c for c in ("_w", "sku_id", "_id") if c in rows.columns]
    sums = [F.max(c).alias(c) if c in M.PRODUCT_ID_COUNTS else F.sum(c).alias(c)
            for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(*sums).drop("_id")


def product_totals(rows: DataFrame, dims: Sequence[Dimension] = (),
                   as_of_ms: int | None = None) -> DataFrame:
    """Product statistics of measure rows with their window ``_w``, named through ``dims``."""
    given = set(rows.columns)
    totals = rows.groupBy("_w", "sku_id").agg(
        *[F.sum(m).alias(m) for m in (*M.PRODUCT_COUNTS, *M.PRODUCT_AMOUNTS) if m in given]
    ).select(*window_bounds("_w"), "*").drop("_w")
    named = enrich_all(totals, dims)
    have = set(named.columns)

    def column(f):
        c = F.col(f.name) if f.name in have else F.lit(None)
        if f.name in M.PRODUCT_COUNTS or f.name in M.PRODUCT_AMOUNTS:
            c = F.coalesce(c.cast(f.dataType), F.lit(0).cast(f.dataType))
        elif f.name == "ts":
            c = processing_millis(as_of_ms)
        return c.cast(f.dataType).alias(f.name)

    return named.select(*[column(f) for f in PRODUCT_STATS])


def sku_dimension(skus: DataFrame) -> Dimension:
    """Name, price and parent ids of a SKU; a table with text columns."""
    return Dimension(skus, {"sku_id": "ID"}, {
        "sku_name": "SKU_NAME", "sku_price": F.col("PRICE").try_cast("decimal(18,2)"),
        "spu_id": F.col("SPU_ID").try_cast("bigint"), "tm_id": F.col("TM_ID").try_cast("bigint"),
        "category3_id": F.col("CATEGORY3_ID").try_cast("bigint")})


def search_keywords(page: DataFrame, window: str = WINDOW, as_of_ms: int | None = None,
                    delay: str = "2 seconds", stop_words: tuple[str, ...] = ()) -> DataFrame:
    """How often each word was searched per window. ``page`` may be a struct or a map column."""
    searched = page.filter(
        (F.col("page")["page_id"] == PAGE_SEARCH) & F.col("page")["item"].isNotNull()
    ).select(F.col("page")["item"].alias("fullword"), rowtime_seconds("ts").alias("rowtime"))
    return keyword_counts(searched, window, as_of_ms, delay, stop_words)


def keyword_counts(searched: DataFrame, window: str = WINDOW, as_of_ms: int | None = None,
                   delay: str = "2 seconds", stop_words: tuple[str, ...] = ()) -> DataFrame:
    """Words of ``fullword`` counted per window of ``rowtime``."""
    split = explode_words(searched.withWatermark("rowtime", delay), "fullword",
                          stop_words=stop_words)
    counted = split.groupBy(F.window("rowtime", window), "keyword").agg(F.count("*").alias("ct"))
    return counted.select(
        "keyword", "ct", F.lit(KEYWORD_SEARCH).alias("source"), *window_bounds(),
        processing_millis(as_of_ms).alias("ts"),
    ).select(*KEYWORD_STATS.fieldNames())


def product_keywords(stats: DataFrame, as_of_ms: int | None = None,
                     stop_words: tuple[str, ...] = ()) -> DataFrame:
    """Words of product names with the clicks, carts and orders of the product."""
    split = explode_counts(explode_words(stats, "spu_name", stop_words=stop_words))
    return split.select(
        "keyword", "ct", "source", time_text(F.try_to_timestamp("stt")).alias("stt"),
        time_text(F.try_to_timestamp("edt")).alias("edt"), processing_millis(as_of_ms).alias("ts"),
    )
