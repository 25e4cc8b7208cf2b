"""Lateral joins with table functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewake.constants import KEYWORD_CART, KEYWORD_CLICK, KEYWORD_ORDER
from tradewake.functions.text import words


def explode_words(df: DataFrame, text: str, keyword: str = "keyword",
                  stop_words: tuple[str, ...] = ()) -> DataFrame:
    """One row per word of ``text``; rows without words disappear."""
    return df.withColumn(keyword, F.explode(words(text, stop_words)))


def explode_counts(df: DataFrame, click: str = "click_ct", cart: str = "cart_ct",
                   order: str = "order_ct") -> DataFrame:
    """The three product counts as rows ``(ct, source)``; zero counts give no row."""
    pairs = F.array(*[
        F.struct(F.col(c).alias("ct"), F.lit(s).alias("source"))
        for c, s in ((click, KEYWORD_CLICK), (cart, KEYWORD_CART), (order, KEYWORD_ORDER))
    ])
    counted = F.explode(F.filter(pairs, lambda p: p["ct"] > 0))
    return df.withColumn("_pair", counted).select(
        *[c for c in df.columns if c not in ("ct", "source")], "_pair.ct", "_pair.source"
    )


def explode_display(page_logs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per displayed item, with the page it was shown on. ``keep`` adds parent columns."""
    item = F.explode("display").alias("_d")
    shown = page_logs.select(F.col("page.page_id").alias("page_id"), *keep, item)
    return shown.select("_d.*", *[c for c in shown.columns if c != "_d"])
