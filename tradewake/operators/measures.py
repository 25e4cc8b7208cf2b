"""Measure rows for the statistics jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewake.constants import APPRAISE_GOOD, DISPLAY_SKU, PAGE_DETAIL
from tradewake.functions.text import is_blank
from tradewake.functions.times import text_millis
from tradewake.operators.lateral import explode_display
from tradewake.operators.once import compute_once

VISITOR_DIMS = ("vc", "ch", "ar", "is_new")
VISITOR_MEASURES = ("uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum")

PRODUCT_COUNTS = ("display_ct", "click_ct", "favor_ct", "cart_ct", "order_sku_num", "order_ct",
                  "paid_order_ct", "refund_order_ct", "comment_ct", "good_comment_ct")
# Of these, the numbers of different ids.
PRODUCT_ID_COUNTS = ("order_ct", "paid_order_ct", "refund_order_ct")
PRODUCT_AMOUNTS = ("order_amount", "payment_amount", "refund_amount")


def entry_page() -> Column:
    """The page was not reached from another page."""
    return is_blank("page.last_page_id")


def valid_page() -> Column:
    """The page names itself."""
    return ~is_blank("page.page_id")


def visitor_rows(logs: DataFrame, **measures: Column) -> DataFrame:
    """Dimensions, time and the given measures of every log row; other measures are zero."""
    zero = F.lit(0).cast("bigint")
    return logs.select(
        *[F.col(f"common.{d}").alias(d) for d in VISITOR_DIMS],
        *[measures.get(m, zero).cast("bigint").alias(m) for m in VISITOR_MEASURES],
        "ts",
    )


def page_view_rows(page: DataFrame) -> DataFrame:
    return visitor_rows(page, pv_ct=F.lit(1), dur_sum=F.coalesce("page.during_time", F.lit(0)))


def session_rows(page: DataFrame) -> DataFrame:
    return visitor_rows(page.filter(entry_page()), sv_ct=F.lit(1))


def page_and_session_rows(page: DataFrame) -> DataFrame:
    """Page views and sessions in one pass; the sums equal those of the two inputs united."""
    return visitor_rows(
        page, pv_ct=F.lit(1), sv_ct=F.when(entry_page(), 1).otherwise(0),
        dur_sum=F.coalesce("page.during_time", F.lit(0)),
    )


def unique_visit_rows(unique_visits: DataFrame) -> DataFrame:
    return visitor_rows(unique_visits, uv_ct=F.lit(1))


def jump_rows(bounces: DataFrame) -> DataFrame:
    return visitor_rows(bounces, uj_ct=F.lit(1))


def click_rows(page: DataFrame) -> DataFrame:
    """Detail pages as product clicks; an item that is no number gives a null SKU."""
    return page.filter(F.col("page.page_id") == PAGE_DETAIL).select(
        F.col("page.item").try_cast("bigint").alias("sku_id"),
        F.lit(1).cast("bigint").alias("click_ct"), "ts",
    )


def display_rows(page: DataFrame) -> DataFrame:
    """Displayed SKUs as product displays."""
    return explode_display(page, keep=("ts",)).filter(F.col("item_type") == DISPLAY_SKU).select(
        F.col("item").try_cast("bigint").alias("sku_id"),
        F.lit(1).cast("bigint").alias("display_ct"), "ts",
    )


def _product_items(page: DataFrame) -> DataFrame:
    """Clicked and displayed items in one pass over the page log, by far the largest input."""
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    click = F.when(
        F.col("page.page_id") == PAGE_DETAIL,
        F.array(F.struct(F.col("page.item").alias("item"), one.alias("click_ct"),
                         zero.alias("display_ct"))),
    )
    shown = F.transform(
        F.filter("display", lambda d: d["item_type"] == DISPLAY_SKU),
        lambda d: F.struct(d["item"].alias("item"), zero.alias("click_ct"),
                           one.alias("display_ct")),
    )
    none = F.array().cast("array<struct<item:string,click_ct:bigint,display_ct:bigint>>")
    rows = F.explode(F.concat(F.coalesce(click, none), F.coalesce(shown, none)))
    return page.select(rows.alias("_m"), "ts").select("_m.*", "ts")


def click_and_display_rows(page: DataFrame) -> DataFrame:
    """Clicks and displays as product rows; an item that is no number gives a null SKU."""
    sku = F.col("item").try_cast("bigint").alias("sku_id")
    return _product_items(page).select(sku, "click_ct", "display_ct", "ts")


def unreadable_products(page: DataFrame) -> DataFrame:
    """Clicked or displayed items that name no SKU, for the quarantine."""
    return _product_items(page).filter(F.col("item").try_cast("bigint").isNull())


def unreadable_item() -> Column:
    """A page log has a clicked or displayed item that names no SKU."""
    def no_sku(item: Column) -> Column:
        return item.try_cast("bigint").isNull()

    shown = F.exists("display", lambda d: (d["item_type"] == DISPLAY_SKU) & no_sku(d["item"]))
    clicked = (F.col("page.page_id") == PAGE_DETAIL) & no_sku(F.col("page.item"))
    return F.coalesce(clicked, F.lit(False)) | F.coalesce(shown, F.lit(False))


def _at(df: DataFrame, text: Column | str = "create_time") -> DataFrame:
    """``df`` with the time of a business text as ``ts``."""
    return compute_once(df, "ts", text_millis(text))


def favor_rows(favor: DataFrame) -> DataFrame:
    return _at(favor).select("sku_id", F.lit(1).cast("bigint").alias("favor_ct"), "ts")


def cart_rows(cart: DataFrame) -> DataFrame:
    return _at(cart).select("sku_id", F.lit(1).cast("bigint").alias("cart_ct"), "ts")


def comment_rows(comment: DataFrame) -> DataFrame:
    good = F.when(F.col("appraise") == APPRAISE_GOOD, 1).otherwise(0)
    return _at(comment).select("sku_id", F.lit(1).cast("bigint").alias("comment_ct"),
                               good.cast("bigint").alias("good_comment_ct"), "ts")


def order_rows(order_wide: DataFrame) -> DataFrame:
    """Ordered items; ``_id`` is what ``order_ct`` counts once."""
    return _at(order_wide).select(
        "sku_id", F.col("sku_num").alias("order_sku_num"),
        F.col("split_total_amount").alias("order_amount"), F.col("order_id").alias("_id"), "ts",
    )


def payment_rows(payment_wide: DataFrame) -> DataFrame:
    paid_at = F.coalesce("payment_create_time", "callback_time")
    return _at(payment_wide, paid_at).select(
        "sku_id", F.col("split_total_amount").alias("payment_amount"),
        F.col("order_id").alias("_id"), "ts",
    )


def refund_rows(refund: DataFrame) -> DataFrame:
    return _at(refund).select("sku_id", "refund_amount", F.col("order_id").alias("_id"), "ts")
