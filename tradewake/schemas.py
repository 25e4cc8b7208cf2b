"""Declared schemas. Field names are fixed values: they are the JSON keys of the topics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

MONEY = "decimal(18,2)"

_TEXT = T.StringType()
_LONG = T.LongType()
_INT = T.IntegerType()
_MONEY = T.DecimalType(18, 2)
_TOTAL = T.DecimalType(28, 2)
_TEXT_MAP = T.MapType(_TEXT, _TEXT)


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_COMMON = _schema(mid=_TEXT, is_new=_TEXT, vc=_TEXT, ch=_TEXT, ar=_TEXT)
_PAGE = _schema(page_id=_TEXT, last_page_id=_TEXT, item=_TEXT, during_time=_LONG)
_DISPLAY = T.ArrayType(_schema(item_type=_TEXT, item=_TEXT))

RAW_LOG = _schema(common=_COMMON, start=_TEXT_MAP, page=_PAGE, display=_DISPLAY, ts=_LONG)
PAGE_LOG = _schema(common=_COMMON, page=_PAGE, display=_DISPLAY, ts=_LONG)
PAGE_VIEW_SQL = _schema(common=_TEXT_MAP, page=_TEXT_MAP, ts=_LONG)
# The payload differs per table; variants keep the JSON types of its values.
CDC = _schema(table=_TEXT, type=_TEXT, data=T.MapType(_TEXT, T.VariantType()), ts=_LONG)
TABLE_PROCESS = _schema(
    source_table=_TEXT, operate_type=_TEXT, sink_type=_TEXT, sink_table=_TEXT,
    sink_columns=_TEXT, sink_pk=_TEXT, sink_extend=_TEXT,
)
ORDER_INFO = _schema(
    id=_LONG, province_id=_LONG, order_status=_TEXT, user_id=_LONG, total_amount=_MONEY,
    activity_reduce_amount=_MONEY, coupon_reduce_amount=_MONEY, original_total_amount=_MONEY,
    feight_fee=_MONEY, expire_time=_TEXT, create_time=_TEXT, operate_time=_TEXT,
    create_date=_TEXT, create_hour=_TEXT,
)
ORDER_DETAIL = _schema(
    id=_LONG, order_id=_LONG, sku_id=_LONG, order_price=_MONEY, sku_num=_LONG, sku_name=_TEXT,
    create_time=_TEXT, split_total_amount=_MONEY, split_activity_amount=_MONEY,
    split_coupon_amount=_MONEY,
)
PAYMENT_INFO = _schema(
    id=_LONG, order_id=_LONG, user_id=_LONG, total_amount=_MONEY, subject=_TEXT,
    payment_type=_TEXT, create_time=_TEXT, callback_time=_TEXT,
)
ORDER_WIDE = _schema(
    detail_id=_LONG, order_id=_LONG, sku_id=_LONG, order_price=_MONEY, sku_num=_LONG,
    sku_name=_TEXT, province_id=_LONG, order_status=_TEXT, user_id=_LONG, total_amount=_MONEY,
    activity_reduce_amount=_MONEY, coupon_reduce_amount=_MONEY, original_total_amount=_MONEY,
    feight_fee=_MONEY, split_feight_fee=_MONEY, split_activity_amount=_MONEY,
    split_coupon_amount=_MONEY, split_total_amount=_MONEY, expire_time=_TEXT, create_time=_TEXT,
    operate_time=_TEXT, create_date=_TEXT, create_hour=_TEXT, province_name=_TEXT,
    province_area_code=_TEXT, province_iso_code=_TEXT, province_3166_2_code=_TEXT,
    user_age=_INT, user_gender=_TEXT, spu_id=_LONG, tm_id=_LONG, category3_id=_LONG,
    spu_name=_TEXT, tm_name=_TEXT, category3_name=_TEXT,
)
PAYMENT_WIDE = _schema(
    payment_id=_LONG, subject=_TEXT, payment_type=_TEXT, payment_create_time=_TEXT,
    callback_time=_TEXT, detail_id=_LONG, order_id=_LONG, sku_id=_LONG, order_price=_MONEY,
    sku_num=_LONG, sku_name=_TEXT, province_id=_LONG, order_status=_TEXT, user_id=_LONG,
    total_amount=_MONEY, activity_reduce_amount=_MONEY, coupon_reduce_amount=_MONEY,
    original_total_amount=_MONEY, feight_fee=_MONEY, split_feight_fee=_MONEY,
    split_activity_amount=_MONEY, split_coupon_amount=_MONEY, split_total_amount=_MONEY,
    order_create_time=_TEXT, province_name=_TEXT, province_area_code=_TEXT,
    province_iso_code=_TEXT, province_3166_2_code=_TEXT, user_age=_INT, user_gender=_TEXT,
    spu_id=_LONG, tm_id=_LONG, category3_id=_LONG, spu_name=_TEXT, tm_name=_TEXT,
    category3_name=_TEXT,
)
# The next four are inferred: the topics are named by the product job, their fields are not.
FAVOR_INFO = _schema(id=_LONG, user_id=_LONG, sku_id=_LONG, create_time=_TEXT)
CART_INFO = _schema(id=_LONG, user_id=_LONG, sku_id=_LONG, sku_num=_LONG, create_time=_TEXT)
REFUND_INFO = _schema(
    id=_LONG, order_id=_LONG, sku_id=_LONG, refund_type=_TEXT, refund_amount=_MONEY,
    create_time=_TEXT,
)
COMMENT_INFO = _schema(id=_LONG, user_id=_LONG, sku_id=_LONG, appraise=_TEXT, create_time=_TEXT)
VISITOR_STATS = _schema(
    stt=_TEXT, edt=_TEXT, vc=_TEXT, ch=_TEXT, ar=_TEXT, is_new=_TEXT, uv_ct=_LONG, pv_ct=_LONG,
    sv_ct=_LONG, uj_ct=_LONG, dur_sum=_LONG, ts=_LONG,
)
PRODUCT_STATS = _schema(
    stt=_TEXT, edt=_TEXT, sku_id=_LONG, sku_name=_TEXT, sku_price=_MONEY, spu_id=_LONG,
    spu_name=_TEXT, tm_id=_LONG, tm_name=_TEXT, category3_id=_LONG, category3_name=_TEXT,
    display_ct=_LONG, click_ct=_LONG, favor_ct=_LONG, cart_ct=_LONG, order_sku_num=_LONG,
    order_amount=_TOTAL, order_ct=_LONG, payment_amount=_TOTAL, paid_order_ct=_LONG,
    refund_order_ct=_LONG, refund_amount=_TOTAL, comment_ct=_LONG, good_comment_ct=_LONG,
    ts=_LONG,
)
PRODUCT_STATS_SQL = _schema(
    spu_name=_TEXT, click_ct=_LONG, cart_ct=_LONG, order_ct=_LONG, stt=_TEXT, edt=_TEXT,
)
KEYWORD_STATS = _schema(keyword=_TEXT, ct=_LONG, source=_TEXT, stt=_TEXT, edt=_TEXT, ts=_LONG)

TRANSIENT = {"transient": True}


def drop_transient(df: DataFrame) -> DataFrame:
    """Leave out the columns whose field metadata marks them as not for sinks (A10)."""
    return df.drop(*[f.name for f in df.schema if f.metadata.get("transient")])
