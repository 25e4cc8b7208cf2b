from decimal import Decimal

from pyspark.sql import functions as F

from tests.helpers import page_rows
from tradewake.functions.registry import register_functions
from tradewake.operators import measures
from tradewake.operators.lateral import explode_counts, explode_words
from tradewake.plans import stats
from tradewake.schemas import (COMMENT_INFO, KEYWORD_STATS, ORDER_WIDE, PAGE_LOG, PAGE_VIEW_SQL,
                               PRODUCT_STATS, REFUND_INFO, VISITOR_STATS)


def test_visitor_stats(spark):
    page = page_rows(spark, [("a", 1000, True), ("a", 2000, False), ("b", 12_000, True)])
    out = stats.visitor_stats(page, page.filter("offset = 0"), page.filter("offset = 2"),
                              as_of_ms=5)
    assert out.schema.fieldNames() == VISITOR_STATS.fieldNames()
    got = sorted((r.stt[-8:], r.edt[-8:], r.uv_ct, r.pv_ct, r.sv_ct, r.uj_ct, r.dur_sum, r.ts)
                 for r in out.collect())
    assert got == [("00:00:00", "00:00:10", 1, 2, 1, 0, 14, 5),
                   ("00:00:10", "00:00:20", 0, 1, 1, 1, 7, 5)]


def product_page(spark):
    return spark.createDataFrame([
        (None, ("good_detail", None, "7", None), [("sku_id", "8"), ("promo", "9")], 1000),
        (None, ("good_detail", None, "seven", None), None, 1000),
        (None, ("home", None, "7", None), [("sku_id", "7"), ("sku_id", "x")], 2000)], PAGE_LOG)


def test_product_clicks_and_displays(spark):
    page = product_page(spark)
    assert sorted(str(r.sku_id) for r in measures.click_rows(page).collect()) == ["7", "None"]
    assert sorted(str(r.sku_id) for r in measures.display_rows(page).collect()) == [
        "7", "8", "None"]
    both = measures.click_and_display_rows(page)
    assert both.agg(F.sum("click_ct"), F.sum("display_ct")).collect()[0][:] == (2, 3)
    assert sorted(r.item for r in measures.unreadable_products(page).collect()) == ["seven", "x"]


def rows(spark, schema, *values):
    return spark.createDataFrame(
        [tuple(v.get(f.name) for f in schema) for v in values], schema)


def test_product_stats(spark):
    at = "1970-01-01 08:00:03"
    orders = rows(spark, ORDER_WIDE, *[
        dict(sku_id=7, order_id=o, sku_num=n, split_total_amount=Decimal(a), create_time=at)
        for o, n, a in ((1, 2, "1.50"), (1, 1, "2.00"), (2, 4, "0.25"))])
    refund = rows(spark, REFUND_INFO, dict(sku_id=7, order_id=1, refund_amount=Decimal("1.00"),
                                           create_time=at))
    comment = rows(spark, COMMENT_INFO, dict(sku_id=7, appraise="1201", create_time=at),
                   dict(sku_id=7, appraise="1203", create_time=at))
    out = stats.product_stats(page=product_page(spark), order_wide=orders, refund=refund,
                              comment=comment, as_of_ms=1)
    assert out.schema.fieldNames() == PRODUCT_STATS.fieldNames()
    r = {x.sku_id: x for x in out.collect()}
    assert sorted(r) == [7, 8]
    seven = r[7]
    assert (seven.click_ct, seven.display_ct, seven.order_ct, seven.order_sku_num) == (1, 1, 2, 7)
    assert (seven.order_amount, seven.refund_amount) == (Decimal("3.75"), Decimal("1.00"))
    assert (seven.refund_order_ct, seven.paid_order_ct, seven.favor_ct) == (1, 0, 0)
    assert (seven.comment_ct, seven.good_comment_ct) == (2, 1)
    assert (r[8].display_ct, r[8].order_amount) == (1, Decimal("0.00"))


def search_page(spark, *items):
    return spark.createDataFrame(
        [({"mid": "a"}, {"page_id": p, "item": i}, ts) for p, i, ts in items], PAGE_VIEW_SQL)


def test_search_keywords(spark):
    page = search_page(spark, ("good_list", "Red shoe", 12_000), ("good_list", "red SHOE", 18_000),
                       ("good_list", None, 12_000), ("good_list", "--", 12_000),
                       ("home", "hat", 12_000))
    out = stats.search_keywords(page, as_of_ms=3)
    assert out.schema.fieldNames() == KEYWORD_STATS.fieldNames()
    assert sorted((r.keyword, r.ct, r.source, r.stt[-8:], r.edt[-8:], r.ts)
                  for r in out.collect()) == [
        ("red", 2, "SEARCH", "00:00:10", "00:00:20", 3),
        ("shoe", 2, "SEARCH", "00:00:10", "00:00:20", 3)]


def test_counts_add_up_to_the_words(spark):
    page = search_page(spark, *[("good_list", f"w{i % 3} x y{i % 5}", i * 777) for i in range(60)])
    assert stats.search_keywords(page).agg(F.sum("ct")).first()[0] == 180


def test_product_keywords(spark):
    df = spark.createDataFrame(
        [("red shoe", 3, 0, 1, "2021-06-18 00:00:00", "2021-06-18 00:00:10"),
         (None, 3, 3, 3, "2021-06-18 00:00:00", "2021-06-18 00:00:10")],
        "spu_name string, click_ct bigint, cart_ct bigint, order_ct bigint, stt string, edt string")
    out = stats.product_keywords(df, as_of_ms=1)
    assert out.schema.fieldNames() == ["keyword", "ct", "source", "stt", "edt", "ts"]
    assert sorted((r.keyword, r.ct, r.source) for r in out.collect()) == [
        ("red", 1, "ORDER"), ("red", 3, "CLICK"), ("shoe", 1, "ORDER"), ("shoe", 3, "CLICK")]


def test_sql_functions_match_the_dataframe_form(spark):
    register_functions(spark)
    spark.createDataFrame([("Red shoe-2", 3, 0, 1), ("", 1, 1, 1)],
                          "spu_name string, click_ct bigint, cart_ct bigint, order_ct bigint"
                          ).createOrReplaceTempView("named")
    sql = spark.sql("""
        SELECT keyword, ct, source FROM named, LATERAL ik_analyze(spu_name) AS T(keyword),
        LATERAL keywordProductC2R(click_ct, cart_ct, order_ct) AS T2(ct, source)""")
    df = explode_counts(explode_words(spark.table("named"), "spu_name"))
    want = sorted(tuple(r) for r in df.select("keyword", "ct", "source").collect())
    assert sorted(tuple(r) for r in sql.collect()) == want
    text = sql._jdf.queryExecution().executedPlan().toString()
    assert text.count("Generate") == 2 and "Join" not in text and "Python" not in text


def test_stop_words(spark):
    df = spark.createDataFrame([("The shoe of it",)], "t string")
    assert [r.keyword for r in explode_words(df, "t", stop_words=("the", "of")).collect()] == [
        "shoe", "it"]


def test_distinct_orders_cost_one_shuffle_more_than_sums(spark):
    orders = rows(spark, ORDER_WIDE, *[
        dict(sku_id=7, order_id=o, sku_num=1, split_total_amount=Decimal("1.00"),
             create_time="1970-01-01 08:00:03") for o in (1, 1, 2, None)])
    out = stats.product_stats(order_wide=orders)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    (row,) = out.collect()
    assert (row.order_ct, row.order_sku_num, row.order_amount) == (2, 4, Decimal("4.00"))
