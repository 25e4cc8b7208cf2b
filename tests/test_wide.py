from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tradewake.operators.enrich import Dimension, enrich, enrich_all
from tradewake.operators.interval import interval_join
from tradewake.plans import wide
from tradewake.schemas import ORDER_DETAIL, ORDER_INFO, ORDER_WIDE, PAYMENT_INFO, PAYMENT_WIDE


def row(schema, **values):
    return tuple(values.get(f.name) for f in schema)


def timed(spark, rows):
    df = spark.createDataFrame(rows, "k bigint, ms bigint")
    return df.withColumn("t", F.timestamp_millis("ms"))


def joined(spark, left, right, low, high, salts=1):
    out = interval_join(timed(spark, left), timed(spark, right), "k", "k", "t", "t", low, high,
                        salts)
    return sorted((r[0], r[1]) for r in out.select("l.ms", "r.ms").collect())


@pytest.mark.parametrize("gap, hit", [(-5, 1), (5, 1), (0, 1), (-6, 0), (6, 0)])
def test_interval_bounds_are_inclusive(spark, gap, hit):
    assert len(joined(spark, [(1, 86_400_000)], [(1, 86_400_000 + gap)], -5, 5)) == hit


def test_interval_join_against_brute_force(spark):
    left = [(i % 3, (i * 7919) % 90_000) for i in range(120)]
    right = [(i % 4, (i * 6007) % 90_000) for i in range(150)]
    for low, high in ((-2000, 500), (-10_000, 0), (300, 300), (0, 90_000)):
        want = sorted((a, b) for k, a in left for j, b in right
                      if k == j and a + low <= b <= a + high)
        assert joined(spark, left, right, low, high) == want
        assert joined(spark, left, right, low, high, salts=3) == want


def test_interval_join_rejects_an_empty_interval(spark):
    with pytest.raises(ValueError):
        joined(spark, [(1, 0)], [(1, 0)], 5, -5)


def order(id=1, create_time="2021-06-18 11:09:00", **more):
    return row(ORDER_INFO, id=id, user_id=7, province_id=3, total_amount=Decimal("9.50"),
               order_status="1001", expire_time="x", operate_time="y",
               create_time=create_time, **more)


def detail(id=10, order_id=1, create_time="2021-06-18 23:00:00"):
    return row(ORDER_DETAIL, id=id, order_id=order_id, sku_id=5, sku_num=2,
               split_total_amount=Decimal("4.75"), create_time=create_time)


def orders(spark, *rows):
    return spark.createDataFrame(rows, ORDER_INFO)


def details(spark, *rows):
    return spark.createDataFrame(rows, ORDER_DETAIL)


def test_order_wide_merges_fields(spark):
    out = wide.order_wide(orders(spark, order()), details(spark, detail()))
    assert out.schema.fieldNames() == ORDER_WIDE.fieldNames()
    r = out.collect()[0]
    assert (r.order_id, r.detail_id, r.user_id, r.sku_num) == (1, 10, 7, 2)
    assert (r.create_date, r.create_hour) == ("2021-06-18", "11")
    assert (r.total_amount, r.split_total_amount) == (Decimal("9.50"), Decimal("4.75"))
    assert r.expire_time is None and r.operate_time is None and r.split_feight_fee is None


def test_order_wide_by_day_or_second(spark):
    o, d = orders(spark, order()), details(
        spark, detail(), detail(), detail(11, create_time="2021-06-19 00:00:00"), detail(12, 2))
    assert [r.detail_id for r in wide.order_wide(o, d).collect()] == [10, 10]
    assert wide.order_wide(o, d, precision="second").count() == 0
    same = details(spark, detail(create_time="2021-06-18 11:09:00"))
    assert wide.order_wide(o, same, precision="second").count() == 1


def test_payment_wide(spark):
    ow = spark.createDataFrame([
        row(ORDER_WIDE, detail_id=i, order_id=1, user_id=99, total_amount=Decimal("1.00"),
            create_time=t) for i, t in enumerate((
                "2021-06-18 12:00:00", "2021-06-18 11:30:00", "2021-06-18 11:29:59",
                "2021-06-18 12:00:01"))], ORDER_WIDE)
    paid = spark.createDataFrame([row(
        PAYMENT_INFO, id=50, order_id=1, user_id=7, total_amount=Decimal("2.00"), subject="s",
        create_time="2021-06-18 11:59:00", callback_time="2021-06-18 12:00:00")], PAYMENT_INFO)
    out = wide.payment_wide(paid, ow)
    assert out.schema.fieldNames() == PAYMENT_WIDE.fieldNames()
    rows = sorted(out.collect(), key=lambda r: r.detail_id)
    assert [r.detail_id for r in rows] == [0, 1]
    r = rows[1]
    assert (r.payment_id, r.user_id, r.total_amount) == (50, 7, Decimal("2.00"))
    assert r.order_create_time == "2021-06-18 11:30:00"
    assert r.payment_create_time == "2021-06-18 11:59:00"


def test_missing_dimension_keeps_the_row(spark):
    out = wide.order_wide(orders(spark, order()), details(spark, detail()))
    users = spark.createDataFrame([("8", "2000-01-01", "F")],
                                  "ID string, BIRTHDAY string, GENDER string")
    as_of = F.lit("2021-06-18").cast("date")
    r = enrich(out, wide.user_dimension(users, as_of)).collect()[0]
    assert r.user_age is None and r.user_gender is None
    known = users.union(spark.createDataFrame([("7", "2000-01-01", "M")], users.schema))
    r = enrich(out, wide.user_dimension(known, as_of)).collect()[0]
    assert (r.user_age, r.user_gender) == (21, "M")


def test_duplicate_dimension_keys_do_not_fan_out(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, x string")
    dim = spark.createDataFrame([("1", "old", 2), ("1", "first", 1)],
                                "ID string, NAME string, seq int")
    out = enrich(facts, Dimension(dim, {"id": "ID"}, {"name": "NAME"}, order=("seq",)))
    assert sorted((r.id, r.name) for r in out.collect()) == [(1, "first"), (2, None)]


def test_chained_lookups(spark):
    facts = spark.createDataFrame([(5,), (6,)], "sku_id bigint")
    skus = spark.createDataFrame([("5", "50", "1", "2")],
                                 "ID string, SPU_ID string, TM_ID string, CATEGORY3_ID string")
    spus = spark.createDataFrame([("50", "phone")], "ID string, SPU_NAME string")
    out = enrich_all(facts, wide.product_dimensions(skus, spus))
    assert sorted((r.sku_id, r.spu_id, r.spu_name) for r in out.collect()) == [
        (5, 50, "phone"), (6, None, None)]


def test_salted_lookup_gives_the_same_rows(spark):
    facts = spark.createDataFrame([(1, i) for i in range(50)] + [(2, 0)], "id bigint, n int")
    dim = spark.createDataFrame([("1", "one")], "ID string, NAME string")
    out = enrich(facts, Dimension(dim, {"id": "ID"}, {"name": "NAME"}, salts=4))
    assert out.columns == ["id", "n", "name"]
    assert sorted((r.id, r.n, r.name) for r in out.collect()) == (
        [(1, i, "one") for i in range(50)] + [(2, 0, None)])


def test_interval_join_of_one_hot_key_compares_neighbours_only(spark):
    """All rows share a key: all pairs would be 3.6 billion, matching ones are 11 per row."""
    def rows():
        return spark.range(60_000).select(
            F.lit(1).alias("k"), F.timestamp_millis(F.col("id") * 1000).alias("t"))
    out = interval_join(rows(), rows(), "k", "k", "t", "t", -5000, 5000)
    assert out.count() == 60_000 * 11 - 2 * (5 + 4 + 3 + 2 + 1)
