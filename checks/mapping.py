"""The test tables seen as the inputs of the warehouse. Every mapping works row by row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewake.functions.times import TEXT_FORMAT
from tradewake.schemas import MONEY, TABLE_PROCESS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same table as a stream of files."""
    schema = table(spark, sf_dir, name).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
    return reader.parquet(sf_dir)


def by_time(df: DataFrame, time: str, parts: int) -> list[DataFrame]:
    """All rows of a table in ``parts`` of about equal size, earlier ones first, as they would have
    arrived. Rows without a time are in the first."""
    if parts < 2:
        return [df]
    at = F.unix_micros(utc(time))
    shares = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    ends = df.select(F.percentile_approx(at, shares)).first()[0]
    if ends is None:  # no row has a time
        ends = [0] * (parts - 1)
    cut = [F.coalesce(at < ends[0], F.lit(True))]
    cut += [(at >= low) & (at < high) for low, high in zip(ends, ends[1:])]
    return [df.filter(c) for c in (*cut, at >= ends[-1])]


def utc(c: str) -> Column:
    return F.col(c).cast("timestamp")


def money(c: str) -> Column:
    return F.col(c).cast(MONEY)


def time_text(c: str) -> Column:
    return F.date_format(c, TEXT_FORMAT)


def page_log(events: DataFrame, *extra: Column) -> DataFrame:
    """Events as page logs; ``event_id`` stays as the tie-break between equal times."""
    events = events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    k, kind = F.col("k"), F.col("event_type")
    page_id = (F.when(kind == "view", "good_list").when(kind == "click", "good_detail")
               .when(kind == "purchase", "payment").when(kind == "signup", "home").otherwise(""))
    item = F.when(kind == "view", F.concat(F.lit("View Item-"), k.cast("string")))
    shown = F.transform(
        F.slice(F.array(k, k + 1, k + 2), 1, k % 4),
        lambda x: F.struct(F.when(x % 3 == 0, "promotion").otherwise("sku_id").alias("item_type"),
                           x.cast("string").alias("item")))
    return events.select(
        "event_id",
        F.struct(
            F.col("user_id").cast("string").alias("mid"),
            F.when(kind == "signup", "1").otherwise("0").alias("is_new"),
            F.concat(F.lit("v"), (k % 3).cast("string")).alias("vc"),
            kind.alias("ch"),
            F.concat(F.lit("r"), (F.col("user_id") % 5).cast("string")).alias("ar"),
        ).alias("common"),
        F.struct(
            page_id.alias("page_id"),
            F.when(k < 50, F.lit(None)).when(k < 60, "").otherwise("home").alias("last_page_id"),
            F.coalesce(item, k.cast("string")).alias("item"),
            F.floor("value").cast("bigint").alias("during_time"),
        ).alias("page"),
        F.when(kind == "view", shown).alias("display"),
        F.unix_millis(utc("ts")).alias("ts"),
        *extra,
    )


def raw_log(events: DataFrame) -> DataFrame:
    """Events as raw log text: sign-ups are start logs, some texts are cut or lack a device."""
    kind = F.col("event_type")
    start = (F.when(kind == "signup", F.create_map(F.lit("entry"), F.lit("icon")))
             .when(kind == "error", F.create_map().cast("map<string,string>")))
    logs = page_log(events, start.alias("start"), F.col("k"))
    whole = F.to_json(F.struct("common", "start", "page", "display", "ts"))
    no_device = F.to_json(F.struct("page", "ts"))
    return logs.select(
        "event_id",
        F.when(F.col("k") == 99, F.substring(whole, 1, 30))
        .when(F.col("k") == 98, no_device).otherwise(whole).alias("value"),
    )


def order_info(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").alias("id"), (F.col("o_custkey") % 25).alias("province_id"),
        F.col("o_orderstatus").alias("order_status"), F.col("o_custkey").alias("user_id"),
        money("o_totalprice").alias("total_amount"),
        F.lit(0).cast(MONEY).alias("activity_reduce_amount"),
        F.lit(0).cast(MONEY).alias("coupon_reduce_amount"),
        money("o_totalprice").alias("original_total_amount"),
        F.lit(0).cast(MONEY).alias("feight_fee"),
        F.lit(None).cast("string").alias("expire_time"),
        time_text("o_orderdate").alias("create_time"),
        F.lit(None).cast("string").alias("operate_time"),
        F.lit(None).cast("string").alias("create_date"),
        F.lit(None).cast("string").alias("create_hour"),
    )


def order_detail(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.col("l_linenumber").cast("bigint").alias("id"), F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"), money("l_extendedprice").alias("order_price"),
        F.col("l_quantity").cast("bigint").alias("sku_num"),
        F.lit(None).cast("string").alias("sku_name"),
        time_text("l_shipdate").alias("create_time"),
        money("l_extendedprice").alias("split_total_amount"),
        money("l_discount").alias("split_activity_amount"),
        money("l_tax").alias("split_coupon_amount"),
    )


def payment_info(events: DataFrame) -> DataFrame:
    """Purchases as payments; the user stands for the order."""
    at = time_text("ts")
    return events.filter(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("id"), F.col("user_id").alias("order_id"), "user_id",
        money("value").alias("total_amount"), F.col("event_type").alias("subject"),
        F.lit("1101").alias("payment_type"), at.alias("create_time"), at.alias("callback_time"),
    )


def clicked_orders(events: DataFrame) -> DataFrame:
    """Clicks as order rows, to be found by later payments."""
    return events.filter(F.col("event_type") == "click").select(
        F.col("event_id").alias("detail_id"), F.col("user_id").alias("order_id"),
        F.get_json_object("props", "$.k").cast("bigint").alias("sku_id"),
        F.lit(-1).cast("bigint").alias("user_id"), money("value").alias("total_amount"),
        money("value").alias("split_total_amount"), time_text("ts").alias("create_time"),
    )


def line_orders(lineitem: DataFrame) -> DataFrame:
    """Line items as order-wide rows, as far as product statistics read them."""
    return lineitem.select(
        F.col("l_partkey").alias("sku_id"), F.col("l_orderkey").alias("order_id"),
        F.col("l_quantity").cast("bigint").alias("sku_num"),
        money("l_extendedprice").alias("split_total_amount"),
        time_text("l_shipdate").alias("create_time"),
    )


def line_payments(lineitem: DataFrame) -> DataFrame:
    at = time_text("l_shipdate")
    return lineitem.filter(F.col("l_linestatus") == "F").select(
        F.col("l_partkey").alias("sku_id"), F.col("l_orderkey").alias("order_id"),
        money("l_extendedprice").alias("split_total_amount"),
        at.alias("payment_create_time"), at.alias("callback_time"),
    )


def line_refunds(lineitem: DataFrame) -> DataFrame:
    return lineitem.filter(F.col("l_returnflag") == "R").select(
        F.col("l_partkey").alias("sku_id"), F.col("l_orderkey").alias("order_id"),
        money("l_extendedprice").alias("refund_amount"),
        time_text("l_shipdate").alias("create_time"),
    )


def sku_events(events: DataFrame, kind: str) -> DataFrame:
    """Events of one kind as records about a SKU: favourites, cart entries or comments."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    return events.filter(F.col("event_type") == kind).select(
        F.col("event_id").alias("id"), "user_id", k.alias("sku_id"),
        (1201 + k % 4).cast("string").alias("appraise"), time_text("ts").alias("create_time"),
    )


def users(customer: DataFrame) -> DataFrame:
    born = F.date_add(F.lit("1950-01-01").cast("date"), (F.col("c_custkey") % 20000).cast("int"))
    return customer.select(
        F.col("c_custkey").cast("string").alias("ID"), born.cast("string").alias("BIRTHDAY"),
        F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("M").alias("GENDER"))


def provinces(nation: DataFrame) -> DataFrame:
    key = F.col("n_nationkey").cast("string")
    return nation.select(
        key.alias("ID"), F.col("n_name").alias("NAME"),
        F.col("n_regionkey").cast("string").alias("AREA_CODE"),
        F.concat(F.lit("N-"), key).alias("ISO_CODE"),
        F.concat(F.lit("ISO-"), key).alias("ISO_3166_2"))


def skus(part: DataFrame) -> DataFrame:
    key = F.col("p_partkey")
    return part.select(
        key.cast("string").alias("ID"), F.col("p_name").alias("SKU_NAME"),
        money("p_retailprice").cast("string").alias("PRICE"),
        (key % 1000).cast("string").alias("SPU_ID"), (key % 7).cast("string").alias("TM_ID"),
        F.col("p_size").cast("string").alias("CATEGORY3_ID"))


def spus(supplier: DataFrame) -> DataFrame:
    return supplier.select(F.col("s_suppkey").cast("string").alias("ID"),
                           F.col("s_name").alias("SPU_NAME"))


def trademarks(region: DataFrame) -> DataFrame:
    return region.select(F.col("r_regionkey").cast("string").alias("ID"),
                         F.col("r_name").alias("TM_NAME"))


def categories(nation: DataFrame) -> DataFrame:
    return nation.select(F.col("n_nationkey").cast("string").alias("ID"),
                         F.col("n_name").alias("NAME"))


def _envelope(df: DataFrame, name: str, kind: str, ts: Column, /, **data: str) -> DataFrame:
    body = [F.col(c).alias(n) for n, c in data.items()]
    payload = F.struct(*body) if body else F.create_map().cast("map<string,string>")
    return df.select(F.to_json(F.struct(
        F.lit(name).alias("table"), F.lit(kind).alias("type"), payload.alias("data"),
        ts.cast("bigint").alias("ts"))).alias("value"))


def order_changes(orders: DataFrame) -> DataFrame:
    return _envelope(orders, "order_info", "insert", F.unix_millis(utc("o_orderdate")),
                     id="o_orderkey", user_id="o_custkey", status="o_orderstatus")


def user_changes(customer: DataFrame) -> DataFrame:
    return _envelope(customer, "user_info", "bootstrap-insert", F.lit(0),
                     id="c_custkey", name="c_name", segment="c_mktsegment")


def change_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change records of six tables; three of them lead nowhere."""
    zero = F.lit(0)
    parts = [
        order_changes(table(spark, sf_dir, "orders")),
        user_changes(table(spark, sf_dir, "customer")),
        _envelope(table(spark, sf_dir, "nation"), "base_province", "insert", zero,
                  id="n_nationkey", name="n_name", region_id="n_regionkey"),
        _envelope(table(spark, sf_dir, "part"), "sku_info", "insert", zero,
                  id="p_partkey", name="p_name"),
        _envelope(table(spark, sf_dir, "supplier"), "order_info", "update", zero,
                  id="s_suppkey", name="s_name"),
        _envelope(table(spark, sf_dir, "region"), "base_province", "insert", zero),
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows


def routing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([
        ("order_info", "insert", "kafka", "dwd_order_info", "id,user_id", None, None),
        ("user_info", "insert", "hbase", "dim_user_info", None, None, None),
        ("base_province", "insert", "hbase", "dim_base_province", "id,name", "id", None),
        ("sku_info", "insert", "clickhouse", "sku_info", None, None, None),
    ], TABLE_PROCESS)


def user_updates(orders: DataFrame) -> DataFrame:
    """Orders as updates of their user: the status of the newest one stays."""
    # Unique per user and day, so that the newest is one.
    ts = F.unix_millis(utc("o_orderdate")) + F.col("o_orderkey") % 86_400_000
    return _envelope(orders, "user_info", "update", ts, id="o_custkey", name="o_orderstatus",
                     segment="o_orderkey")


def arrivals(events: DataFrame, batch: int) -> DataFrame:
    """The events that arrive in one of four batches of eight days of a month; one in seven comes a
    batch late, one in fifty two."""
    late = F.when(F.col("event_id") % 50 == 0, 2).when(F.col("event_id") % 7 == 0, 1).otherwise(0)
    due = F.floor((F.dayofmonth("ts") - 1) / 8)
    return events.where(F.least(F.lit(3), due + late) == batch)


def paid_orders(orders: DataFrame) -> DataFrame:
    """Orders as payments 30 days after the order."""
    at = F.date_format(F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS"), TEXT_FORMAT)
    return orders.select(
        (F.col("o_orderkey") * 10).alias("id"), F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"), money("o_totalprice").alias("total_amount"),
        F.col("o_orderstatus").alias("subject"), F.lit("1101").alias("payment_type"),
        time_text("o_orderdate").alias("create_time"), at.alias("callback_time"))


def shipped_orders(lineitem: DataFrame) -> DataFrame:
    """Line items as order-wide rows, created when they were shipped."""
    return lineitem.select(
        F.col("l_linenumber").cast("bigint").alias("detail_id"), F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"), F.col("l_quantity").cast("bigint").alias("sku_num"),
        F.lit(-1).cast("bigint").alias("user_id"), money("l_extendedprice").alias("total_amount"),
        money("l_extendedprice").alias("split_total_amount"),
        time_text("l_shipdate").alias("create_time"))
