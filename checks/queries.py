"""One query per operator over the test tables; whole tables, no row limits."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import mapping as m
from tradewake import constants as C
from tradewake import schemas as S
from tradewake.functions import times
from tradewake.functions.codes import code_label
from tradewake.functions.records import CORRUPT, parse_rows, to_values
from tradewake.functions.registry import register_functions
from tradewake.functions.text import camel_columns, in_comma_list, is_blank, joined_key
from tradewake.operators import distinct, measures
from tradewake.operators.enrich import Dimension, enrich
from tradewake.operators.lateral import explode_words
from tradewake.operators.sequence import match_sequence
from tradewake.plans import cdc, logs, stats, visits, wide
from tradewake.session import shared_dir
from tradewake.sources.buckets import BucketedDimension
from tradewake.sources.dims import DimStore, part_of
from tradewake.sources.topics import FileTopics
from tradewake.streaming import jobs
from tradewake.streaming.late import start_with_late
from tradewake.streaming.run import (drain, drain_to_folder, finish, release_shuffles,
                                     start_batches, state_parts, state_rows, stream_settings)
from tradewake.streaming.visitors import logs_beside_first_days, repair_batch

BOUNCE_S = 4 * 3600
LOOKBACK_S = 6 * 3600
MONTH_MS = 30 * 86_400_000
AS_OF_MS = 1_700_000_000_000
COMPRESSION = "lz4"  # of the topics' text
# Rows of the tables that arrive between two runs of a job.
SLICE_ROWS = 50_000_000
ORDER = ("ts", "event_id")
VISITOR_COLUMNS = ["event_id", "common", "page", "ts"]  # what visitor statistics read

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def page(spark: SparkSession, sf: str) -> DataFrame:
    return m.page_log(m.table(spark, sf, "events"))


def flat(df: DataFrame, *more: str) -> DataFrame:
    return df.select("event_id", "common.mid", "common.is_new", "page.page_id", "ts", *more)


def doubles(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that both engines print them alike."""
    return df.select(*[
        F.col(f.name).cast("double").alias(f.name)
        if f.dataType.typeName() == "decimal" else F.col(f.name) for f in df.schema])


# Page logs


@query
def bounces(spark, sf):
    return flat(visits.bounces(page(spark, sf), BOUNCE_S, ORDER))


@query
def entry_pages(spark, sf):
    return flat(page(spark, sf).filter(measures.entry_page()))


@query
def valid_pages(spark, sf):
    return flat(page(spark, sf).filter(measures.valid_page()))


@query
def unique_visits(spark, sf):
    return flat(visits.unique_visits(page(spark, sf), entry_only=False, order=ORDER))


@query
def unique_entry_visits(spark, sf):
    return flat(visits.unique_visits(page(spark, sf), order=ORDER))


@query
def repair_is_new(spark, sf):
    return flat(logs.repair_is_new(page(spark, sf)))


def _parsed(spark, sf):
    return logs.parse_logs(m.raw_log(m.table(spark, sf, "events")), keep=("event_id",))


@query
def split_logs_start(spark, sf):
    split = logs.split_logs(logs.valid_logs(_parsed(spark, sf)))
    return flat(split.start, "start.entry")


@query
def split_logs_page(spark, sf):
    split = logs.split_logs(logs.valid_logs(_parsed(spark, sf)))
    return split.page.select(
        "event_id", "common.mid", "page.page_id", "page.last_page_id", "page.item",
        "page.during_time", "ts", F.size(F.coalesce("display", F.array())).alias("displays"))


@query
def split_logs_display(spark, sf):
    split = logs.split_logs(logs.valid_logs(_parsed(spark, sf)))
    return split.display.select("page_id", "item_type", "item")


@query
def quarantine(spark, sf):
    return logs.quarantined_logs(_parsed(spark, sf)).select("event_id")


@query
def visitor_rows(spark, sf):
    p = page(spark, sf)
    rows = [measures.page_view_rows(p), measures.session_rows(p),
            measures.unique_visit_rows(
                visits.unique_visits(p, order=ORDER, columns=VISITOR_COLUMNS)),
            measures.jump_rows(visits.bounces(p, BOUNCE_S, ORDER, columns=VISITOR_COLUMNS))]
    return stats.union_all(rows)


@query
def visitor_stats(spark, sf):
    p = page(spark, sf)
    return stats.visitor_stats(
        p, visits.unique_visits(p, order=ORDER, columns=VISITOR_COLUMNS),
        visits.bounces(p, BOUNCE_S, ORDER, columns=VISITOR_COLUMNS),
        window="1 hour", as_of_ms=AS_OF_MS)


@query
def product_clicks_displays(spark, sf):
    p = page(spark, sf)
    rows = stats.union_all([measures.click_rows(p), measures.display_rows(p)])
    return rows.select("sku_id", F.coalesce("click_ct", F.lit(0)).alias("click_ct"),
                       F.coalesce("display_ct", F.lit(0)).alias("display_ct"), "ts")


@query
def product_page_rows(spark, sf):
    return measures.click_and_display_rows(page(spark, sf))


@query
def unreadable_products(spark, sf):
    """Searches taken as products: none of their items is a SKU."""
    p = page(spark, sf)
    as_detail = F.col("page").withField("page_id", F.lit("good_detail"))
    return measures.unreadable_products(p.withColumn("page", as_detail)).select("item", "ts")


# Change records


def _routed(spark, sf):
    return cdc.route_cdc(cdc.parse_cdc(m.change_records(spark, sf)), m.routing(spark))


@query
def route_cdc_facts(spark, sf):
    return cdc.fact_messages(_routed(spark, sf).facts)


@query
def route_cdc_dims(spark, sf):
    return _routed(spark, sf).dims.select(
        "sink_table", "sink_pk", "type", F.col("data")["id"].cast("string").alias("id"),
        F.col("data")["name"].cast("string").alias("name"), F.col("data")["segment"].cast("string").alias("segment"),
        F.col("data")["region_id"].cast("string").alias("region_id"))


@query
def dim_rows(spark, sf):
    return cdc.dim_rows(_routed(spark, sf).dims, "dim_base_province", "id,name")


@query
def upsert_dim(spark, sf):
    events = m.table(spark, sf, "events").withColumn("ts", F.unix_millis(m.utc("ts")))
    stored = events.filter(F.col("event_type") == "signup")
    changes = events.filter(F.col("event_type") != "signup")
    return cdc.upsert_dim(stored, changes, ["user_id"], ORDER)


# Wide tables


def _month_wide(spark, sf, dims=()):
    return wide.order_wide(
        m.order_info(m.table(spark, sf, "orders")), m.order_detail(m.table(spark, sf, "lineitem")),
        -MONTH_MS, MONTH_MS, dims=dims)


@query
def order_wide(spark, sf):
    return doubles(_month_wide(spark, sf).select(
        "detail_id", "order_id", "sku_id", "order_price", "sku_num", "order_status", "user_id",
        "province_id", "total_amount", "original_total_amount", "feight_fee",
        "split_activity_amount", "split_coupon_amount", "split_total_amount", "create_time",
        "create_date", "create_hour", "expire_time", "operate_time"))


def _dimensions(spark, sf):
    return wide.order_dimensions(
        m.users(m.table(spark, sf, "customer")), m.provinces(m.table(spark, sf, "nation")),
        m.skus(m.table(spark, sf, "part")), m.spus(m.table(spark, sf, "supplier")),
        m.trademarks(m.table(spark, sf, "region")), m.categories(m.table(spark, sf, "nation")),
        as_of=F.lit("2024-01-01").cast("date"))


@query
def order_wide_dims(spark, sf):
    return doubles(_month_wide(spark, sf, _dimensions(spark, sf)).select(
        "detail_id", "order_id", "sku_id", "order_price", "user_age", "user_gender",
        "province_name", "province_area_code", "province_iso_code", "province_3166_2_code",
        "spu_id", "spu_name", "tm_id", "tm_name", "category3_id", "category3_name"))


@query
def day_precision_join(spark, sf):
    orders = m.table(spark, sf, "orders")
    later = F.timestamp_seconds(
        F.unix_seconds(m.utc("o_orderdate")) + (F.col("o_orderkey") % 30) * 3600)
    details = orders.select(
        F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("order_id"),
        F.date_format(later, times.TEXT_FORMAT).alias("create_time"),
        *[F.lit(None).cast(t).alias(n) for n, t in (
            ("sku_id", "bigint"), ("order_price", m.MONEY), ("sku_num", "bigint"),
            ("sku_name", "string"), ("split_total_amount", m.MONEY),
            ("split_activity_amount", m.MONEY), ("split_coupon_amount", m.MONEY))])
    return wide.order_wide(m.order_info(orders), details).select(
        "order_id", "detail_id", "create_date")


@query
def payment_wide(spark, sf):
    events = m.table(spark, sf, "events")
    paid = wide.payment_wide(m.payment_info(events), m.clicked_orders(events), LOOKBACK_S)
    return doubles(paid.select(
        "payment_id", "detail_id", "order_id", "sku_id", "user_id", "total_amount",
        "split_total_amount", "subject", "payment_type", "payment_create_time", "callback_time",
        "order_create_time"))


@query
def first_hit_lookup(spark, sf):
    customer = m.table(spark, sf, "customer")
    dim = Dimension(customer, {"c_nationkey": "c_nationkey", "c_mktsegment": "c_mktsegment"},
                    {"first_name": "c_name"}, order=("c_custkey",))
    return enrich(customer.select("c_custkey", "c_nationkey", "c_mktsegment"), dim)


# Statistics


def _searched(spark, sf):
    part = m.table(spark, sf, "part").select("p_partkey", F.col("p_name").alias("fullword"))
    shipped = m.table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("p_partkey"), m.utc("l_shipdate").alias("rowtime"))
    return shipped.join(part, "p_partkey")


@query
def search_keywords(spark, sf):
    return stats.keyword_counts(_searched(spark, sf), "1 day", AS_OF_MS)


@query
def page_keywords(spark, sf):
    return stats.search_keywords(page(spark, sf), "1 hour", AS_OF_MS)


@query
def sql_keywords(spark, sf):
    register_functions(spark)
    page(spark, sf).createOrReplaceTempView("page_view")
    return spark.sql(f"""
        SELECT keyword, count(*) AS ct, '{C.KEYWORD_SEARCH}' AS source,
               date_format(window.start, 'yyyy-MM-dd HH:mm:ss') AS stt,
               date_format(window.end, 'yyyy-MM-dd HH:mm:ss') AS edt
        FROM (SELECT keyword, rowtime
              FROM (SELECT page['item'] AS fullword, timestamp_seconds(ts div 1000) AS rowtime
                    FROM page_view
                    WHERE page['page_id'] = 'good_list' AND page['item'] IS NOT NULL),
                   LATERAL ik_analyze(fullword) AS t(keyword))
        GROUP BY window(rowtime, '10 seconds'), keyword""")


@query
def tokenize_documents(spark, sf):
    found = explode_words(m.table(spark, sf, "documents").select("text"), "text")
    return found.groupBy("keyword").agg(F.count("*").alias("ct"))


def _product_inputs(spark, sf):
    events, lineitem = m.table(spark, sf, "events"), m.table(spark, sf, "lineitem")
    return dict(
        page=m.page_log(events), favor=m.sku_events(events, "signup"),
        cart=m.sku_events(events, "purchase"), comment=m.sku_events(events, "error"),
        order_wide=m.line_orders(lineitem), payment_wide=m.line_payments(lineitem),
        refund=m.line_refunds(lineitem))


@query
def product_stats(spark, sf):
    named = [stats.sku_dimension(m.skus(m.table(spark, sf, "part"))),
             *wide.product_dimensions(spus=m.spus(m.table(spark, sf, "supplier")),
                                      trademarks=m.trademarks(m.table(spark, sf, "region")),
                                      categories=m.categories(m.table(spark, sf, "nation")))]
    return doubles(stats.product_stats(
        **_product_inputs(spark, sf), window="1 day", dims=named, as_of_ms=AS_OF_MS))


@query
def product_keywords(spark, sf):
    named = Dimension(m.skus(m.table(spark, sf, "part")), {"sku_id": "ID"},
                      {"spu_name": "SKU_NAME"})
    counted = stats.product_stats(**_product_inputs(spark, sf), window="1 day", dims=[named])
    return stats.product_keywords(counted, AS_OF_MS)


# Scalars


@query
def parse_times(spark, sf):
    at = F.timestamp_seconds(F.unix_seconds(m.utc("o_orderdate")) + F.col("o_orderkey") % 86400)
    orders = m.table(spark, sf, "orders").select(
        "o_orderkey", F.date_format(at, times.TEXT_FORMAT).alias("txt"))
    ms = times.text_millis("txt")
    return orders.select(
        "o_orderkey", times.day_millis("txt").alias("day_ms"), ms.alias("zone_ms"),
        times.day_key(ms).alias("day"),
        times.time_text(times.rowtime_seconds(ms + 999)).alias("rowtime"),
        times.time_text(F.to_timestamp("txt")).alias("again"),
        times.processing_millis(AS_OF_MS).alias("as_of"))


@query
def code_labels(spark, sf):
    code = F.create_map(*[F.lit(x) for x in ("O", "1001", "P", "1002", "F", "1004")])
    return m.table(spark, sf, "orders").select(
        "o_orderkey", code_label(code[F.col("o_orderstatus")], "order_status").alias("label"))


@query
def user_age(spark, sf):
    as_of = F.lit("2024-01-01").cast("date")
    return m.users(m.table(spark, sf, "customer")).select(
        "ID", times.age_years("BIRTHDAY", as_of).alias("age"))


@query
def text_functions(spark, sf):
    status = F.col("o_orderstatus")
    return m.table(spark, sf, "orders").select(
        "o_orderkey", joined_key(F.lit("order_info"), status).alias("key"),
        in_comma_list(status, F.lit("O, F,P")).alias("listed"),
        is_blank(F.nullif(status, F.lit("O"))).alias("blank"))


@query
def snake_to_camel(spark, sf):
    return camel_columns(m.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_key"), F.col("o_custkey").alias("user_id"),
        F.col("o_orderstatus").alias("order_status")))


# Streams. Each runs over all files present and returns what it has written; rows whose window
# or deadline the watermark has not passed stay in state, and the SQL leaves them out too.


def _parts(spark, sf, *names):
    """Parts of state for a stream that holds all rows of these tables."""
    return state_parts(spark, sum(m.table(spark, sf, n).count() for n in names))


def _slices(spark, sf, **times: str) -> list[dict[str, DataFrame]]:
    """The whole tables cut by their column of time, about ``SLICE_ROWS`` rows at once. A job that
    runs after each of them in turn shuffles a slice at a time, and windows that are passed leave
    its state. Each table comes in its own order, so that none of its rows is late."""
    tables = {n: m.table(spark, sf, n) for n in times}
    parts = max(1, -(-sum(t.count() for t in tables.values()) // SLICE_ROWS))
    cut = {n: m.by_time(t, times[n], parts) for n, t in tables.items()}
    return [{n: c[i] for n, c in cut.items()} for i in range(parts)]


@query
def stream_bounces(spark, sf):
    p = m.page_log(m.stream(spark, sf, "events"))
    return drain(spark, flat(visits.bounces(p, BOUNCE_S, ORDER)), "bounces")


@query
def stream_unique_visits(spark, sf):
    p = m.page_log(m.stream(spark, sf, "events"))
    first = visits.unique_visits(p, entry_only=False, order=ORDER)
    return drain(spark, first.select("common.mid", times.day_key("ts").alias("day")), "visits")


@query
def stream_repair_is_new(spark, sf):
    raw = m.raw_log(m.stream(spark, sf, "events")).select("value")
    base = shared_dir(spark, "repair")

    def write(batch, batch_id):
        batch = batch.persist()
        logs.valid_logs(repair_batch(batch)).select(
            "common.mid", "common.is_new", "page.page_id", "ts").write.mode("overwrite").parquet(
                f"{base}/rows/batch={batch_id}")
        batch.unpersist()

    with stream_settings(spark):
        started = start_batches(logs_beside_first_days(raw), f"{base}/checkpoint", write,
                                once=True, mode="update")
    finish(started)
    return spark.read.schema("mid string, is_new string, page_id string, ts long").parquet(
        f"{base}/rows/batch=*")


@query
def stream_visitor_stats(spark, sf):
    """Unique visits and bounces are streams of their own; the statistics read what they wrote."""
    p = m.page_log(m.stream(spark, sf, "events"))
    uv = _staged(spark, visits.unique_visits(p, order=ORDER, columns=VISITOR_COLUMNS), "uv")
    uj = _staged(spark, visits.bounces(p, BOUNCE_S, ORDER, columns=VISITOR_COLUMNS), "uj")
    counted = stats.visitor_stats(p, uv, uj, window="1 hour", as_of_ms=AS_OF_MS)
    # Which page of a day arrives first is not fixed, so neither are the dimensions of uv_ct.
    return drain(spark, counted.drop("uv_ct"), "visitor_stats")


def _staged(spark, df, name):
    """What the stream wrote, read as the next stream."""
    return spark.readStream.schema(df.schema).parquet(drain_to_folder(spark, df, name))


@query
def stream_search_keywords(spark, sf):
    p = m.page_log(m.stream(spark, sf, "events"))
    return drain(spark, stats.search_keywords(p, "1 hour", AS_OF_MS), "keywords")


@query
def stream_order_wide(spark, sf):
    joined = wide.order_wide(
        m.order_info(m.stream(spark, sf, "orders")),
        m.order_detail(m.stream(spark, sf, "lineitem")), -MONTH_MS, MONTH_MS)
    return drain(spark, doubles(joined.select(
        "detail_id", "order_id", "sku_id", "order_price", "create_time")), "order_wide",
        empty_batches=False, partitions=_parts(spark, sf, "orders", "lineitem"))


@query
def stream_payment_wide(spark, sf):
    events = m.stream(spark, sf, "events")
    paid = wide.payment_wide(m.payment_info(events), m.clicked_orders(events), LOOKBACK_S)
    return drain(spark, paid.select("payment_id", "detail_id", "order_id"), "payment_wide",
                 empty_batches=False, partitions=_parts(spark, sf, "events"))


@query
def stream_product_stats(spark, sf):
    lineitem = m.stream(spark, sf, "lineitem")
    parts = stats.product_parts(order_wide=m.line_orders(lineitem),
                                refund=m.line_refunds(lineitem), window="1 day")
    closed = drain(spark, parts, "product_stats", partitions=_parts(spark, sf, "lineitem"),
                   unload=True)
    release_shuffles(spark)  # of the stream; the totals have a shuffle of their own
    counted = stats.product_totals(closed, as_of_ms=AS_OF_MS)
    return doubles(counted.select(
        "stt", "edt", "sku_id", "order_ct", "order_sku_num", "order_amount",
        "refund_order_ct", "refund_amount"))


# Jobs, over topics of text files


def _topics(spark, **written: DataFrame) -> FileTopics:
    """File topics in a fresh shared folder, filled with the given rows."""
    topics = FileTopics(shared_dir(spark, "topics"), compression=COMPRESSION)
    for topic, rows in written.items():
        topics.write_batch(rows, topic)
    return topics


def _arrivals(topics: FileTopics, slices: list[dict[str, DataFrame]],
              records: Callable[..., dict[str, DataFrame]]) -> Iterator[None]:
    """Write the records of one slice after the other to their topics; a job runs after each."""
    for i, tables in enumerate(slices):
        for topic, rows in records(**tables).items():
            topics.create(rows.sparkSession, topic)
            topics.write_batch(rows, topic, i)
        yield
        if i + 1 < len(slices):
            release_shuffles(rows.sparkSession)


@query
def job_user_log(spark, sf):
    """Records per topic the log job wrote to."""
    raw = m.raw_log(m.table(spark, sf, "events")).select("value")
    topics = _topics(spark, **{C.TOPIC_RAW_LOG: raw})
    with stream_settings(spark):
        started = jobs.user_log_job(spark, topics, shared_dir(spark, "checkpoint"), once=True)
    finish(started)
    written = spark.read.option("basePath", topics.root).text(
        [topics.path(t) for t in (C.TOPIC_START_LOG, C.TOPIC_PAGE_LOG, C.TOPIC_DISPLAY_LOG,
                                  C.TOPIC_QUARANTINE)])
    return written.groupBy("topic").agg(F.count("*").alias("records"))


def _business(spark, sf):
    topics = _topics(spark, **{C.TOPIC_CDC: m.change_records(spark, sf)})
    dims = DimStore(spark, shared_dir(spark, "dims"))
    finish(jobs.business_job(spark, topics, shared_dir(spark, "checkpoint"),
                             lambda: m.routing(spark), dims, once=True))
    return topics, dims


@query
def job_business_facts(spark, sf):
    topics, _ = _business(spark, sf)
    return topics.read(spark, C.TOPIC_ORDER_INFO)


@query
def job_business_dims(spark, sf):
    _, dims = _business(spark, sf)
    users = dims.read("dim_user_info").select("id", F.col("data")["name"].alias("name"), "ts")
    return users.unionByName(dims.read("dim_base_province"))


@query
def job_dim_updates(spark, sf):
    """Users loaded, then changed by orders in several runs; what each run wrote is in proportion
    to the parts it touched."""
    topics = _topics(spark)
    dims = DimStore(spark, shared_dir(spark, "dims"), parts=32)
    checkpoint = shared_dir(spark, "checkpoint")
    config = spark.createDataFrame([
        ("user_info", "insert", "hbase", "dim_user_info", "id,name,segment", "id", None),
        ("user_info", "update", "hbase", "dim_user_info", "id,name,segment", "id", None),
    ], m.TABLE_PROCESS)
    orders = m.table(spark, sf, "orders")
    # The users of a few parts change in the last run, those of all parts before.
    few = part_of(["o_custkey"], dims.parts) < 3
    for i, changes in enumerate((
            m.user_changes(m.table(spark, sf, "customer")),
            m.user_updates(orders.where(~few & (F.col("o_orderkey") % 2 == 0))),
            m.user_updates(orders.where(~few & (F.col("o_orderkey") % 2 == 1))),
            m.user_updates(orders.where(few)))):
        topics.write_batch(changes, C.TOPIC_CDC, i)
        finish(jobs.business_job(spark, topics, checkpoint, lambda: config, dims, once=True))
    last = dims.manifest("dim_user_info")
    if sum(w == max(last.writes.values()) for w in last.writes.values()) > 3:
        raise AssertionError("an upsert wrote parts it did not touch")
    return dims.read("dim_user_info")


def _parsed_topic(rows, schema):
    return parse_rows(rows, schema).drop(CORRUPT)


@query
def job_user_jump(spark, sf):
    """Bounces by the job. Times are cut to the hour, so pages tie and their arrival decides."""
    topics = FileTopics(shared_dir(spark, "topics"), arrival=True)
    p = page(spark, sf).orderBy("event_id").withColumn("ts", F.expr("ts div 3600000 * 3600000"))
    topics.write_batch(to_values(p.drop("event_id")), C.TOPIC_PAGE_LOG)
    finish(jobs.user_jump_job(spark, topics, shared_dir(spark, "checkpoint"), BOUNCE_S, once=True))
    return _parsed_topic(topics.read(spark, C.TOPIC_USER_JUMP), S.PAGE_LOG).select(
        "common.*", "page.*", "ts", F.size(F.coalesce("display", F.array())).alias("displays"))


@query
def job_payment_wide(spark, sf):
    """Payments with the line items of their order that were shipped in the 30 days before."""
    topics = _topics(spark, **{
        C.TOPIC_PAYMENT_INFO: to_values(m.paid_orders(m.table(spark, sf, "orders"))),
        C.TOPIC_ORDER_WIDE: to_values(m.shipped_orders(m.table(spark, sf, "lineitem")))})
    with stream_settings(spark, _parts(spark, sf, "orders", "lineitem")):
        started = jobs.payment_wide_job(spark, topics, shared_dir(spark, "checkpoint"), once=True,
                                        lookback_s=MONTH_MS // 1000)
    finish(started)
    return doubles(_parsed_topic(topics.read(spark, C.TOPIC_PAYMENT_WIDE), S.PAYMENT_WIDE).select(
        "payment_id", "subject", "payment_type", "payment_create_time", "callback_time",
        "detail_id", "order_id", "sku_id", "sku_num", "user_id", "total_amount",
        "split_total_amount", "order_create_time"))


@query
def job_order_wide(spark, sf):
    """Orders with details and all dimensions by the job, which reads the dimensions from a store."""
    topics = _topics(spark, **{
        C.TOPIC_ORDER_INFO: to_values(m.order_info(m.table(spark, sf, "orders"))),
        C.TOPIC_ORDER_DETAIL: to_values(m.order_detail(m.table(spark, sf, "lineitem")))})
    dims = DimStore(spark, shared_dir(spark, "dims"), parts=8)
    tables = {"user": m.users(m.table(spark, sf, "customer")),
              "province": m.provinces(m.table(spark, sf, "nation")),
              "sku": m.skus(m.table(spark, sf, "part")),
              "spu": m.spus(m.table(spark, sf, "supplier")),
              "trademark": m.trademarks(m.table(spark, sf, "region")),
              "category": m.categories(m.table(spark, sf, "nation"))}
    for name, rows in tables.items():
        dims.write(name, rows, ["ID"])
    with stream_settings(spark, _parts(spark, sf, "orders", "lineitem")):
        started = jobs.order_wide_job(
            spark, topics, shared_dir(spark, "checkpoint"), lambda: wide.order_dimensions(
                *(dims.cached(n) for n in tables), as_of=F.lit("2024-01-01").cast("date")),
            once=True, lower_ms=-MONTH_MS, upper_ms=MONTH_MS)
    finish(started)
    return doubles(_parsed_topic(topics.read(spark, C.TOPIC_ORDER_WIDE), S.ORDER_WIDE).select(
        "detail_id", "order_id", "sku_id", "order_price", "user_age", "user_gender",
        "province_name", "province_area_code", "province_iso_code", "province_3166_2_code",
        "spu_id", "spu_name", "tm_id", "tm_name", "category3_id", "category3_name"))


@query
def stream_late_rows(spark, sf):
    """Events per hour and channel in four runs of one stream, and the events that came too late
    for that, with a day of delay. Together with what is open at the end they are the input."""
    topics = FileTopics(shared_dir(spark, "topics"))
    base = shared_dir(spark, "late")
    schema = T.StructType([*S.PAGE_LOG, T.StructField("event_id", T.LongType())])

    def keep(name):
        return lambda df, i: df.write.mode("overwrite").parquet(f"{base}/{name}/batch={i}")

    for i in range(4):
        topics.write_batch(to_values(m.page_log(m.arrivals(m.table(spark, sf, "events"), i))),
                           C.TOPIC_PAGE_LOG, i)
        rows = _parsed_topic(topics.read_stream(spark, C.TOPIC_PAGE_LOG), schema).select(
            "event_id", "common.mid", "common.ch", "ts",
            times.rowtime_millis("ts").alias("at")).withWatermark("at", "1 day")
        counted = rows.groupBy(F.window("at", "1 hour"), "ch").agg(F.count("*").alias("ct"))
        with stream_settings(spark):
            started = start_with_late(counted, rows, "at", f"{base}/checkpoint", keep("counted"),
                                      keep("late"), window="1 hour", once=True)
        finish(started)
    late = spark.read.parquet(f"{base}/late/batch=*")
    return late.select("event_id", "mid", "ch", "ts", F.lit(1).cast("bigint").alias("ct")).unionByName(
        spark.read.parquet(f"{base}/counted/batch=*").select(
            "ch", F.unix_millis("window.start").alias("ts"), "ct"), allowMissingColumns=True)


def _config_versions(spark):
    """Three routing tables: later ones take columns away, send orders elsewhere, drop users."""
    # Since ever, 1997-03-12 and 1999-05-21.
    at = {0: -10**15, 1: 858_124_800_000, 2: 927_244_800_000}
    entries = [
        (0, ("order_info", "insert", "kafka", "orders_old", "id,user_id", None, None)),
        (0, ("user_info", "insert", "hbase", "users", None, None, None)),
        (1, ("order_info", "insert", "kafka", "orders_new", "id,status", None, None)),
        (1, ("user_info", "insert", "hbase", "users", "id", None, None)),
        (2, ("order_info", "insert", "hbase", "orders_dim", None, "id", None))]
    schema = T.StructType([*m.TABLE_PROCESS, T.StructField("version_ts", T.LongType())])
    return spark.createDataFrame([(*e, at[v]) for v, e in entries], schema)


@query
def route_as_of(spark, sf):
    """Changes routed by the table that held at their time."""
    changes = cdc.parse_cdc(m.order_changes(m.table(spark, sf, "orders")).unionByName(
        m.user_changes(m.table(spark, sf, "customer"))))
    routed = cdc.apply_config_as_of(changes, _config_versions(spark))
    return routed.select(
        "sink_type", "sink_table", "sink_pk", "type", "ts",
        *[F.col("data")[c].cast("string").alias(c) for c in ("id", "user_id", "status", "name")])


@query
def job_user_log_once(spark, sf):
    """The log job, lost between two of its topics and started again: nothing is to be seen before
    all topics are there, and every record once after that."""
    topics = FileTopics(shared_dir(spark, "topics"), committed=True)
    raw = m.raw_log(m.table(spark, sf, "events")).select("value")
    topics.write_together({C.TOPIC_RAW_LOG: raw})
    outputs = (C.TOPIC_START_LOG, C.TOPIC_PAGE_LOG, C.TOPIC_DISPLAY_LOG, C.TOPIC_QUARANTINE)

    class Lost(FileTopics):
        def write_batch(self, df, topic=None, batch_id=0):
            if topic == C.TOPIC_DISPLAY_LOG:
                raise RuntimeError("lost")
            super().write_batch(df, topic, batch_id)

    checkpoint = shared_dir(spark, "checkpoint")
    source = dict(root=topics.root, arrival=True, committed=True)
    try:
        finish(jobs.user_log_job(spark, Lost(**source), checkpoint, once=True))
    except StreamingQueryException:
        pass
    if any(not topics.read(spark, t).isEmpty() for t in outputs):
        raise AssertionError("records of an unfinished batch are to be seen")
    finish(jobs.user_log_job(spark, FileTopics(**source), checkpoint, once=True))
    start, page, display, broken = (topics.read(spark, t) for t in outputs)
    flat = _parsed_topic(start, S.RAW_LOG).unionByName(
        _parsed_topic(page, S.RAW_LOG)).select(
            F.when(F.col("start").isNull(), "page").otherwise("start").alias("topic"), "common.*",
            "page.page_id", "page.item", "page.during_time", "ts")
    shown = _parsed_topic(display, T.StructType([
        T.StructField(c, T.StringType()) for c in ("page_id", "item_type", "item")])).select(
            F.lit("display").alias("topic"), "page_id", "item", F.col("item_type").alias("ch"))
    return flat.unionByName(shown, allowMissingColumns=True).unionByName(
        broken.select(F.lit("quarantine").alias("topic"), F.length("value").cast("bigint").alias("ts")),
        allowMissingColumns=True)


@query
def distinct_orders_rolled_up(spark, sf):
    """Distinct orders and parts per month and ship mode, merged from daily sketches, beside exact
    counts; the estimates must be within four standard errors."""
    ids = ("l_orderkey", "l_partkey")
    rows = m.table(spark, sf, "lineitem").withColumn("_rowtime", m.utc("l_shipdate")).withColumn(
        "mode", F.col("l_linenumber") % 3)
    daily = distinct.sketch_ids(rows, "1 day", ["mode", "l_returnflag"], ids)
    merged = distinct.roll_up(daily, "30 days", ["mode"], ids)
    found = merged.select(F.unix_millis("_w.start").alias("start_ms"), *(
        c for c in distinct.counted(merged, ids) if c is not None)).drop("_w")
    exact = rows.groupBy(F.unix_millis(F.window("_rowtime", "30 days")["start"]).alias("start_ms"),
                         "mode").agg(*(F.count_distinct(c).alias(f"{c}_exact") for c in ids))
    bound = distinct.error_bound()
    return found.join(exact, ["start_ms", "mode"]).select(
        "start_ms", "mode", *(f"{c}_exact" for c in ids),
        *((F.abs(F.col(c) - F.col(f"{c}_exact")) <= F.ceil(F.col(f"{c}_exact") * bound)).alias(
            f"{c}_near") for c in ids))


@query
def unique_visit_state(spark, sf):
    """What the daily visits still hold after a run: the device and day of every page whose day
    has not passed the watermark by a day. Times are cut to the day, so that any page will do."""
    days = page(spark, sf).withColumn("ts", F.expr("ts div 86400000 * 86400000"))
    base = shared_dir(spark, "state")
    days.write.parquet(f"{base}/rows")
    rows = spark.readStream.schema(days.schema).parquet(f"{base}/rows")
    first = visits.unique_visits(rows, entry_only=False, delay="3 days")
    with stream_settings(spark):
        started = start_batches(first.select("common.mid", "ts"), f"{base}/checkpoint",
                                lambda df, _: df.write.format("noop").mode("append").save(), once=True)
    finish(started)
    return state_rows(spark, f"{base}/checkpoint").select(
        F.col("key._mid").alias("mid"), F.col("key._day").alias("day"),
        F.expr("value.expiresAtMicros div 1000").alias("expires_ms"))


@query
def view_then_click(spark, sf):
    """Views directly followed by a click within four hours, and views nothing followed in time."""
    events = m.table(spark, sf, "events").withColumn("ms", F.unix_millis(m.utc("ts")))
    kind = F.col("event_type")
    found = match_sequence(events, "user_id", "ms", [kind == "view", kind == "click"],
                           BOUNCE_S * 1000, ["event_id"], ["event_id", "value"])
    return found.select("outcome", "length", F.col("events")[0]["event_id"].alias("first"),
                        F.get("events", F.lit(1))["event_id"].alias("second"))


@query
def stream_view_then_click(spark, sf):
    """The same as a stream, as far as the end of the input closes it."""
    events = m.stream(spark, sf, "events").withColumn("ms", F.unix_millis(m.utc("ts")))
    kind = F.col("event_type")
    found = match_sequence(events, "user_id", "ms", [kind == "view", kind == "click"],
                           BOUNCE_S * 1000, ["event_id"], ["event_id"])
    return drain(spark, found.select(
        "outcome", "length", F.col("events")[0]["event_id"].alias("first"),
        F.get("events", F.lit(1))["event_id"].alias("second")), "sequence")


@query
def bucketed_lookup(spark, sf):
    """Line items with their part, which lies in buckets of its key; every part is stored twice,
    the dearer row first by the order given."""
    part = m.table(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice")
    twice = part.unionByName(part.withColumn("p_retailprice", F.lit(-1.0)).withColumn(
        "p_name", F.lit("cheap")))
    dim = BucketedDimension(spark, f"dim_part_{uuid.uuid4().hex}", shared_dir(spark, "buckets"), 8)
    dim.store(twice.withColumn("cheap", -F.col("p_retailprice")), "p_partkey", ["cheap"])
    facts = m.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return dim.look_up(facts, "l_partkey", {"part_name": "p_name", "price": "p_retailprice"})


def _to_folder(base):
    """A sink that keeps every micro-batch in a folder of its own."""
    return lambda df, i: df.write.mode("overwrite").parquet(f"{base}/rows/batch={i}")


@query
def job_search_keyword(spark, sf):
    topics = _topics(spark, **{C.TOPIC_PAGE_LOG: to_values(page(spark, sf).drop("event_id"))})
    base = shared_dir(spark, "keywords")
    with stream_settings(spark):
        started = jobs.search_keyword_job(spark, topics, f"{base}/checkpoint", _to_folder(base),
                                          once=True, window="1 hour", as_of_ms=AS_OF_MS)
    finish(started)
    return spark.read.schema(S.KEYWORD_STATS).parquet(f"{base}/rows/batch=*")


def _counted_products(spark, sf):
    named = Dimension(m.skus(m.table(spark, sf, "part")), {"sku_id": "ID"},
                      {"spu_name": "SKU_NAME"})
    return stats.product_stats(**_product_inputs(spark, sf), window="1 day", dims=[named])


@query
def job_product_keyword(spark, sf):
    topics = _topics(spark, **{C.TOPIC_PRODUCT_STATS: to_values(_counted_products(spark, sf))})
    base = shared_dir(spark, "product_keywords")
    finish(jobs.product_keyword_job(spark, topics, f"{base}/checkpoint", _to_folder(base),
                                    once=True, as_of_ms=AS_OF_MS))
    return spark.read.schema(S.KEYWORD_STATS).parquet(f"{base}/rows/batch=*")


@query
def sql_product_keywords(spark, sf):
    """Two lateral table functions in one query."""
    register_functions(spark)
    _counted_products(spark, sf).createOrReplaceTempView("product_stats")
    return spark.sql(f"""
        SELECT keyword, ct, source, stt, edt, CAST({AS_OF_MS} AS BIGINT) AS ts
        FROM product_stats, LATERAL ik_analyze(spu_name) AS t(keyword),
             LATERAL keywordProductC2R(click_ct, cart_ct, order_ct) AS c(ct, source)""")


@query
def job_product_stats(spark, sf):
    """All seven inputs as topics. Events are 24 years earlier here, in the time of the line items,
    so that windows of all inputs close."""
    then = F.col("ts") - F.expr("INTERVAL 8766 DAYS")

    def records(events, lineitem):
        events = events.withColumn("ts", then)
        return {name: to_values(rows) for name, rows in {
            C.TOPIC_PAGE_LOG: m.page_log(events).drop("event_id"),
            C.TOPIC_FAVOR_INFO: m.sku_events(events, "signup"),
            C.TOPIC_CART_INFO: m.sku_events(events, "purchase"),
            C.TOPIC_COMMENT_INFO: m.sku_events(events, "error"),
            C.TOPIC_ORDER_WIDE: m.line_orders(lineitem),
            C.TOPIC_PAYMENT_WIDE: m.line_payments(lineitem),
            C.TOPIC_REFUND_INFO: m.line_refunds(lineitem)}.items()}

    topics, checkpoint = _topics(spark), shared_dir(spark, "checkpoint")
    named = [stats.sku_dimension(m.skus(m.table(spark, sf, "part"))),
             *wide.product_dimensions(spus=m.spus(m.table(spark, sf, "supplier")),
                                      trademarks=m.trademarks(m.table(spark, sf, "region")),
                                      categories=m.categories(m.table(spark, sf, "nation")))]
    for _ in _arrivals(topics, _slices(spark, sf, events="ts", lineitem="l_shipdate"), records):
        with stream_settings(spark, unload=True):
            started = jobs.product_stats_job(spark, topics, checkpoint, lambda: named, once=True,
                                             window="1 day", as_of_ms=AS_OF_MS)
        finish(started)
    return doubles(_parsed_topic(topics.read(spark, C.TOPIC_PRODUCT_STATS), S.PRODUCT_STATS))
