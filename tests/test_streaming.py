import json
import time
import zipfile
from decimal import Decimal
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from checks import mapping, queries
from tests.helpers import DAY, log_text
from tradewake import constants as C
from tradewake import schemas as S
from tradewake.functions.records import parse_rows, to_values
from tradewake.plans import logs, stats, visits, wide
from tradewake.schemas import TABLE_PROCESS
from tradewake.session import shared_dir
from tradewake.sources.dims import DimStore
from tradewake.sources.topics import FileTopics, topic_table
from tradewake.streaming import jobs
from tradewake.streaming.late import start_with_late
from tradewake.streaming.run import (FILES, PART_ROWS, PARTITIONS, TRACK_ROWS, UNLOAD, LateRows, drain,
                                     drain_to_folder, finish, start_batches, state_parts,
                                     stream_settings)
from tradewake.streaming.visitors import logs_beside_first_days, repair_batch

HOUR = 3_600_000


@pytest.fixture
def topics(tmp_path):
    return FileTopics(str(tmp_path / "topics"), max_files=1)


def put(spark, topics, topic, *batches, first=0):
    """One file per batch of texts, in order."""
    for i, values in enumerate(batches):
        df = spark.createDataFrame([(v,) for v in values], "value string").coalesce(1)
        topics.write_batch(df, topic, first + i)
        time.sleep(0.02)


def page_text(mid, ts, last=None, page_id="home", **page):
    return log_text(mid, ts, page={"page_id": page_id, "last_page_id": last, **page})


def pages(spark, topics):
    return parse_rows(topics.read_stream(spark, C.TOPIC_PAGE_LOG), S.PAGE_LOG).drop("_corrupt")


def batch_pages(spark, topics):
    return parse_rows(topics.read(spark, C.TOPIC_PAGE_LOG), S.PAGE_LOG).drop("_corrupt")


def keys(df):
    return sorted((r.mid, r.ts) for r in df.select("common.mid", "ts").collect())


def test_bounces_agree_with_batch(spark, topics):
    put(spark, topics, C.TOPIC_PAGE_LOG,
        [page_text("a", 1000), page_text("a", 4000, "home"), page_text("b", 2000)],
        [page_text("a", 14_000), page_text("c", 19_000)],
        [page_text("end", 100_000, "home")])
    streamed = keys(drain(spark, visits.bounces(pages(spark, topics)), "b"))
    assert streamed == keys(visits.bounces(batch_pages(spark, topics)))
    assert streamed == [("a", 14_000), ("b", 2000), ("c", 19_000)]


def test_rows_behind_the_watermark_are_dropped_and_counted(spark, topics):
    put(spark, topics, C.TOPIC_PAGE_LOG,
        [page_text("a", 1000)], [page_text("x", 100_000, "home")],
        [page_text("x", 100_001, "home")],  # lateness is judged by the batch before
        [page_text("late", 2000)], [page_text("y", 200_000, "home")])
    seen = []
    rows = visits.bounces(pages(spark, topics))
    late = LateRows()
    spark.streams.addListener(late)
    query = start_batches(rows, shared_dir(spark, "late"),
                          lambda df, i: seen.extend(keys(df)), once=True)
    finish(query)
    for _ in range(100):
        if str(query.runId) in late.ended:
            break
        time.sleep(0.1)
    spark.streams.removeListener(late)
    assert ("a", 1000) in seen and ("late", 2000) not in seen
    assert late.rows(query) == 2  # the late page stands in two windows


def repairs(spark, topics, checkpoint):
    """What a run of the flag repair hands on: device, time and flag of every row."""
    seen = []

    def keep(df, _):
        seen.extend(map(tuple, logs.valid_logs(repair_batch(df.persist())).select(
            "common.mid", "ts", "common.is_new").collect()))

    raw = topics.read_stream(spark, C.TOPIC_RAW_LOG)
    finish(start_batches(logs_beside_first_days(raw), checkpoint, keep, once=True, mode="update"))
    return sorted(seen)


def test_flag_repair_takes_the_least_time_of_a_batch(spark, topics):
    values = [log_text("a", DAY * (k % 11) + k, "1") for k in range(39, -1, -1)]
    put(spark, topics, C.TOPIC_RAW_LOG, [*values, "{broken", log_text("b", 7, None)])
    assert repairs(spark, topics, shared_dir(spark, "repair")) == sorted(
        [("a", DAY * (k % 11) + k, "1" if k % 11 == 0 else "0") for k in range(40)]
        + [("b", 7, None)], key=lambda r: r[:2])


def test_flag_repair_state_is_a_day_per_device(spark, topics):
    put(spark, topics, C.TOPIC_RAW_LOG, [log_text(m, k, "1") for m in "abc" for k in range(9)],
        [log_text("d", 5, "0"), log_text("a", DAY, "1")])
    checkpoint = shared_dir(spark, "repair")
    repairs(spark, topics, checkpoint)
    state = spark.read.format("statestore").load(checkpoint)
    assert sorted(r.mid for r in state.select("key._mid").toDF("mid").collect()) == ["a", "b", "c"]


@pytest.mark.parametrize("salts", [1, 4])
def test_unique_visits_over_several_batches(spark, topics, salts):
    put(spark, topics, C.TOPIC_PAGE_LOG,
        [page_text("a", 1000), page_text("a", 1500), page_text("b", 9, "home")],
        [page_text("a", 5000), page_text("b", 6000), page_text("a", DAY + 1)],
        [page_text("a", 7000), page_text("a", DAY + 9)])
    page = pages(spark, topics)
    first = drain(spark, visits.unique_visits(page, salts=salts), "uv")
    got = sorted((r.mid, r.ts // DAY) for r in first.select("common.mid", "ts").collect())
    assert got == [("a", 0), ("a", 1), ("b", 0)]


def test_flag_repair_keeps_state_over_batches_and_restart(spark, topics):
    checkpoint = shared_dir(spark, "repair")
    put(spark, topics, C.TOPIC_RAW_LOG,
        [log_text("a", 5, "1"), log_text("b", 5, "0")],
        [log_text("a", 9, "1"), log_text("a", DAY, "1"), log_text("b", DAY, "1")])
    seen = repairs(spark, topics, checkpoint)
    put(spark, topics, C.TOPIC_RAW_LOG,
        [log_text("a", 11, "1"), log_text("b", 11, "1"), log_text("b", DAY + 1, "1")], first=5)
    seen += repairs(spark, topics, checkpoint)
    assert sorted(seen) == [
        ("a", 5, "1"), ("a", 9, "1"), ("a", 11, "1"), ("a", DAY, "0"),
        ("b", 5, "0"), ("b", 11, "0"), ("b", DAY, "1"), ("b", DAY + 1, "1")]


def test_late_rows_are_kept(spark, topics):
    """Rows behind the watermark, row by row, also where a query is started again."""
    batches = [[1, 8], [100], [101, 95, 92], [250, 99, 3, 101], [249, 4, 95, 251], [252, 96]]
    checkpoint, counts, kept = shared_dir(spark, "late"), {}, []

    def run():
        rows = topics.read_stream(spark, "t").select(
            F.timestamp_seconds(F.col("value").cast("long")).alias("at")).withWatermark(
                "at", "3 seconds")
        counted = rows.groupBy(F.window("at", "10 seconds")).count()
        finish(start_with_late(
            counted, rows, "at", checkpoint,
            lambda df, _: counts.update({r.s: r["count"] for r in df.select(
                F.unix_seconds("window.start").alias("s"), "count").collect()}),
            lambda df, _: kept.extend(r[0] for r in df.select(F.unix_seconds("at")).collect()),
            window="10 seconds", once=True))

    put(spark, topics, "t", *batches[:3])
    run()
    put(spark, topics, "t", *batches[3:], first=3)
    run()
    assert sorted(kept) == [3, 4, 96]
    every = [x for b in batches for x in b]
    assert counts == {w: sum(x // 10 * 10 == w for x in every if x not in kept)
                      for w in (0, 90, 100)}
    # What is counted, late or still open is the input.
    assert sum(counts.values()) + len(kept) + sum(x >= 240 for x in every) == len(every)


def order_text(i, at, **more):
    return json.dumps({"id": i, "user_id": 7, "create_time": at, "total_amount": 9.5, **more})


def detail_text(i, order_id, at):
    return json.dumps({"id": i, "order_id": order_id, "sku_id": 5, "sku_num": 1,
                       "split_total_amount": 1.25, "create_time": at})


def test_order_wide_waits_for_either_side(spark, topics):
    day = "2021-06-18 11:00:00"
    put(spark, topics, C.TOPIC_ORDER_INFO, [order_text(1, day)], [order_text(2, day)],
        [order_text(3, day)])
    put(spark, topics, C.TOPIC_ORDER_DETAIL, [detail_text(20, 2, day)],
        [detail_text(10, 1, "2021-06-18 23:59:59")], [detail_text(11, 1, "2021-06-19 00:00:00")])

    def read(topic, schema):
        return parse_rows(topics.read_stream(spark, topic), schema).drop("_corrupt")

    joined = wide.order_wide(read(C.TOPIC_ORDER_INFO, S.ORDER_INFO),
                             read(C.TOPIC_ORDER_DETAIL, S.ORDER_DETAIL))
    got = drain(spark, joined, "ow").select("order_id", "detail_id", "total_amount").collect()
    assert sorted(tuple(r) for r in got) == [(1, 10, Decimal("9.50")), (2, 20, Decimal("9.50"))]


def test_product_stats_count_orders_once(spark, topics):
    def line(sku, order_id, at):
        return json.dumps({"sku_id": sku, "order_id": order_id, "sku_num": 2,
                           "split_total_amount": 1.5, "create_time": at})
    put(spark, topics, C.TOPIC_ORDER_WIDE,
        [line(1, 1, "2021-06-18 11:00:01"), line(1, 1, "2021-06-18 11:00:02")],
        [line(1, 1, "2021-06-18 11:00:03"), line(1, 2, "2021-06-18 11:00:04"),
         line(1, 2, "2021-06-18 11:00:11")],
        [line(9, 9, "2021-06-18 12:00:00")])
    rows = parse_rows(topics.read_stream(spark, C.TOPIC_ORDER_WIDE), S.ORDER_WIDE).drop("_corrupt")
    out = drain(spark, stats.product_stats(order_wide=rows, as_of_ms=0), "ps")
    got = sorted((r.stt[-8:], r.order_ct, r.order_sku_num, r.order_amount) for r in out.collect())
    assert got == [("03:00:00", 2, 8, Decimal("6.00")), ("03:00:10", 1, 2, Decimal("1.50"))]


def test_product_stats_job_holds_one_state(spark, topics):
    def line(at, **more):
        return json.dumps({"sku_id": 1, "order_id": 5, "create_time": f"2021-06-18 {at}", **more})
    put(spark, topics, C.TOPIC_ORDER_WIDE,
        [line("11:00:01", sku_num=2, split_total_amount=1.5)],
        [line("11:00:02", sku_num=3, split_total_amount=1.5), line("12:00:00")])
    put(spark, topics, C.TOPIC_REFUND_INFO,
        [line("11:00:03", refund_amount=1.0), line("11:00:03", refund_amount=2.0, order_id=6)],
        [line("11:00:04", refund_amount=4.0, order_id=None), line("12:00:00")])
    query = jobs.product_stats_job(spark, topics, shared_dir(spark, "ck"),
                                   inputs=("order_wide", "refund"), once=True)
    finish(query)
    assert len(query.lastProgress["stateOperators"]) == 1
    found = [json.loads(r.value) for r in spark.read.text(
        topics.path(C.TOPIC_PRODUCT_STATS)).collect()]
    assert [(r["order_ct"], r["order_sku_num"], r["order_amount"], r["refund_order_ct"],
             r["refund_amount"], r["paid_order_ct"]) for r in found] == [(1, 5, 3.0, 2, 7.0, 0)]


def test_topic_as_sql_table(spark, topics):
    put(spark, topics, C.TOPIC_PAGE_LOG,
        [page_text("a", 12_345, page_id="good_list", item="red shoe")],
        [page_text("z", 100_000, page_id="good_list", item="end")])
    topic_table(spark, topics, C.TOPIC_PAGE_LOG, S.PAGE_VIEW_SQL, "page_view",
                watermark="2 seconds")
    from tradewake.functions.registry import register_functions
    register_functions(spark)
    counted = spark.sql("""
        SELECT keyword, count(*) AS ct, window.start AS stt
        FROM page_view, LATERAL ik_analyze(page['item']) AS t(keyword)
        WHERE page['page_id'] = 'good_list'
        GROUP BY window(rowtime, '10 seconds'), keyword""")
    got = [(r.keyword, r.ct, r.stt.second) for r in drain(spark, counted, "sql").collect()]
    assert sorted(got) == [("red", 1, 10), ("shoe", 1, 10)]


CONFIG = [("order_info", "insert", "kafka", "dwd_order_info", "id", None, None),
          ("user_info", "insert", "hbase", "dim_user_info", "ID,GENDER", "ID", None)]


def change(table, kind, data, ts=0):
    return json.dumps({"table": table, "type": kind, "data": data, "ts": ts})


def test_business_job_reloads_its_config(spark, topics, tmp_path):
    dims, checkpoint = DimStore(spark, str(tmp_path / "dims")), shared_dir(spark, "business")
    config = [CONFIG]

    def run():
        finish(jobs.business_job(
            spark, topics, checkpoint, lambda: spark.createDataFrame(config[0], TABLE_PROCESS),
            dims, once=True))

    user = {"ID": "1", "GENDER": "F", "extra": "x"}
    put(spark, topics, C.TOPIC_CDC,
        [change("order_info", "insert", {"id": 1}), change("user_info", "bootstrap-insert", user, 1)],
        [change("user_info", "insert", {**user, "GENDER": "M"}, 2)])
    run()
    assert [r.value for r in topics.read(spark, C.TOPIC_ORDER_INFO).collect()] == ['{"id":1}']
    assert [tuple(r) for r in dims.read("dim_user_info").collect()] == [("1", "M", 2)]
    config[0] = CONFIG[1:]
    put(spark, topics, C.TOPIC_CDC, [change("order_info", "insert", {"id": 2})], first=7)
    run()
    assert topics.read(spark, C.TOPIC_ORDER_INFO).count() == 1


def test_empty_config_is_an_error(spark, topics, tmp_path):
    put(spark, topics, C.TOPIC_CDC, [change("order_info", "insert", {"id": 1})])
    with pytest.raises(Exception, match="routing table is empty"):
        finish(jobs.business_job(
            spark, topics, shared_dir(spark, "empty"),
            lambda: spark.createDataFrame([], TABLE_PROCESS),
            DimStore(spark, str(tmp_path / "d")), once=True))


def test_rewritten_batch_replaces_its_records(spark, topics):
    df = spark.createDataFrame([("x",)], "value string")
    topics.write_batch(df, "t", 4)
    topics.write_batch(df, "t", 4)
    topics.write_batch(df, "t", 5)
    assert topics.read(spark, "t").count() == 2


def test_page_log_layers_end_to_end(spark, topics):
    """Raw logs through five jobs to visitor and keyword statistics."""
    def ck():
        return shared_dir(spark, "job")

    put(spark, topics, C.TOPIC_RAW_LOG, [
        "{broken",
        log_text("s", 1, start={"entry": "icon"}),
        log_text("a", 1000, "1", page={"page_id": "good_list", "item": "red shoe", "during_time": 3},
                 display=[{"item_type": "sku_id", "item": "7"}]),
        log_text("b", 2000, "1", page={"page_id": "home", "during_time": 4}),
        log_text("b", 4000, "1", page={"page_id": "good_detail", "item": "7",
                                       "last_page_id": "home"}),
        log_text("z", HOUR, "0", page={"page_id": "home"}),
        log_text("z", 2 * HOUR, "0", page={"page_id": "home", "last_page_id": "home"})])
    finish(jobs.user_log_job(spark, topics, ck(), once=True))
    assert topics.read(spark, C.TOPIC_QUARANTINE).count() == 1
    assert topics.read(spark, C.TOPIC_START_LOG).count() == 1
    assert topics.read(spark, C.TOPIC_DISPLAY_LOG).count() == 1
    assert topics.read(spark, C.TOPIC_PAGE_LOG).count() == 5
    finish(jobs.unique_visit_job(spark, topics, ck(), once=True))
    finish(jobs.user_jump_job(spark, topics, ck(), once=True))
    got = []
    finish(jobs.visitor_stats_job(spark, topics, ck(), lambda df, _: got.extend(df.collect()),
                                  once=True, as_of_ms=0))
    totals = [(r.stt[-8:], r.is_new, r.uv_ct, r.pv_ct, r.sv_ct, r.uj_ct, r.dur_sum) for r in got]
    assert totals == [("00:00:00", "1", 2, 3, 2, 1, 7)]
    words = []
    finish(jobs.search_keyword_job(spark, topics, ck(), lambda df, _: words.extend(df.collect()),
                                   once=True, as_of_ms=0))
    assert words == []  # the window of the only search is still open


def test_order_layers_end_to_end(spark, topics, tmp_path):
    """Orders and details to order-wide, payment-wide, product statistics and keywords."""
    def ck():
        return shared_dir(spark, "job")

    at, end = "2021-06-18 11:00:00", "2021-06-20 11:00:00"
    put(spark, topics, C.TOPIC_ORDER_INFO, [order_text(1, at), order_text(2, end)])
    put(spark, topics, C.TOPIC_ORDER_DETAIL, [detail_text(10, 1, at), detail_text(20, 2, end)])
    put(spark, topics, C.TOPIC_PAYMENT_INFO, [json.dumps(
        {"id": 5, "order_id": 1, "user_id": 7, "create_time": at, "callback_time":
         "2021-06-18 11:20:00", "total_amount": 3})])
    users = spark.createDataFrame([("7", "2000-01-01", "F")],
                                  "ID string, BIRTHDAY string, GENDER string")
    skus = spark.createDataFrame([("5", "Red shoe")], "ID string, NAME string")
    named = [jobs.Dimension(skus, {"sku_id": "ID"}, {"spu_name": "NAME"})]
    finish(jobs.order_wide_job(spark, topics, ck(), lambda: [wide.user_dimension(users)], once=True))
    ow = parse_rows(topics.read(spark, C.TOPIC_ORDER_WIDE), S.ORDER_WIDE)
    assert sorted((r.order_id, r.detail_id, r.user_gender) for r in ow.collect()) == [
        (1, 10, "F"), (2, 20, "F")]
    finish(jobs.payment_wide_job(spark, topics, ck(), once=True))
    pw = parse_rows(topics.read(spark, C.TOPIC_PAYMENT_WIDE), S.PAYMENT_WIDE)
    assert [(r.payment_id, r.detail_id, r.total_amount) for r in pw.collect()] == [
        (5, 10, Decimal("3.00"))]
    finish(jobs.product_stats_job(spark, topics, ck(), lambda: named, inputs=("order_wide",),
                                  once=True, as_of_ms=0))
    got = []
    finish(jobs.product_keyword_job(spark, topics, ck(), lambda df, _: got.extend(df.collect()),
                                    once=True, as_of_ms=0))
    assert sorted((r.keyword, r.ct, r.source, r.stt) for r in got) == [
        ("red", 1, "ORDER", "2021-06-18 03:00:00"), ("shoe", 1, "ORDER", "2021-06-18 03:00:00")]


def test_cached_dimension_follows_new_versions(spark, tmp_path):
    dims = DimStore(spark, str(tmp_path))
    assert dims.cached("d") is None
    rows = spark.createDataFrame([("1", 1)], "id string, ts bigint")
    dims.upsert("d", rows, ["id"])
    first = dims.cached("d")
    assert first.is_cached and dims.cached("d") is first
    dims.upsert("d", spark.createDataFrame([("2", 2)], rows.schema), ["id"])
    assert dims.cached("d").count() == 2
    assert not first.is_cached or dims.cached("d") is not first
    dims.invalidate("d")
    assert dims.cached("d").count() == 2


def test_stream_to_topic(spark, topics):
    put(spark, topics, "in", ["a"], ["b"])
    writer = topics.write_stream(topics.read_stream(spark, "in"), "out", shared_dir(spark, "t"))
    finish(writer.trigger(availableNow=True).start())
    assert sorted(r.value for r in topics.read(spark, "out").collect()) == ["a", "b"]


def test_changes_to_order_wide(spark, topics, tmp_path):
    """What the business job writes is what the order job reads: topics and dimensions."""
    dims = DimStore(spark, str(tmp_path / "dims"))
    config = spark.createDataFrame([
        ("order_info", "insert", "kafka", C.TOPIC_ORDER_INFO, None, None, None),
        ("order_detail", "insert", "kafka", C.TOPIC_ORDER_DETAIL,
         "id,order_id,sku_id,split_total_amount,create_time", None, None),
        ("user_info", "insert", "hbase", "dim_user_info", "ID,BIRTHDAY,GENDER", "ID", None),
        ("user_info", "update", "hbase", "dim_user_info", "ID,BIRTHDAY,GENDER", "ID", None),
    ], TABLE_PROCESS)
    at = "2021-06-18 11:00:00"
    user = {"ID": 7, "BIRTHDAY": "2000-01-01", "GENDER": "F"}
    put(spark, topics, C.TOPIC_CDC, [
        change("user_info", "bootstrap-insert", user, 1),
        change("user_info", "update", {**user, "GENDER": "M"}, 2),
        change("order_info", "insert", json.loads(order_text(1, at)), 3),
        change("order_detail", "insert", json.loads(detail_text(10, 1, at)), 4)])
    finish(jobs.business_job(spark, topics, shared_dir(spark, "b"), lambda: config, dims, once=True))
    look_up = lambda: [wide.user_dimension(dims.cached("dim_user_info"),
                                           F.lit("2021-06-18").cast("date"))]
    finish(jobs.order_wide_job(spark, topics, shared_dir(spark, "o"), look_up, once=True))
    got = parse_rows(topics.read(spark, C.TOPIC_ORDER_WIDE), S.ORDER_WIDE).collect()
    assert [(r.order_id, r.detail_id, r.sku_id, r.user_age, r.user_gender, r.total_amount,
             r.split_total_amount) for r in got] == [
        (1, 10, 5, 21, "M", Decimal("9.50"), Decimal("1.25"))]


def test_stream_settings_count_no_rows_and_are_taken_back(spark):
    before = spark.conf.get(TRACK_ROWS, None)
    with stream_settings(spark):
        assert spark.conf.get(TRACK_ROWS) == "false"
    assert spark.conf.get(TRACK_ROWS, None) == before


def test_order_job_runs_no_batch_without_input(spark, topics, tmp_path):
    """A batch that only deletes state costs about half as much as the join; rows of a later run
    still find those of the first."""
    at, checkpoint = "2021-06-18 11:00:00", str(tmp_path / "checkpoint")
    put(spark, topics, C.TOPIC_ORDER_INFO, [order_text(1, at), order_text(2, at)])
    put(spark, topics, C.TOPIC_ORDER_DETAIL, [detail_text(10, 1, at)])
    finish(jobs.order_wide_job(spark, topics, checkpoint, once=True))
    assert [p.name for p in (tmp_path / "checkpoint/commits").glob("[0-9]*")] == ["0"]
    put(spark, topics, C.TOPIC_ORDER_DETAIL, [detail_text(20, 2, at)], first=1)
    finish(jobs.order_wide_job(spark, topics, checkpoint, once=True))
    got = parse_rows(topics.read(spark, C.TOPIC_ORDER_WIDE), S.ORDER_WIDE).collect()
    assert sorted((r.order_id, r.detail_id) for r in got) == [(1, 10), (2, 20)]


def test_payment_job_runs_no_batch_without_input(spark, topics, tmp_path):
    at, checkpoint = "2021-06-18 11:00:00", str(tmp_path / "checkpoint")
    put(spark, topics, C.TOPIC_ORDER_WIDE, [detail_text(1, 1, at), detail_text(2, 2, at)])
    put(spark, topics, C.TOPIC_PAYMENT_INFO, [json.dumps(
        {"id": 5, "order_id": 1, "callback_time": "2021-06-18 11:20:00"})])
    finish(jobs.payment_wide_job(spark, topics, checkpoint, once=True))
    assert [p.name for p in (tmp_path / "checkpoint/commits").glob("[0-9]*")] == ["0"]
    pw = parse_rows(topics.read(spark, C.TOPIC_PAYMENT_WIDE), S.PAYMENT_WIDE)
    assert [(r.payment_id, r.order_id) for r in pw.collect()] == [(5, 1)]


def test_drained_join_runs_no_batch_without_input(spark, topics):
    at = "2021-06-18 11:00:00"
    put(spark, topics, C.TOPIC_ORDER_INFO, [order_text(1, at)])
    put(spark, topics, C.TOPIC_ORDER_DETAIL, [detail_text(10, 1, at)])
    joined = wide.order_wide(*(
        parse_rows(topics.read_stream(spark, t), schema).drop("_corrupt")
        for t, schema in ((C.TOPIC_ORDER_INFO, S.ORDER_INFO), (C.TOPIC_ORDER_DETAIL, S.ORDER_DETAIL))))
    folder = drain_to_folder(spark, joined, "ow", empty_batches=False)
    assert spark.read.parquet(folder).count() == 1
    commits = Path(folder.removeprefix("file:")).parent / "checkpoint/commits"
    assert [p.name for p in commits.glob("[0-9]*")] == ["0"]


def test_drained_join_keeps_one_store_in_as_many_parts_as_told(spark, topics):
    at = "2021-06-18 11:00:00"
    put(spark, topics, C.TOPIC_ORDER_INFO, [order_text(1, at), order_text(2, at)])
    put(spark, topics, C.TOPIC_ORDER_DETAIL, [detail_text(10, 1, at)])
    joined = wide.order_wide(*(
        parse_rows(topics.read_stream(spark, t), schema).drop("_corrupt")
        for t, schema in ((C.TOPIC_ORDER_INFO, S.ORDER_INFO), (C.TOPIC_ORDER_DETAIL, S.ORDER_DETAIL))))
    folder = drain_to_folder(spark, joined, "ow", empty_batches=False, partitions=3)
    assert [r.order_id for r in spark.read.parquet(folder).collect()] == [1]
    state = Path(folder.removeprefix("file:")).parent / "checkpoint/state/0"
    assert sorted(p.name for p in state.glob("[0-9]*")) == ["0", "1", "2"]
    assert not [p for p in state.glob("[0-9]*/*") if p.is_dir() and "keyTo" in p.name]


def test_state_parts_grow_with_the_rows(spark):
    session = int(spark.conf.get(PARTITIONS))
    assert state_parts(spark, 10) == session
    assert state_parts(spark, 5 * session * PART_ROWS) == 5 * session
    assert state_parts(spark, 5 * session * PART_ROWS + 1) == 5 * session + 1


def test_payment_query_sizes_its_state(spark, tmp_path, monkeypatch):
    orders = spark.sql("""SELECT 1L o_orderkey, 2L o_custkey, 9.5D o_totalprice, 'O' o_orderstatus,
                          TIMESTAMP '2021-06-01' o_orderdate""")
    items = spark.sql("""SELECT 1L l_orderkey, 3L l_partkey, id l_linenumber, 2D l_quantity,
                         9.5D l_extendedprice, TIMESTAMP '2021-06-10' l_shipdate FROM range(9)""")
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    items.write.parquet(str(tmp_path / "lineitem.parquet"))
    monkeypatch.setattr("tradewake.streaming.run.PART_ROWS", 1)
    used = []
    job = jobs.payment_wide_job
    monkeypatch.setattr(jobs, "payment_wide_job", lambda *a, **k: used.append(
        int(spark.conf.get(PARTITIONS))) or job(*a, **k))
    assert queries.job_payment_wide(spark, str(tmp_path)).count() == 9
    assert used == [max(10, int(spark.conf.get(PARTITIONS)))]


def test_topics_of_the_queries_are_compressed(spark):
    rows = spark.createDataFrame([("x",)], "value string")
    topics = queries._topics(spark, t=rows)
    files = [f for f in topics.read(spark, "t").inputFiles() if "part-" in f]
    assert files and all(f.endswith(".lz4") for f in files)


def packed(checkpoint):
    """Whether the stores of a checkpoint compress their files with zstd."""
    versions = list(checkpoint.glob("state/0/*/*.zip"))
    for path in versions:
        with zipfile.ZipFile(path) as z:
            name = next(n for n in z.namelist() if "OPTIONS" in n)
            if b" compression=kZSTD" not in z.read(name):
                return False
    return bool(versions)


def test_order_job_packs_its_state(spark, topics, tmp_path):
    at, checkpoint = "2021-06-18 11:00:00", tmp_path / "checkpoint"
    put(spark, topics, C.TOPIC_ORDER_INFO, [order_text(1, at)])
    put(spark, topics, C.TOPIC_ORDER_DETAIL, [detail_text(10, 1, at)])
    finish(jobs.order_wide_job(spark, topics, str(checkpoint), once=True))
    assert packed(checkpoint)


def test_payment_job_packs_its_state(spark, topics, tmp_path):
    at, checkpoint = "2021-06-18 11:00:00", tmp_path / "checkpoint"
    put(spark, topics, C.TOPIC_ORDER_WIDE, [detail_text(1, 1, at)])
    put(spark, topics, C.TOPIC_PAYMENT_INFO, [json.dumps(
        {"id": 5, "order_id": 1, "callback_time": "2021-06-18 11:20:00"})])
    finish(jobs.payment_wide_job(spark, topics, str(checkpoint), once=True))
    assert packed(checkpoint)


def test_stream_settings_pack_the_files_of_the_state(spark):
    before = {k: spark.conf.get(k, None) for k in (*FILES, *UNLOAD)}
    with stream_settings(spark):
        assert spark.conf.get("spark.sql.streaming.stateStore.rocksdb.compression") == "zstd"
        assert {k: spark.conf.get(k, None) for k in UNLOAD} == {k: before[k] for k in UNLOAD}
    with stream_settings(spark, unload=True):
        assert spark.conf.get("spark.sql.streaming.stateStore.unloadOnCommit") == "true"
    assert {k: spark.conf.get(k, None) for k in before} == before


def product_tables(spark, folder):
    """Tables of product statistics: line items of six days around the events of two."""
    at = "TIMESTAMP '2000-01-01' + make_dt_interval"
    for name, sql in {
        "events": f"""SELECT id event_id, {at}(8766 + id % 2, id % 5) ts, id % 3 user_id, 1.5D value,
                          element_at(array('view', 'click', 'signup', 'purchase', 'error'),
                                     1 + int(id % 5)) event_type, '{{"k": 4}}' props
                      FROM range(20)""",
        "lineitem": f"""SELECT id % 9 l_orderkey, 4 + id % 2 l_partkey, 2D l_quantity, 3D l_extendedprice,
                            if(id % 2 = 0, 'F', 'O') l_linestatus, if(id % 3 = 0, 'R', 'N') l_returnflag,
                            if(id = 35, NULL, {at}(id % 6 - 3)) l_shipdate FROM range(36)""",
        "part": "SELECT 4L p_partkey, 'red shoe' p_name, 9D p_retailprice, 3 p_size",
        "supplier": "SELECT 4L s_suppkey, 's' s_name",
        "region": "SELECT 1L r_regionkey, 'r' r_name",
        "nation": "SELECT 1L n_nationkey, 'n' n_name",
    }.items():
        pq.write_table(spark.sql(sql).toArrow(), f"{folder}/{name}.parquet")
    return str(folder)


def test_product_job_in_slices_gives_the_same_rows(spark, tmp_path, monkeypatch):
    """Every table comes in its own order of time, so no row is late; shuffles hold a slice."""
    sf, runs = product_tables(spark, tmp_path), []
    whole = sorted(map(str, queries.job_product_stats(spark, sf).collect()))
    job = jobs.product_stats_job
    monkeypatch.setattr(jobs, "product_stats_job", lambda *a, **k: runs.append(1) or job(*a, **k))
    monkeypatch.setattr(queries, "SLICE_ROWS", 19)
    assert sorted(map(str, queries.job_product_stats(spark, sf).collect())) == whole
    assert len(runs) == len(whole) == 3


def test_tables_by_time_are_whole(spark):
    rows = spark.sql("""SELECT id, if(id % 7 = 0, NULL, timestamp_seconds(id div 3 % 11)) at
                        FROM range(100)""")
    cut = [r.collect() for r in mapping.by_time(rows, "at", 4)]
    assert sorted(r.id for part in cut for r in part) == list(range(100))
    assert all(r.at for part in cut[1:] for r in part)
    ends = [(min(at), max(at)) for at in ([r.at for r in part if r.at] for part in cut)]
    assert all(high < low for (_, high), (low, _) in zip(ends, ends[1:]))
    none = mapping.by_time(rows.withColumn("at", F.lit(None).cast("timestamp")), "at", 3)
    assert [r.count() for r in none] == [100, 0, 0]


def test_product_stream_unloads_its_stores(spark, tmp_path, monkeypatch):
    told = []
    monkeypatch.setattr(queries, "drain", lambda *a, **k: told.append(k["unload"]) or drain(*a, **k))
    assert queries.stream_product_stats(spark, product_tables(spark, tmp_path)).count() > 0
    assert told == [True]
