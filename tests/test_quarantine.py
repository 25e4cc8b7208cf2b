"""What a job can't use goes to its quarantine topic; the rest is as it would be without."""

import json
import time

import pytest

from tests.helpers import log_text
from tradewake import constants as C
from tradewake.schemas import TABLE_PROCESS
from tradewake.session import shared_dir
from tradewake.sources.dims import DimStore
from tradewake.sources.topics import FileTopics
from tradewake.streaming import jobs
from tradewake.streaming.run import finish

AT = "2021-06-18 11:00:00"


@pytest.fixture
def topics(tmp_path):
    return FileTopics(str(tmp_path / "topics"), max_files=1)


def put(spark, topics, topic, *values):
    topics.write_batch(spark.createDataFrame([(v,) for v in values], "value string").coalesce(1), topic)
    time.sleep(0.02)


def aside(spark, topics, job):
    rows = topics.read(spark, jobs.quarantine_topic(job)).collect()
    return sorted((json.loads(r.value)["topic"], json.loads(r.value)["value"]) for r in rows)


def page(mid="a", ts=1000, **more):
    return log_text(mid, ts, page={"page_id": "good_detail", "item": "7", **more})


def test_visitor_jobs(spark, topics):
    broken = ["{broken", page(mid=None), page(ts=None)]
    put(spark, topics, C.TOPIC_PAGE_LOG, page(), *broken)
    for name, job in (("unique_visit", jobs.unique_visit_job), ("user_jump", jobs.user_jump_job)):
        finish(job(spark, topics, shared_dir(spark, name), once=True))
        assert aside(spark, topics, name) == sorted((C.TOPIC_PAGE_LOG, v) for v in broken)
    assert topics.read(spark, C.TOPIC_UNIQUE_VISIT).count() == 1
    put(spark, topics, C.TOPIC_USER_JUMP, page())
    finish(jobs.visitor_stats_job(spark, topics, shared_dir(spark, "v"), lambda df, _: df.collect(),
                                  once=True))
    assert aside(spark, topics, "visitor_stats") == sorted(
        (C.TOPIC_PAGE_LOG, v) for v in (broken[0], broken[2]))
    finish(jobs.search_keyword_job(spark, topics, shared_dir(spark, "k"),
                                   lambda df, _: df.collect(), once=True))
    assert len(aside(spark, topics, "keyword_stats")) == 2


def test_order_jobs(spark, topics):
    order = {"id": 1, "user_id": 7, "create_time": AT}
    detail = {"id": 10, "order_id": 1, "sku_id": 5, "create_time": AT}
    no_time, no_order = {**order, "create_time": "soon"}, {**detail, "order_id": None}
    put(spark, topics, C.TOPIC_ORDER_INFO, json.dumps(order), json.dumps(no_time), "[")
    put(spark, topics, C.TOPIC_ORDER_DETAIL, json.dumps(detail), json.dumps(no_order))
    finish(jobs.order_wide_job(spark, topics, shared_dir(spark, "o"), once=True))
    assert topics.read(spark, C.TOPIC_ORDER_WIDE).count() == 1
    assert aside(spark, topics, "order_wide") == sorted([
        (C.TOPIC_ORDER_INFO, json.dumps(no_time)), (C.TOPIC_ORDER_INFO, "["),
        (C.TOPIC_ORDER_DETAIL, json.dumps(no_order))])
    unpaid = json.dumps({"id": 1, "order_id": 1, "callback_time": "x"})
    put(spark, topics, C.TOPIC_PAYMENT_INFO, unpaid)
    finish(jobs.payment_wide_job(spark, topics, shared_dir(spark, "p"), once=True))
    assert aside(spark, topics, "payment_wide") == [(C.TOPIC_PAYMENT_INFO, unpaid)]


def test_product_jobs(spark, topics):
    odd = log_text("a", 1000, page={"page_id": "good_detail", "item": "x"},
                   display=[{"item_type": "sku_id", "item": "7"}])
    end = log_text("a", 100_000, page={"page_id": "good_detail", "item": "9"})
    put(spark, topics, C.TOPIC_PAGE_LOG, odd, end)
    no_sku = json.dumps({"id": 1, "create_time": AT})
    put(spark, topics, C.TOPIC_CART_INFO, no_sku)
    finish(jobs.product_stats_job(spark, topics, shared_dir(spark, "s"), inputs=("page",), once=True))
    assert aside(spark, topics, "product_stats") == [(C.TOPIC_PAGE_LOG, odd)]
    counted = [json.loads(r.value) for r in topics.read(spark, C.TOPIC_PRODUCT_STATS).collect()]
    assert [(r["sku_id"], r["display_ct"], r["click_ct"]) for r in counted] == [(7, 1, 0)]
    put(spark, topics, C.TOPIC_PRODUCT_STATS, "no record")
    finish(jobs.product_keyword_job(spark, topics, shared_dir(spark, "w"),
                                    lambda df, _: df.collect(), once=True))
    assert aside(spark, topics, "product_keywords") == [(C.TOPIC_PRODUCT_STATS, "no record")]


def test_business_job(spark, topics, tmp_path):
    good = json.dumps({"table": "order_info", "type": "insert", "data": {"id": 1}, "ts": 0})
    nothing = json.dumps({"table": "order_info", "type": "insert", "data": None, "ts": 0})
    put(spark, topics, C.TOPIC_CDC, good, nothing, "{broken")
    config = spark.createDataFrame(
        [("order_info", "insert", "kafka", "orders", None, None, None)], TABLE_PROCESS)
    finish(jobs.business_job(spark, topics, shared_dir(spark, "b"), lambda: config,
                             DimStore(spark, str(tmp_path / "d")), once=True))
    assert topics.read(spark, "orders").count() == 1
    assert aside(spark, topics, "business") == [(C.TOPIC_CDC, "{broken")]
