import json

import pytest
from pyspark.sql import functions as F

from tests.helpers import DAY, log_text, texts
from tradewake.functions.records import to_values
from tradewake.plans import logs


def parsed(spark, values):
    return logs.parse_logs(texts(spark, values), keep=("offset",))


@pytest.mark.parametrize("rows, expected", [
    ([(0, "1"), (0, "1")], ["1", "1"]),
    ([(0, "1"), (1, "1")], ["1", "0"]),
    ([(1, "1"), (0, "1")], ["1", "0"]),
    ([(0, "0"), (1, "1"), (2, "1")], ["0", "1", "0"]),
])
def test_flag_repair_in_arrival_order(spark, rows, expected):
    values = [log_text(ts=d * DAY + i, is_new=n) for i, (d, n) in enumerate(rows)]
    out = logs.repair_is_new(logs.valid_logs(parsed(spark, values)), order="offset")
    assert [r.is_new for r in out.orderBy("offset").select("common.is_new").collect()] == expected


def test_flag_repair_keeps_devices_apart_and_rows_whole(spark):
    values = [log_text("a", 0, "1"), log_text("b", DAY, "1"), log_text("c", DAY, "0")]
    out = logs.repair_is_new(logs.valid_logs(parsed(spark, values)))
    assert sorted((r.mid, r.is_new) for r in out.select("common.*").collect()) == [
        ("a", "1"), ("b", "1"), ("c", "0")]
    assert "_first_day" not in out.columns


def test_log_split(spark):
    page = {"page_id": "good_list", "item": "x"}
    shown = [{"item_type": "sku_id", "item": "1"}, {"item_type": "promo", "item": "2"}]
    values = [
        log_text("empty_start", 1, start={}, page=page),
        log_text("start", 2, start={"entry": "icon"}, page=page, display=shown),
        log_text("two", 3, page=page, display=shown),
        log_text("none", 4, page=page, display=[]),
    ]
    split = logs.split_logs(logs.valid_logs(parsed(spark, values)))
    assert [r.mid for r in split.start.select("common.mid").collect()] == ["start"]
    assert sorted(r.mid for r in split.page.select("common.mid").collect()) == [
        "empty_start", "none", "two"]
    assert sorted(tuple(r) for r in split.display.select(
        "page_id", "item_type", "item").collect()) == [
        ("good_list", "promo", "2"), ("good_list", "sku_id", "1")]
    assert split.display.columns == ["item_type", "item", "page_id"]
    wide = logs.split_logs(logs.valid_logs(parsed(spark, values)), display_context=True)
    assert {r.ts for r in wide.display.collect()} == {3}


def test_malformed_logs_are_set_aside(spark):
    values = ["{broken", json.dumps({"ts": 1}), json.dumps({"common": {"mid": "a"}}),
              json.dumps({"common": {"mid": "a"}, "ts": "soon"}), "[]", log_text("good", 5)]
    rows = parsed(spark, values)
    assert [r.mid for r in logs.valid_logs(rows).select("common.mid").collect()] == ["good"]
    bad = [r.offset for r in logs.quarantined_logs(rows).orderBy("offset").collect()]
    assert bad == [0, 1, 2, 3, 4]


def test_numbers_may_be_quoted(spark):
    values = [json.dumps({"common": {"mid": "a"}, "ts": "12"})]
    assert [r.ts for r in logs.valid_logs(parsed(spark, values)).collect()] == [12]


def test_nested_numbers_may_be_quoted(spark):
    values = [log_text("a", 5, page={"page_id": "p", "during_time": "123"}),
              log_text("b", 6, page={"page_id": "p", "during_time": "no"})]
    rows = logs.valid_logs(parsed(spark, values)).collect()
    assert {r.common.mid: r.page.during_time for r in rows} == {"a": 123, "b": None}


def test_rows_survive_text(spark):
    value = log_text("a", 5, "1", page={"page_id": "p", "during_time": 3},
                     display=[{"item_type": "sku_id", "item": "9"}])
    once = logs.valid_logs(parsed(spark, [value]))
    again = logs.valid_logs(logs.parse_logs(to_values(once, "offset"), keep=("offset",)))
    assert [r.asDict(True) for r in once.collect()] == [r.asDict(True) for r in again.collect()]


def test_repair_shuffles_logs_once(spark):
    rows = logs.valid_logs(parsed(spark, [log_text()]))
    out = logs.repair_is_new(rows).select(F.col("common.is_new"))
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in text and "Window" not in text
