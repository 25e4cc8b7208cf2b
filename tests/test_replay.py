"""Micro-batches that run again: the same routing, outputs that come into sight once and together."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.helpers import log_text
from tradewake import constants as C
from tradewake.operators import distinct
from tradewake.plans import cdc
from tradewake.schemas import TABLE_PROCESS
from tradewake.session import shared_dir
from tradewake.sources.config import ConfigHistory
from tradewake.sources.dims import DimStore
from tradewake.sources.topics import FileTopics
from tradewake.streaming import jobs
from tradewake.streaming.run import finish, start_batches


def change(kind, data, ts=0):
    return json.dumps({"table": "order_info", "type": kind, "data": data, "ts": ts})


def entry(sink, columns):
    return ("order_info", "insert", "kafka", sink, columns, None, None)


def put(spark, topics, topic, batch_id, *values):
    rows = spark.createDataFrame([(v,) for v in values], "value string")
    topics.write_together({topic: rows.coalesce(1)}, batch_id)


def test_replayed_batch_routes_as_at_first(spark, tmp_path):
    topics = FileTopics(str(tmp_path / "topics"))
    checkpoint, config = str(tmp_path / "checkpoint"), [entry("first", "id")]
    history = ConfigHistory(spark, str(tmp_path / "history"))

    def run():
        finish(jobs.business_job(
            spark, topics, checkpoint, lambda: spark.createDataFrame(config, TABLE_PROCESS),
            DimStore(spark, str(tmp_path / "dims")), once=True, history=history))

    def values(topic):
        try:
            return sorted(r.value for r in topics.read(spark, topic).collect())
        except Exception:
            return []

    put(spark, topics, C.TOPIC_CDC, 0, change("insert", {"id": 1, "x": 1}))
    run()
    config[0] = entry("second", "id,x")
    put(spark, topics, C.TOPIC_CDC, 1, change("insert", {"id": 2, "x": 2}))
    run()
    want = (['{"id":1}'], ['{"id":2,"x":2}'])
    assert (values("first"), values("second")) == want
    # As if the writer were lost before its last commit; the table changes once more meanwhile.
    config[0] = entry("third", "x")
    for name in os.listdir(f"{checkpoint}/commits"):
        if name.strip(".crc") == "1":
            os.remove(f"{checkpoint}/commits/{name}")
    run()
    assert (values("first"), values("second")) == want and values("third") == []
    assert history.versions().select("sink_table", "version_ts").distinct().count() == 2


def test_routing_as_of_a_time(spark):
    schema = T.StructType([*TABLE_PROCESS, T.StructField("version_ts", T.LongType())])
    versions = spark.createDataFrame([
        (*entry("old", None), 10), (*entry("new", None), 20),
        ("other", "insert", "kafka", "x", None, None, None, 30)], schema)
    records = cdc.parse_cdc(spark.createDataFrame(
        [(change("insert", {"id": t}, t),) for t in (9, 10, 19, 20, 29, 30, 99)]
        + [(change("insert", {"id": "no time"}, None),)], "value string"))
    got = cdc.apply_config_as_of(records, versions).select("ts", "sink_table").collect()
    assert sorted(map(tuple, got)) == [(10, "old"), (19, "old"), (20, "new"), (29, "new")]
    plan = cdc.apply_config_as_of(records, versions)._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan


class Lost(FileTopics):
    """Topics whose writer is lost before the display log."""

    def write_batch(self, df, topic=None, batch_id=0):
        if topic == C.TOPIC_DISPLAY_LOG:
            raise RuntimeError("lost")
        super().write_batch(df, topic, batch_id)


def test_topics_of_a_batch_come_into_sight_together(spark, tmp_path):
    options = dict(root=str(tmp_path / "topics"), arrival=True, committed=True)
    topics, checkpoint = FileTopics(**options), shared_dir(spark, "once")
    put(spark, topics, C.TOPIC_RAW_LOG, 0,
        log_text("a", 1, start={"entry": "icon"}), "{broken",
        log_text("a", 2, page={"page_id": "home"}, display=[{"item_type": "sku_id", "item": "7"}]))
    outputs = (C.TOPIC_START_LOG, C.TOPIC_PAGE_LOG, C.TOPIC_DISPLAY_LOG, C.TOPIC_QUARANTINE)

    def followed():
        """What a stream of each topic has got so far."""
        seen = {}
        for topic in outputs:
            finish(start_batches(
                topics.read_stream(spark, topic), str(tmp_path / f"reader-{topic}"),
                lambda df, _, t=topic: seen.setdefault(t, []).extend(
                    r.value for r in df.collect()), once=True))
        return {t: len(v) for t, v in seen.items() if v}

    with pytest.raises(Exception, match="lost"):
        finish(jobs.user_log_job(spark, Lost(**options), checkpoint, once=True))
    assert os.path.exists(topics.path(C.TOPIC_PAGE_LOG)) and followed() == {}
    assert [topics.read(spark, t).count() for t in outputs] == [0] * 4
    for _ in range(2):
        finish(jobs.user_log_job(spark, topics, checkpoint, once=True))
        assert [topics.read(spark, t).count() for t in outputs] == [1] * 4
    assert followed() == dict.fromkeys(outputs, 1)
    assert followed() == {}


def test_sketches_of_windows_merge(spark):
    rows = spark.range(20_000).select(
        F.timestamp_seconds(F.col("id") % 86400).alias("_rowtime"), (F.col("id") % 5000).alias("order"),
        F.when(F.col("id") % 2 == 0, "even").alias("sku"), F.lit(None).cast("long").alias("none"))
    hourly = distinct.sketch_ids(rows, "1 hour", ["sku"], ["order", "none"])
    whole = distinct.sketch_ids(rows, "1 day", [], ["order", "none"])
    merged = distinct.roll_up(hourly, None, [], ["order", "none"])
    one, two = (df.select(*distinct.counted(df, ["order", "none"])).first() for df in (merged, whole))
    # Merging gives the sketch of the ids themselves, up to the order in which registers fill.
    assert abs(one.order - two.order) <= 0.01 * 5000 and one.none == two.none == 0
    assert abs(one.order - 5000) <= distinct.error_bound() * 5000
    by_sku = distinct.roll_up(hourly, "1 day", ["sku"], ["order", "none"])
    assert {r.sku for r in by_sku.collect()} == {"even", None}
