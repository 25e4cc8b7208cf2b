import json

import pytest
from pyspark.sql import functions as F

from tests.helpers import texts
from tradewake.constants import SINK_DIM
from tradewake.plans import cdc
from tradewake.schemas import TABLE_PROCESS
from tradewake.sources.dims import DimStore


@pytest.fixture(scope="module")
def config(spark):
    return spark.createDataFrame([
        ("order_info", "insert", "kafka", "dwd_order_info", "id,user_id", None, None),
        ("user_info", "insert", "hbase", "dim_user_info", None, None, None),
        ("spaced", "insert", "kafka", "dwd_spaced", "id, user_id", None, None),
        ("x", "insert", "clickhouse", "x", None, None, None)], TABLE_PROCESS)


def change(table, kind, data, ts=0):
    return json.dumps({"table": table, "type": kind, "data": data, "ts": ts})


def route(spark, config, *values):
    split = cdc.route_cdc(cdc.parse_cdc(texts(spark, values)), config)

    def rows(df):
        return [(r.sink_table, json.loads(r.data)) for r in df.select(
            "sink_table", F.to_json("data").alias("data")).collect()]
    return rows(split.facts), rows(split.dims)


def test_routing(spark, config):
    row = {"id": "1", "user_id": "2", "extra": "3"}
    kept = {"id": "1", "user_id": "2"}
    assert route(spark, config, change("order_info", "insert", row)) == (
        [("dwd_order_info", kept)], [])
    assert route(spark, config, change("order_info", "update", row)) == ([], [])
    assert route(spark, config, change("user_info", "bootstrap-insert", row)) == (
        [], [("dim_user_info", row)])
    assert route(spark, config, change("x", "insert", row)) == ([], [])
    assert route(spark, config, change("spaced", "insert", row)) == (
        [("dwd_spaced", {"id": "1"})], [])


def test_rows_without_payload_are_dropped(spark, config):
    values = [change("order_info", "insert", None), change("order_info", "insert", {}),
              json.dumps({"table": "order_info", "type": "insert"}), "{broken"]
    assert route(spark, config, *values) == ([], [])


def test_every_matched_row_goes_to_one_side(spark, config):
    values = [change(t, "insert", {"id": str(i)}) for i, t in enumerate(
        ["order_info", "user_info", "x", "unknown", "user_info"])]
    facts, dims = route(spark, config, *values)
    assert (len(facts), len(dims)) == (1, 2)


def test_fact_messages(spark, config):
    split = cdc.route_cdc(cdc.parse_cdc(texts(
        spark, [change("order_info", "insert", {"id": 1, "user_id": 2, "z": 3})])), config)
    assert [tuple(r) for r in cdc.fact_messages(split.facts).collect()] == [
        ("dwd_order_info", '{"id":1,"user_id":2}')]


def test_upsert_keeps_the_newest_and_is_repeatable(spark, tmp_path):
    store = DimStore(spark, str(tmp_path))
    assert store.read("d") is None
    assert store.create("d", "id,name")
    assert not store.create("d", "id,name")
    assert store.read("d").columns == ["id", "name", "ts"]

    def rows(*values):
        return spark.createDataFrame(values, "id string, name string, ts bigint")

    def now():
        return sorted(tuple(r) for r in store.read("d").collect())

    store.upsert("d", rows(("1", "a", 1), ("2", "b", 1), ("1", "c", 3)), ["id"])
    assert now() == [("1", "c", 3), ("2", "b", 1)]
    changes = rows(("1", "old", 2), ("2", "new", 4))
    store.upsert("d", changes, ["id"])
    store.upsert("d", changes, ["id"])
    assert now() == [("1", "c", 3), ("2", "new", 4)]
    assert store.versions("d") == [0, 1, 2, 3]
    # A superseded version goes once it has been one for longer than readers may take.
    DimStore(spark, str(tmp_path), keep_seconds=-1).upsert("d", changes, ["id"])
    assert store.versions("d") == [3, 4]
    # A new column, and changes without a key.
    wider = spark.createDataFrame([("3", "c", 9, "x"), (None, "n", 9, "y")],
                                  "id string, name string, ts bigint, extra string")
    store.upsert("d", wider, ["id"])
    assert sorted(map(tuple, store.read("d").collect())) == [
        ("1", "c", 3, None), ("2", "new", 4, None), ("3", "c", 9, "x")]


def test_dimension_columns_come_from_the_insert_entry(spark):
    def entry(operation, columns, table="dim"):
        return ("t", operation, "hbase", table, columns, None)

    def columns(*entries):
        config = spark.createDataFrame(entries, "source_table string, operate_type string, "
                                       "sink_type string, sink_table string, sink_columns string, "
                                       "sink_pk string").withColumn("sink_type", F.lit(SINK_DIM))
        return [r.sink_columns for r in cdc.dim_tables(config)]

    assert columns(entry("insert", "id,name,region"), entry("update", "id,zip")) == ["id,name,region"]
    assert columns(entry("update", "id,zip"), entry("delete", "id,area")) == ["id,area,zip"]
    assert columns(entry("update", "id,zip"), entry("delete", None)) == [None]
    dims = spark.createDataFrame([("dim", {"id": "1", "zip": "2"}, 5)],
                                 "sink_table string, data map<string,string>, ts long")
    assert cdc.dim_rows(dims, "dim", "zip").columns == ["zip", "id", "ts"]


def test_unfinished_versions_are_not_read(spark, tmp_path):
    store = DimStore(spark, str(tmp_path))
    store.create("d", "id")
    # What a lost writer leaves: files of a write and a draft of their manifest.
    (tmp_path / "d" / "data" / "w=0" / "_part=3").mkdir(parents=True)
    (tmp_path / "d" / "manifest" / "_draft-1").write_text("{")
    assert store.versions("d") == [0]
    rows = spark.createDataFrame([("1", 5)], "id string, ts long")
    assert store.write("d", rows) == 1
    assert [tuple(r) for r in store.read("d").collect()] == [("1", 5)]
    # Two writers of one version: the second one fails and changes nothing.
    with pytest.raises(RuntimeError, match="another writer"):
        store._commit("d", store.manifest("d"))
    assert store.write("d", rows.limit(0)) == 2 and store.read("d").count() == 0


def test_an_upsert_writes_the_parts_it_touches(spark, tmp_path):
    store = DimStore(spark, str(tmp_path), parts=16)
    rows = spark.range(400).selectExpr("cast(id AS string) AS id", "'x' AS name", "1L AS ts")

    def written(number):
        return {int(p.name[6:]): [f.stat().st_mtime_ns for f in p.glob("*.parquet")]
                for p in (tmp_path / "d" / "data" / f"w={number}").glob("_part=*")}

    store.upsert("d", rows, ["id"])
    assert len(written(0)) == 16
    change = spark.createDataFrame([("7", "new", 2), ("401", "more", 2)], rows.schema)
    store.upsert("d", change, ["id"])
    manifest = store.manifest("d")
    touched = set(written(1))
    assert len(touched) <= 2 and {p for p, w in manifest.writes.items() if w == 1} == touched
    assert {r.id: r.name for r in store.read("d").collect()} == {
        **{str(i): "x" for i in range(400)}, "7": "new", "401": "more"}
    # The rows of some keys come from their parts alone.
    few = store.read_keys("d", change.select("id"))
    assert sorted(map(tuple, few.collect())) == [("401", "more", 2), ("7", "new", 2)]
    read = {f.split("_part=")[1].split("/")[0] for f in few.inputFiles() if "_part=" in f}
    assert {int(p) for p in read} <= touched
    # No change, no version; older versions and files go once no version in use needs them.
    assert store.upsert("d", change.limit(0), ["id"]) == manifest.version
    DimStore(spark, str(tmp_path), keep_seconds=-1).upsert("d", change, ["id"])
    DimStore(spark, str(tmp_path), keep_seconds=-1).upsert("d", change, ["id"])
    assert store.versions("d") == [2, 3] and not set(written(1))
    assert len(written(0)) == 16 - len(touched) and store.read("d").count() == 401
    with pytest.raises(ValueError, match="stored by"):
        store.upsert("d", change, ["name"])


def test_dim_rows_with_and_without_columns(spark, config):
    split = cdc.route_cdc(cdc.parse_cdc(texts(
        spark, [change("user_info", "insert", {"id": "1", "name": "n"}, 9)])), config)
    named = cdc.dim_rows(split.dims, "dim_user_info", "id,name,absent")
    assert [tuple(r) for r in named.collect()] == [("1", "n", None, 9)]
    whole = cdc.dim_rows(split.dims, "dim_user_info", None)
    assert [(r.id, r.data["name"], r.ts) for r in whole.collect()] == [("1", "n", 9)]
