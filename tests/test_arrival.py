"""Order of arrival: numbered records of file topics, and jobs whose rows tie in time."""

import json

import pytest

from tests.helpers import log_text
from tradewake import constants as C
from tradewake import schemas as S
from tradewake.functions.records import parse_rows
from tradewake.schemas import TABLE_PROCESS
from tradewake.session import shared_dir
from tradewake.sources.arrival import topic_source
from tradewake.sources.dims import DimStore
from tradewake.sources.topics import FileTopics
from tradewake.streaming import jobs
from tradewake.streaming.run import drain, finish, start_batches


@pytest.fixture
def topics(tmp_path):
    return FileTopics(str(tmp_path / "topics"), arrival=True)


def put(spark, topics, topic, batch_id, values):
    """The texts in this order, as one file."""
    rows = spark.createDataFrame([(v,) for v in values], "value string").coalesce(1)
    topics.write_batch(rows, topic, batch_id)


def reader(folder, **options):
    return topic_source()({"path": str(folder), **options}).streamReader(None)


def texts(found, pieces):
    return [(v, o) for p in pieces for b in found.read(p)
            for v, o in zip(b["value"].to_pylist(), b["offset"].to_pylist())]


@pytest.mark.parametrize("split", [1, 2, 3, 5, 1000])
@pytest.mark.parametrize("most", [0, 1, 4, 7])
def test_every_record_once_and_in_order(tmp_path, split, most):
    lines = ["a", "", "bcd", "é" * 4, "x" * 30, "", "end"]
    for batch, part in ((10, lines[5:]), (2, lines[:5])):
        (tmp_path / f"batch={batch}").mkdir()
        (tmp_path / f"batch={batch}" / "part-00003-x.txt").write_bytes(
            "".join(f"{x}\n" for x in part).encode())
    (tmp_path / "_temporary").mkdir()
    (tmp_path / "_temporary" / "part-00000").write_text("no\n")
    found, got = reader(tmp_path, maxBytes=str(most), splitBytes=str(split)), []
    at = found.initialOffset()
    while (end := found.latestOffset()) != at:
        assert not most or end["at"] - at["at"] <= most
        pieces = found.partitions(at, end)
        assert {p.partition for p in pieces} <= {3}
        got += texts(found, pieces)
        at = end
    assert [v for v, _ in got] == lines
    places = [sum(len(x.encode()) + 1 for x in lines[:i]) for i in range(len(lines))]
    assert [o for _, o in got] == places


def test_last_line_without_line_feed_and_empty_topic(tmp_path):
    found = reader(tmp_path / "none")
    assert found.latestOffset() == {"at": 0} and found.partitions({"at": 0}, {"at": 0}) == []
    (tmp_path / "a.txt").write_text("1\n2")
    found = reader(tmp_path)
    assert texts(found, found.partitions({"at": 0}, found.latestOffset())) == [("1", 0), ("2", 2)]


def test_limit_holds_after_restart(tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "a.txt").write_text("12345\n" * 10)
    options = dict(maxBytes="12", progress=str(tmp_path / "p" / "g"))
    first = reader(tmp_path / "t", **options)
    first.partitions(first.initialOffset(), first.latestOffset())
    assert reader(tmp_path / "t", **options).latestOffset() == {"at": 24}
    assert reader(tmp_path / "t", maxBytes="12").latestOffset() == {"at": 60}


def test_stream_in_limited_triggers(spark, tmp_path):
    topics = FileTopics(str(tmp_path / "topics"), arrival=True, max_bytes=40)
    values = [f"record {i}" for i in range(30)]
    put(spark, topics, "t", 0, values)
    seen = {}
    query = start_batches(topics.read_stream(spark, "t", "g"), shared_dir(spark, "arrival"),
                          lambda df, i: seen.setdefault(i, [tuple(r) for r in df.collect()]))
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert len(seen) >= 7 and max(len(rows) for rows in seen.values()) <= 5
    rows = sorted((o, v) for part in seen.values() for v, _, o in part)
    assert [v for _, v in rows] == values


def page_text(mid, ts, last=None, **more):
    return log_text(mid, ts, page={"page_id": "home", "last_page_id": last}, **more)


def test_pages_of_equal_time_bounce_by_arrival(spark, topics):
    put(spark, topics, C.TOPIC_PAGE_LOG, 0, [
        page_text("a", 0), page_text("a", 0, "home"),    # the entry is followed: no bounce
        page_text("b", 0, "home"), page_text("b", 0),    # the entry came last: a bounce
        page_text("c", 0), page_text("c", 0)])           # two entries: the second one
    put(spark, topics, C.TOPIC_PAGE_LOG, 1, [page_text("end", 100_000, "home")])
    finish(jobs.user_jump_job(spark, topics, shared_dir(spark, "jump"), once=True))
    got = parse_rows(topics.read(spark, C.TOPIC_USER_JUMP), S.PAGE_LOG)
    assert sorted(r.mid for r in got.select("common.mid").collect()) == ["b", "c"]


def change(kind, data, ts):
    return json.dumps({"table": "user_info", "type": kind, "data": data, "ts": ts})


def test_changes_of_equal_time_count_by_arrival(spark, topics, tmp_path):
    config = spark.createDataFrame([
        ("user_info", k, "hbase", "dim_user_info", "id,name", "id", None)
        for k in ("insert", "update")], TABLE_PROCESS)
    dims, checkpoint = DimStore(spark, str(tmp_path / "dims"), parts=4), shared_dir(spark, "b")

    def run():
        finish(jobs.business_job(spark, topics, checkpoint, lambda: config, dims, once=True))
        return {r.id: r.name for r in dims.read("dim_user_info").collect()}

    put(spark, topics, C.TOPIC_CDC, 0, [change("insert", {"id": i, "name": n}, 5)
                                        for i, n in ((1, "z"), (2, "a"), (1, "b"), (2, "y"))])
    assert run() == {"1": "b", "2": "y"}
    put(spark, topics, C.TOPIC_CDC, 1, [change("update", {"id": 1, "name": "a"}, 5),
                                        change("update", {"id": 2, "name": "old"}, 4)])
    assert run() == {"1": "a", "2": "y"}


def test_compressed_topics(spark, tmp_path):
    rows = spark.range(2000).selectExpr("to_json(struct(id, 'some text' AS name)) AS value")
    size = {}
    for codec in (None, "lz4"):
        topics = FileTopics(str(tmp_path / str(codec)), compression=codec)
        topics.write_batch(rows, "t")
        size[codec] = sum(p.stat().st_size for p in (tmp_path / str(codec)).rglob("part-*"))
        streamed = drain(spark, topics.read_stream(spark, "t"), "t")
        for got in (topics.read(spark, "t"), streamed):
            assert sorted(r.value for r in got.collect()) == sorted(r.value for r in rows.collect())
    assert size["lz4"] < size[None] / 2
    with pytest.raises(ValueError, match="plain text"):
        FileTopics(str(tmp_path), arrival=True, compression="lz4")
