"""Mixing to target weights against a plain loop, and its odd input."""

import re

import duckdb
import pytest

from tradewake.llm import mixing
from tradewake.llm.common import Stage
from tradewake.llm.mixing import WORD, mix, plan_mix, targets
from tradewake.llm.running import running

SCHEMA = "doc_id long, text string, source string"


def level(sizes, weights, share, most):
    """Targets by resharing until no source is over its cap."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [
        s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    rest, open_, out = share * sum(sizes.values()), set(sizes), {}
    while open_:
        each = rest / sum(weight[s] for s in open_)
        over = {s for s in open_ if each * weight[s] > most * sizes[s]}
        if not over:
            return out | {s: each * weight[s] for s in open_}
        for s in over:
            out[s] = most * sizes[s]
            rest -= out[s]
        open_ -= over
    return out


def documents(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


ROWS = [(i, "w " * (i * 7 % 23), s) for i, s in enumerate(
    ["a"] * 40 + ["b"] * 5 + ["ü"] * 9 + ["z"] * 2 + [None] * 6 + [""] * 3 + ["B"] * 30)]


def test_targets_and_cuts(spark):
    sizes = {}
    for i, text, s in ROWS:
        sizes[s] = sizes.get(s, 0) + len(re.findall(WORD, text))
    want = level(sizes, (3, 1, 2), 1.5, 2)
    docs = documents(spark, ROWS)
    rows = plan_mix(docs).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(ROWS)))
    for s in sizes:
        own = [r for r in rows if r.source == s]
        assert {r.source_size for r in own} == {sizes[s]}
        assert own[0].target == pytest.approx(want[s])
        assert sum(r.taken for r in own) == int(own[0].target)
        whole = own[0].target // sizes[s] if sizes[s] else 0
        assert all(whole * r.size <= r.taken <= 2 * r.size for r in own)
        # One document at most is cut.
        assert sum(r.taken % max(1, r.size) > 0 for r in own) <= 1
    again = plan_mix(docs.repartition(7)).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in rows)
    other = plan_mix(docs, seed=7).collect()
    assert sorted((r.doc_id, r.taken) for r in other) != sorted((r.doc_id, r.taken) for r in rows)


@pytest.mark.parametrize("share, most", [(0.4, 2), (1.5, 2), (2.0, 2), (2.6, 3), (9.0, 3)])
def test_levels(spark, share, most):
    sizes = {"a": 1000, "b": 10, "c": 0, "d": 300, "e": 301, None: 7}
    rows = spark.createDataFrame(
        [(s is None, s or "", n) for s, n in sizes.items()], "none boolean, src string, source_size long")
    got = targets(rows, Stage(spark, "test"), (3, 1, 2), share, most).collect()
    want = level(sizes, (3, 1, 2), share, most)
    assert {None if r.none else r.src: pytest.approx(r.target) for r in got} == want


def test_same_rows_as_sql(spark):
    odd = [(1, None, "a"), (1, None, "a"), (1, "x y", "a"), (1, "x y", "a"), (None, "x\x0by\x85z", "a"),
           (None, "", None), (7, " \t\r\n", ""), (8, "é " * 500, "a"), (9, "one", None)]
    want = odd + ROWS
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", want)
    sql = con.execute(mixing.oracle()).fetchall()
    got = plan_mix(documents(spark, want)).select("doc_id", "size", "source_size", "target", "taken")
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(sql, key=key)


def test_odd_tables(spark):
    assert plan_mix(documents(spark, [])).collect() == []
    blank = documents(spark, [(1, None, None), (2, "", "a"), (3, "  ", "a")])
    assert [(r.size, r.target, r.taken) for r in plan_mix(blank).collect()] == [(0, 0.0, 0)] * 3
    assert mix(blank).collect() == []
    extra = documents(spark, ROWS).selectExpr(
        "*", "1 AS none", "'q' AS src", "2 AS size", "3 AS key", "4 AS row", "5 AS before_size",
        "6 AS __part", "7 AS target", "8 AS __row", "9 AS `a.b`")
    plain = sorted((r.doc_id, r.taken) for r in plan_mix(documents(spark, ROWS)).collect())
    assert sorted((r.doc_id, r.taken) for r in plan_mix(extra).collect()) == plain
    out = mix(extra)
    assert {"none", "src", "a.b", "__epoch"} <= set(out.columns)
    assert out.where("`a.b` = 9 and none = 1 and size = 2").count() == out.count() > 0


def test_mix_holds_the_words(spark):
    docs = documents(spark, [(i, f"\n a{i}  b{i}\tc{i} " * (1 + i % 5), f"s{i % 3}")
                             for i in range(60)])
    plan = {r.doc_id: r.taken for r in plan_mix(docs).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    taken = dict.fromkeys(plan, 0)
    rows = mix(docs).collect()
    for r in rows:
        taken[r.doc_id] += len(re.findall(WORD, r.text))
        assert texts[r.doc_id].startswith(r.text)
    # Numbered rows have other ties than rows by id, not here, where ids are unique.
    assert taken == plan
    assert {r["__epoch"] for r in rows} == {0, 1}


def test_running_sums_with_one_hot_key(spark):
    df = Stage(spark, "test").save(spark.range(5000).selectExpr(
        "id", "id % 3 AS k", "id * id % 11 AS v", "1L AS one"))
    rows = running(df, ["k", "id"], ["v", "one"], Stage(spark, "test")).collect()
    so_far = n = 0
    for r in sorted(rows, key=lambda r: (r.k, r.id)):
        assert (r.before_v, r.before_one) == (so_far, n)
        so_far, n = so_far + r.v, n + 1
    assert n == 5000
