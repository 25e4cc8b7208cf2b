"""Sequences against a plain loop, in batch and as a stream, and look-ups in bucketed tables."""

import random
import time

import pytest
from pyspark.sql import functions as F

from tests.helpers import page_rows
from tradewake.operators.measures import entry_page, valid_page
from tradewake.operators.sequence import match_sequence
from tradewake.plans.visits import bounces
from tradewake.session import shared_dir
from tradewake.sources.buckets import BucketedDimension
from tradewake.streaming.run import drain

SCHEMA = "mid string, kind string, ts long, n long"


def plain(events, kinds, within):
    out = []
    for mid in {e[0] for e in events if e[0] is not None}:
        own = sorted((e for e in events if e[0] == mid and e[2] is not None), key=lambda e: (e[2], e[3]))
        for i, e in enumerate(own):
            if e[1] not in kinds[0]:
                continue
            met, outcome = [e], "matched"
            for k in range(1, len(kinds)):
                n = own[i + k] if i + k < len(own) else None
                if n is None or n[2] - e[2] >= within:
                    outcome = "timed_out"
                elif n[1] in kinds[k]:
                    met.append(n)
                    continue
                else:
                    outcome = None
                break
            if outcome:
                out.append((outcome, len(met), tuple(x[3] for x in met)))
    return sorted(out)


def events(seed, n=300):
    r = random.Random(seed)
    rows = [(r.choice(["a", "a", "a", "b", "c"]), r.choice("xxyz"), r.randrange(0, 4000), i)
            for i in range(n)]
    return rows + [(None, "x", 5, n), ("a", "x", None, n + 1), ("d", "-", 7, n + 2), ("d", "x", 8, n + 3)]


def found(df):
    return sorted((r.outcome, r.length, tuple(e.n for e in r.events)) for r in df.collect())


@pytest.mark.parametrize("kinds", [("x",), ("x", "y"), ("xz", "xy", "x"), ("x", "x", "y", "z")])
def test_sequences_of_any_length(spark, kinds):
    rows = events(len(kinds))
    steps = [F.col("kind").isin(list(k)) for k in kinds]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert found(match_sequence(df, "mid", "ts", steps, 25, ["n"])) == plain(rows, kinds, 25)


def test_bounces_are_an_instance(spark):
    r = random.Random(2)
    df = page_rows(spark, [(r.choice("abc"), r.randrange(200_000), r.random() < 0.4,
                            r.choice(["home", ""])) for _ in range(200)])
    got = match_sequence(df.withColumn("mid", F.col("common.mid")), "mid", "ts",
                         [entry_page(), valid_page()], 10_000, ["offset"], ["ts", "offset"])
    timed_out = sorted(x.events[0].offset for x in got.where("outcome = 'timed_out'").collect())
    want = bounces(df, 10, ["ts", "offset"], columns=["common", "page", "ts", "offset"])
    assert timed_out == sorted(x.offset for x in want.collect())


def test_sequences_in_a_stream(spark, tmp_path):
    rows = [e for e in events(9) if e[2] is not None]
    # In order of time, over several batches, and an end that closes what is open.
    rows.sort(key=lambda e: e[2])
    folder = str(tmp_path / "in")
    for part in (rows[:100], rows[100:], [("end", "q", 100_000, 9999)]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        time.sleep(0.05)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    steps = [F.col("kind") == "x", F.col("kind") == "y"]
    got = drain(spark, match_sequence(stream, "mid", "ts", steps, 25, ["n"]), "sequence")
    assert found(got) == plain(rows, ("x", "y"), 25)


def test_look_up_moves_the_facts_only(spark, tmp_path):
    dim = BucketedDimension(spark, "dim_users", shared_dir(spark, "buckets"), 6)
    users = spark.createDataFrame(
        [(1, "first", 1), (1, "second", 2), (2, "b", 1), (3, "z", 2), (3, "a", 1), (None, "n", 0)],
        "id long, name string, since long")
    dim.store(users, "id", ["since"])
    facts = spark.createDataFrame([(1, "x"), (1, "y"), (2, "x"), (7, "x"), (None, "x")],
                                  "user_id long, what string")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    out = dim.look_up(facts, "user_id", {"user_name": "name", "old": F.col("since") + 1})
    assert sorted(map(tuple, out.collect()), key=str) == sorted(
        [(1, "x", "first", 2), (1, "y", "first", 2), (2, "x", "b", 2), (7, "x", None, None),
         (None, "x", None, None)], key=str)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = dim.look_up(facts, "user_id", {"user_name": "name"})._jdf.queryExecution() \
            .executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert plan.count("Exchange") == 1 and "SortMergeJoin" in plan
    # Stored again, without an order: still one row per key.
    dim.store(users, "id")
    assert {r.user_name for r in dim.look_up(facts.where("user_id = 1"), "user_id",
                                             {"user_name": "name"}).collect()} == {"first"}
    spark.sql("DROP TABLE dim_users")
