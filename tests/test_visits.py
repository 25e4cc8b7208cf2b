import random

import pytest
from pyspark.sql import functions as F

from tests.helpers import DAY, page_rows
from tradewake.plans.visits import bounces, unique_visits

E, P = True, False
ORDER = ("ts", "offset")


def found(df):
    return sorted((r.mid, r.ts) for r in df.select("common.mid", "ts").collect())


@pytest.mark.parametrize("events, expected", [
    ([("a", 0, E), ("a", 5000, P)], []),
    ([("a", 0, E), ("a", 9999, P)], []),
    ([("a", 0, E), ("a", 10000, P)], [("a", 0)]),
    ([("a", 0, E), ("a", 20000, P)], [("a", 0)]),
    ([("a", 0, E)], [("a", 0)]),
    ([("a", 0, E), ("a", 3000, E)], [("a", 3000)]),
    ([("a", 0, E), ("a", 5000, P, "")], []),
    ([("a", 0, P)], []),
    ([("a", 0, E), ("a", 0, P)], []),
    ([("a", 0, P), ("a", 0, E)], [("a", 0)]),
    ([("a", 0, E), ("b", 1000, P)], [("a", 0)]),
    ([("a", 9000, E), ("a", 11000, P)], []),
    ([("a", 9000, E), ("a", 19000, P)], [("a", 9000)]),
    ([("a", 9000, E), ("a", 25000, P)], [("a", 9000)]),
])
def test_bounces(spark, events, expected):
    assert found(bounces(page_rows(spark, events), 10, ORDER)) == expected


def slow_bounces(events, within_ms):
    out = []
    for mid, ts, entry, i in events:
        later = [(t, j) for m, t, _, j in events if m == mid and (t, j) > (ts, i)]
        if entry and not any(t - ts < within_ms for t, _ in later):
            out.append((mid, ts))
    return sorted(out)


def test_bounces_against_brute_force_and_row_order(spark):
    rng = random.Random(7)
    events = [(rng.choice("aaaabc"), rng.randrange(0, 400_000), rng.random() < 0.5)
              for _ in range(300)]
    page = page_rows(spark, events)
    expected = slow_bounces([(*e, i) for i, e in enumerate(events)], 10_000)
    assert found(bounces(page, 10, ORDER)) == expected
    assert found(bounces(page.orderBy(F.rand(3)), 10, ORDER)) == expected


def test_bounce_plan_combines_before_its_only_shuffle(spark):
    plan = bounces(page_rows(spark, [("a", 0, E)]), 10, ORDER)._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert text.count("Exchange") == 1
    before = text[text.index("Exchange"):]
    assert "partial_max_by" in before and "Join" not in text and "Window [" not in text


@pytest.mark.parametrize("events, entry_only, expected", [
    ([("a", 1, E), ("a", 2, E), ("a", 3, E)], False, [("a", 1)]),
    ([("a", 1, E), ("a", DAY, E)], False, [("a", 1), ("a", DAY)]),
    ([("a", 1, E), ("a", DAY, E), ("a", 2, E)], False, [("a", 1), ("a", DAY)]),
    ([("a", 1, P), ("a", 2, E)], True, [("a", 2)]),
    ([("a", 1, P), ("a", 2, E)], False, [("a", 1)]),
    ([("a", 1, P)], True, []),
])
def test_unique_visits(spark, events, entry_only, expected):
    page = page_rows(spark, events)
    assert found(unique_visits(page, entry_only, ORDER)) == expected


def test_unique_visits_has_one_row_per_device_and_day(spark):
    rng = random.Random(3)
    events = [(rng.choice("ab"), rng.randrange(0, 5 * DAY), True) for _ in range(200)]
    got = found(unique_visits(page_rows(spark, events), True, ORDER))
    first = {}
    for mid, ts, _ in sorted(events, key=lambda e: e[1]):
        first.setdefault((mid, ts // DAY), ts)
    assert got == sorted((mid, ts) for (mid, _), ts in first.items())


def test_bounces_of_named_columns_compile(spark):
    rows = page_rows(spark, [("a", 0, E), ("a", 40_000, E)]).withColumn(
        "display", F.expr("array(named_struct('item_type', 'sku_id', 'item', '9'))"))
    settings = {"spark.sql.codegen.fallback": "false",
                "spark.sql.codegen.factoryMode": "CODEGEN_ONLY"}
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        out = bounces(rows, order=ORDER, columns=["common", "page", "ts", "offset"])
        assert found(out) == [("a", 0), ("a", 40_000)]
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_a_short_delay_is_refused_in_a_stream(spark, tmp_path):
    page = page_rows(spark, [("a", 0, E)])
    page.write.parquet(str(tmp_path / "p"))
    stream = spark.readStream.schema(page.schema).parquet(str(tmp_path / "p"))
    with pytest.raises(ValueError):
        unique_visits(stream, delay="2 hours")
