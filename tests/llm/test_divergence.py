"""Source divergence against a plain version; the transducer against a sorted list."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tradewake.llm import divergence
from tradewake.llm.divergence import audit
from tradewake.llm.transducer import Transducer

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}
SCHEMA = "text string, lang string, source string"


def plain(docs, top=200):
    docs = [tuple(x or "" for x in d) for d in docs]
    words = [(TERM.findall(t.translate(LOWER)), lang, s) for t, lang, s in docs]
    df, cf = defaultdict(Counter), defaultdict(Counter)
    for found, lang, s in words:
        df[lang].update(set(found))
        cf[lang, s].update(found)
    out = []
    for lang in {d[1] for d in docs}:
        kept = sorted((t for t, n in df[lang].items() if n >= 3), key=str.encode)
        sources = [s for x, s in cf if x == lang]

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 1) // (total + len(kept)) for t in kept}
        p = {s: shares(cf[lang, s]) for s in sources}
        q = shares(sum((cf[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(-sum((p[s][t] - p[h][t]) ** 2 // p[h][t] for t in kept), h.encode(), h)
                     for h in sources if h != s]
            terms = [(-((p[s][t] - q[t]) ** 2 // q[t]), t.encode(), t) for t in kept
                     if cf[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item, -v, k) for k, (v, _, item) in enumerate(found, 1)]
    return sorted(out)


def rows(df):
    return sorted(map(tuple, df.select("lang", "source", "part", "item", "value", "rank").collect()))


def corpus(n=400, seed=5):
    r = random.Random(seed)
    words = ["The", "of", "ab", "abc", "abd", "zé", "ÉA", "日", "日本", "x" * 300] + [
        "".join(r.choices("abcdé", k=r.randint(1, 6))) for _ in range(150)]
    return [(" ".join(r.choices(words, k=r.randint(0, 30))), r.choice(["en", "en", "en", "fr"]),
             r.choice(["s1", "s2", "é", "S1"])) for _ in range(n)]


ODD = [(None, None, None), ("", "de", "s1"), ("only once", "de", "s2"), ("1 2 3", "xx", "s1"),
       ("the of " * 5000, "en", "long"), ("Same", "yy", None), ("same", "yy", ""), ("SAME", "yy", "b")]


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text(alphabet="abcé日", min_size=1, max_size=6), max_size=60))
def test_transducer(terms):
    terms = sorted(t.encode() for t in terms)
    machine = Transducer.from_bytes(Transducer.build(terms).to_bytes())
    asked = [*terms, *(t + b"a" for t in terms), *(t[:-1] for t in terms if len(t) > 1), b"q"]
    want = [terms.index(t) if t in terms else -1 for t in asked]
    assert machine.ordinals(b" ".join(asked)).tolist() == want


def test_transducer_is_minimal():
    terms = sorted(a + b + c for a in (b"p", b"q", b"r") for b in (b"a", b"o") for c in (b"ing", b"s"))
    machine = Transducer.build(terms)
    # The start, one state behind each of the three letters, the vowels' state, i, n, the end.
    assert len(machine.final) == 6 and len(machine.keys) == 3 + 2 + 2 + 2
    assert machine.ordinals(b" ".join(terms)).tolist() == list(range(12))
    assert Transducer.build([]).ordinals(b"a b").tolist() == [-1, -1]


def test_same_rows_as_plain(spark, monkeypatch):
    docs = corpus() + ODD
    df = spark.createDataFrame(docs, SCHEMA)
    want = plain(docs)
    assert rows(audit(df)) == want
    assert rows(audit(df.repartition(6), per_range=7)) == want
    # Tasks that pass on what they hold all the time.
    monkeypatch.setattr(divergence, "HELD", 5)
    monkeypatch.setattr(divergence, "BATCH", 3)
    assert rows(audit(df, top=3)) == plain(docs, top=3)


def test_same_rows_as_sql(spark):
    docs = corpus(200, 9) + ODD
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", docs)
    assert rows(audit(spark.createDataFrame(docs, SCHEMA))) == sorted(
        con.execute(divergence.oracle()).fetchall())


def test_odd_tables(spark):
    assert audit(spark.createDataFrame([], SCHEMA)).collect() == []
    same = [("a b", "en", "s")] * 5 + [("b c", "en", "t")] * 3
    extra = spark.createDataFrame(same, SCHEMA).selectExpr(
        "*", "1 AS g", "2 AS ordinal", "3 AS term", "4 AS kept", "5 AS range", "6 AS `x.y`")
    assert rows(audit(extra)) == plain(same)
    nothing = [("", "en", "s"), (None, "en", "t")]
    assert rows(audit(spark.createDataFrame(nothing, SCHEMA))) == [
        ("en", "s", "pair", "t", 0, 1), ("en", "t", "pair", "s", 0, 1)]


def test_counts_beyond_long_products(spark):
    n = 20_000_000_000
    q = spark.range(1).select(
        divergence._share(divergence.F.lit(n), divergence.F.lit(3 * n), divergence.F.lit(7)).alias("p"))
    assert q.first().p == 1 + 10**9 * (n + 1) // (3 * n + 7)
    many = np.array([0, 1, 6, n, 3 * n + 6, 10**15])
    assert divergence.share(many, np.maximum(3 * n + 7, many + 1)).tolist() == [
        1 + 10**9 * (k + 1) // max(3 * n + 7, k + 1) for k in many.tolist()]
