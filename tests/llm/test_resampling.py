"""Importance resampling against a plain version with zlib."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tradewake.llm import resampling
from tradewake.llm.resampling import drawn_documents, feature_crcs, resample
from tradewake.llm.spans import REACH, span_crcs

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}
SCHEMA = "doc_id long, text string"


def features(text):
    words = WORD.findall((text or "").translate(LOWER))
    return [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def plain(docs, target, percent=5, least=20):
    def counts(texts):
        return Counter(zlib.crc32(f.encode()) % 10000 for t in texts for f in features(t))
    s, t = counts(x for _, x in docs), counts(target)
    every, wanted = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (every + 10000) / ((s[b] + 1) * (wanted + 10000))))
            for b in range(10000)]
    rows, long = [], []
    for i, text in docs:
        found = features(text)
        weight = sum(gain[zlib.crc32(f.encode()) % 10000] for f in found)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((i, len(found), weight, score))
        if len(WORD.findall((text or "").translate(LOWER))) >= least:
            long.append((-score, i is None, i))
    ranks = {i: k for k, (_, _, i) in enumerate(sorted(long)[:percent * len(long) // 100], 1)}
    return [(*r, ranks.get(r[0])) for r in rows]


def order(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is None, x or 0) for x in r))


def texts(n, seed=3):
    r = random.Random(seed)
    words = ["Abc", "d3", "été", "İX", "q", "日本", "zz9", "the", "of"] + [f"w{i}" for i in range(80)]
    return [r.choice([" ", "\n", "-"]).join(r.choices(words, k=r.choice([0, 1, 2, 3, 19, 20, 21, 90])))
            for _ in range(n)]


def test_spans_of_any_length():
    r = random.Random(1)
    data = np.frombuffer(r.randbytes(4 * REACH + 40), dtype=np.uint8)
    lengths = [1, 2, 3, REACH - 1, REACH, REACH + 1, 2 * REACH, 2 * REACH + 1, 3 * REACH + 7]
    spans = [(a, a + n) for n in lengths for a in (0, 1, 5, 30) if a + n <= len(data)]
    r.shuffle(spans)
    got = span_crcs(data, *map(np.array, zip(*spans)))
    assert got.tolist() == [zlib.crc32(data[a:b].tobytes()) for a, b in spans]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="aZ9 .é\x7f日\n", max_size=40), max_size=8),
       st.sampled_from([4, 30, 1 << 17]))
def test_features_of_any_text(found, piece):
    raw = [t.encode() for t in found]
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in raw], dtype=np.int64)))
    got = [[] for _ in found]
    before, resampling.PIECE = resampling.PIECE, piece
    try:
        for text, crcs in feature_crcs(np.frombuffer(b"".join(raw), dtype=np.uint8), offsets):
            for i, c in zip(text.tolist(), crcs.tolist()):
                got[i].append(c)
    finally:
        resampling.PIECE = before
    assert [sorted(x) for x in got] == [sorted(zlib.crc32(f.encode()) for f in features(t))
                                        for t in found]


def test_same_rows_as_plain(spark):
    docs = list(enumerate(texts(900))) + [
        (1000, None), (1001, ""), (1002, "-.-"), (1003, "x" * 3000 + " y " + "z" * 700 + " é" * 30),
        (1004, "the " * 20000), (-5, "of the " * 12), (None, "the of " * 40)]
    target = [t for t in texts(40, seed=8)] + [None, ""]
    got = resample(spark.createDataFrame(docs, SCHEMA),
                   spark.createDataFrame([(t,) for t in target], "text string"))
    assert order(got.collect()) == order(plain(docs, target))
    assert [f.dataType.typeName() for f in got.schema] == ["long"] * 5


def test_ties_repeats_and_clashes(spark):
    rows = [(3, "a b " * 10), (3, "a b " * 10), (1, "a"), (None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", "1 AS row", "2 AS one", "3 AS short", "4 AS score", "5 AS __part", "6 AS n_words")
    target = spark.createDataFrame([("a b",)], "text string").selectExpr("*", "1 AS doc_id")
    got = resample(docs, target, percent=100).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == [1, 2]
    assert {r.doc_id for r in got if r["rank"]} == {3}
    assert [r["rank"] for r in resample(docs, target.limit(0), percent=50).collect()].count(1) == 1
    assert drawn_documents(docs, target, percent=50).count() == 2  # both rows of the id drawn


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert resample(none, none).collect() == []
