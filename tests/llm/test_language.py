"""Language identification: held-out accuracy and the edges."""

import random
import zlib

import numpy as np

from tradewake.llm.language import counts, fit, identify, train

SYLLABLES = {"aa": "the and tion ing er on re at", "bb": "der und ein sch ü ung ich keit",
             "cc": "la que é eau oi ment ou les", "dd": "ción os el ñ ar que do la"}


def text(rnd, lang):
    s = SYLLABLES[lang].split()
    return " ".join("".join(rnd.choices(s, k=rnd.randint(1, 4))) for _ in range(rnd.randint(3, 60)))


def corpus(n=800):
    rnd = random.Random(2)
    langs = list(SYLLABLES)
    return [(i, text(rnd, langs[i % 4]), langs[i % 4]) for i in range(n)]


def test_held_out_accuracy(spark):
    rows = corpus() + [(9000, "abc", None), (None, "abc", "aa"), (9001, None, "bb")]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows],
                                 "doc_id long, text string, lang string, score double")
    model = fit(docs, per_language=120)
    assert set(model.languages) == set(SYLLABLES) and len(model.centroids) == 16
    got = {r.doc_id: r for r in identify(docs, model).collect()}
    held = [(i, y) for i, _, y in corpus() if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum(got[i].lang_pred == y for i, y in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())
    assert got[9001].lang_pred == "und"
    # Text unlike any training text is far from all centroids.
    odd = spark.createDataFrame([(1, "жжж ззз ыыы щщщ"), (2, rows[0][1])], "doc_id long, text string")
    assert [r.rejected for r in sorted(identify(odd, model).collect())] == [True, False]


def test_edges(spark):
    model = train([(t, y) for _, t, y in corpus(200)])
    rows = [(1, None), (2, ""), (3, "12 !? \n"), (4, "the " * 60_000), (4, "the " * 60_000), (None, "É")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = identify(docs, model).collect()
    assert len(out) == len(rows)
    assert {r.lang_pred for r in out if r.doc_id in (1, 2, 3)} == {"und"}
    assert all(r.lang_pred in SYLLABLES for r in out if r.doc_id not in (1, 2, 3))
    assert identify(docs.limit(0), model).count() == 0
    nothing = fit(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert {r.lang_pred for r in identify(docs, nothing).collect()} == {"und"}


def test_counts():
    assert counts("ab", 13).sum() == 4 + 3 + 2  # " ab " has four letters or spaces
    assert np.array_equal(counts("A-B  c", 13), counts("a b\nC", 13))
    assert counts("1", 13) is None
