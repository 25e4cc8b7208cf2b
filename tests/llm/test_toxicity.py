"""Toxicity: held-out accuracy on invented text, and the edges."""

import random
import zlib

from tradewake.llm.toxicity import drop_toxic, fit, score, train, windows

TOXIC = ["zarglub", "krexnit", "vomplork"]


def text(rnd, toxic):
    syllables = ["ba", "ne", "ti", "lo", "ru", "san", "mer", "col", "den", "fi"]
    words = ["".join(rnd.choices(syllables, k=rnd.randint(1, 4))) for _ in range(rnd.randint(20, 150))]
    if toxic:
        for _ in range(rnd.randint(2, 5)):
            words.insert(rnd.randrange(len(words)), rnd.choice(TOXIC))
    return " ".join(words)


def corpus(n=900):
    rnd = random.Random(1)
    return [(i, text(rnd, i % 3 == 0), int(i % 3 == 0)) for i in range(n)]


def test_held_out_accuracy(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, 1) for i, t, _ in rows], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (5000, None)],
                                   "doc_id long, toxic int")
    model = fit(docs, labels)
    out = {r.doc_id: r.score for r in score(docs, model).collect()}
    held = [(out[i], y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(out) == len(rows) and all(0 <= s <= 1 for s in out.values())
    assert sum((s >= .5) == y for s, y in held) >= 0.95 * len(held)
    kept = drop_toxic(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, s in out.items() if s < .5}


def test_edges(spark):
    model = train([(t, y) for _, t, y in corpus(300)])
    rows = [(1, None), (2, ""), (3, " \n"), (4, "w " * 40_000), (4, "w " * 40_000), (None, "zarglub")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = score(docs, model).collect()
    assert len(out) == len(rows)
    assert len({r.score for r in out if r.doc_id in (1, 2, 3)}) == 1
    assert score(docs.limit(0), model).count() == 0
    assert train([]).weights and train([("a", 1)]).weights and train([(None, 0), (None, 1)]).weights
    assert b" ".join(w.strip() for w in windows("A b\nC " * 20)) == b"a b c " * 19 + b"a b c"


def test_no_labels(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    model = fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert [r.score for r in score(docs, model).collect()] == [0.5]
