"""Benchmark decontamination against an edit distance over all stretches."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tradewake.llm.decontaminate import (Index, Plan, Screen, _windows, best_match, clean_documents,
                                         contaminated, pairs_of, parts_of, words_of)


def words(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower())


def least_edits(item, doc):
    row = [0] * (len(doc) + 1)
    for i, w in enumerate(item, 1):
        new = [i]
        for j, v in enumerate(doc, 1):
            new.append(min(row[j - 1] + (w != v), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def edited(rnd, ws, n, vocabulary):
    ws = list(ws)
    for _ in range(n):
        k = rnd.randrange(len(ws))
        kind = rnd.randrange(3)
        if kind == 0:
            ws[k] = rnd.choice(vocabulary)
        elif kind == 1:
            ws.insert(k, rnd.choice(vocabulary))
        elif len(ws) > 1:
            del ws[k]
    return ws


def corpus(seed):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(150)]
    items = [(i, " ".join(rnd.choices(vocabulary, k=rnd.randint(5, 60)))) for i in range(25)]
    docs = []
    for d in range(120):
        body = rnd.choices(vocabulary, k=rnd.randint(0, 120))
        if d % 2:
            item = items[rnd.randrange(25)][1].split()
            n = int(rnd.choice([0, 0.05, 0.1, 0.2, 0.3]) * len(item))
            k = rnd.randint(0, len(body))
            body[k:k] = edited(rnd, item, n, vocabulary)
        docs.append((d, ", ".join(body).title()))
    return items + [(90, None), (91, ""), (92, "...")], docs + [(500, None), (501, ""), (502, "!?")]


class Held:
    def __init__(self, value):
        self.value = value


def at_tolerance(rnd, item, n, kind):
    """``n`` edits of one kind; new words are in no item."""
    ws = list(item)
    places = sorted(rnd.sample(range(len(ws)), n), reverse=True)
    for k in places:
        now = rnd.choice(["insert", "delete", "substitute"]) if kind == "mixed" else kind
        new = [] if now == "delete" else [f"n{rnd.getrandbits(40)}"]
        ws[k:k + (now != "insert")] = new
    return ws


@pytest.mark.parametrize("size", [5, 12, 25, 40, 41, 59, 80, 150, 300, 400])
@pytest.mark.parametrize("kind", ["mixed", "insert", "delete", "substitute"])
def test_recall_at_the_tolerance(size, kind):
    """Share of pairs with as many edits as are allowed that the keys find and the distance keeps."""
    rnd, plan, n = random.Random(size), Plan(), 40
    items = [words_of(" ".join(f"w{rnd.randrange(3000)}" for _ in range(size))) for _ in range(n)]
    rnd = random.Random(size)
    texts = [[f"w{rnd.randrange(3000)}" for _ in range(size)] for _ in range(n)]
    parts = [parts_of(w, plan) for w in items]
    docs = [" ".join([f"x{rnd.getrandbits(40)}" for _ in range(30)]
                     + at_tolerance(rnd, t, plan.edits(size), kind)
                     + [f"y{rnd.getrandbits(40)}" for _ in range(30)]) for t in texts]
    index = Index([(w.tobytes(), p) for w, p in zip(items, parts)])
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(n)), "t": [0] * n, "text": docs})
    found = set()
    for out in _windows(iter([batch]), plan, Held(index)):
        for r in out.to_pylist():
            if {k for p in parts[r["doc_id"]] for k in p["keys"]} & set(r["keys"]):
                edits, _, _ = best_match(items[r["doc_id"]], np.frombuffer(r["window"], np.uint64))
                if edits <= plan.edits(size):
                    found.add(r["doc_id"])
    assert len(found) >= 0.9 * n


def test_long_items_and_long_documents(spark):
    """An item of 25 parts is found whole in a text of 30,000 words and not where half is missing;
    a text that repeats an item 400 times is one document. Blocks of items change nothing."""
    rnd = random.Random(8)
    long = [f"w{rnd.randrange(4000)}" for _ in range(1000)]
    short = [f"v{i}" for i in range(30)]
    filler = [f"f{rnd.randrange(9999)}" for _ in range(30_000)]
    docs = [(1, " ".join(filler[:20_000] + at_tolerance(rnd, long, 200, "mixed") + filler[20_000:])),
            (2, " ".join(filler[:100] + long[:500] + filler[100:200])),
            (3, " ".join(short * 400)), (4, " ".join(filler))]
    bench = [(7, " ".join(long)), (None, " ".join(short)), (9, " ".join(short[:20]))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame(bench, "item_id long, text string")
    out = {limit: sorted((r.doc_id, r.item_id or 0, r.n_words) for r in contaminated(
        df, items, Plan(filter_words=limit)).collect()) for limit in (2_000_000, 1500)}
    assert out[1500] == out[2_000_000] == [(1, 7, 1000), (3, 0, 30), (3, 9, 20)]


@pytest.mark.parametrize("limit", [2_000_000, 0])
def test_against_all_stretches(spark, limit):
    items, docs = corpus(3)
    want = {}
    for d, text in docs:
        for i, item in items:
            ws = words(item)
            if ws and words(text):
                n = least_edits(ws, words(text))
                if n <= int(0.2 * len(ws) + 1e-9):
                    want[d, i] = n
    df = spark.createDataFrame([(d, t, "k") for d, t in docs], "doc_id long, text string, keys string")
    bench = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, size int")
    out = contaminated(df.repartition(3), bench, Plan(filter_words=limit)).collect()
    got = {(r.doc_id, r.item_id): r.n_edits for r in out}
    assert got.items() <= want.items()
    assert len(got) >= 0.97 * len(want)
    close = {k for k, n in want.items() if n <= 0.1 * len(words(dict(items)[k[1]]))}
    assert close <= set(got)
    for r in out:
        part = words(dict(docs)[r.doc_id])[r.start:r.end]
        assert least_edits(words(dict(items)[r.item_id]), part) == r.n_edits


def test_screen_loses_no_window():
    rnd, plan = random.Random(4), Plan()
    vocabulary = [f"v{i}" for i in range(60)]
    for _ in range(300):
        item = rnd.choices(vocabulary, k=rnd.randint(1, 50))
        n = plan.edits(len(item))
        inside = edited(rnd, item, n, vocabulary + ["x", "y"])
        before = [f"z{i}" for i in range(rnd.randint(0, 5))]
        doc = words_of(" ".join(before + inside + ["q"] * rnd.randint(0, 5)))
        ws = words_of(" ".join(item))
        screen = Screen(ws, pairs_of(ws))
        found = screen.passing(screen.sums(doc), len(doc), np.arange(len(doc)),
                               plan.size_class(len(item)), plan)
        assert len(before) in found or len(inside) == 0


def test_best_match():
    rnd = random.Random(1)
    for _ in range(200):
        a, b = ([rnd.randrange(4) for _ in range(rnd.randint(0, 9))] for _ in range(2))
        edits, lo, hi = best_match(np.array(a), np.array(b, dtype=np.int64))
        assert edits == least_edits(a, b)
        assert least_edits(a, b[lo:hi]) == edits


def test_documents_go_whole(spark):
    item = "one two three four five six seven eight nine ten eleven"
    rows = [(1, "x " + item + " y"), (2, "clean text"), (3, None), (3, item), (None, item), (None, "")]
    docs = spark.createDataFrame([(d, t, 7) for d, t in rows], "doc_id long, text string, t int")
    bench = spark.createDataFrame([(0, item)], "item_id long, text string")
    kept = clean_documents(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(
        [(2, "clean text", 7), (3, None, 7), (None, "", 7)], key=str)
    assert clean_documents(docs, bench.limit(0)).count() == 6
    assert clean_documents(docs.limit(0), bench).count() == 0
