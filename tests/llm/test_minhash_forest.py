"""Near duplicates against all pairs compared in Python."""

import random
import re

import pytest

from tradewake.llm.minhash_forest import near_duplicates

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, size):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return set()
    if len(words) < size:
        return {tuple(words)}
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}


def brute(rows, size, percent=80):
    sets = {d: shingles(t, size) for d, t in rows}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            x, y = sets[a], sets[b]
            if x and y and min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= percent * len(x | y):
                    p, q = sorted((root(a), root(b)))
                    parent[q] = p
    return {d: (len(sets[d]), root(d), root(d) == d) for d in ids}


def corpus(seed=3):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows, base = [], [rnd.choices(words, k=rnd.randint(1, 90)) for _ in range(60)]
    common = rnd.choices(words, k=40)
    for b in base:
        rows.append(b)
        for _ in range(rnd.choice([0, 0, 1, 3, 12])):
            c = list(b)
            for _ in range(rnd.randint(0, 2)):
                c[rnd.randrange(len(c))] = rnd.choice(words)
            rows.append(c)
    hot = rnd.choices(words, k=60)
    for k in range(120):  # a crowd of near copies, all different
        c = list(hot)
        c[rnd.randrange(60)] = f"x{k}"
        rows.append(c)
    rows += [common + rnd.choices(words, k=30) for _ in range(60)]  # a shared passage
    return [(i, " ".join(r)) for i, r in enumerate(rows)] + [
        (1000, None), (1001, ""), (1002, " \t\n"), (1003, "One two"), (1004, "one  TWO\n"),
        (1005, "one"), (1006, "one two three"), (1007, "é É"), (1008, "é é")]


@pytest.mark.parametrize("size", [4, 5])
def test_against_all_pairs(spark, size):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows],
                                 "doc_id long, text string, component_id string").repartition(5)
    got = {r[0]: tuple(r[1:]) for r in near_duplicates(docs, words=size).collect()}
    assert got == brute(rows, size)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    out = near_duplicates(docs)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert out.count() == 0


def test_repeated_rows_and_long_text(spark):
    long = " ".join(f"t{i % 977}x{i // 50}" for i in range(30_000))
    docs = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (2, long),
                                  (3, long + " end")], "doc_id long, text string")
    got = sorted(map(tuple, near_duplicates(docs).collect()))
    assert [r[2] for r in got] == [1, 1, 2, 2]


def changed(rnd, words, count, mark):
    out = list(words)
    for k, at in enumerate(rnd.sample(range(0, len(words), 4), count)):
        out[at + 1] = f"{mark}y{k}"
    return out


def test_star_of_copies_that_only_its_centre_links(spark):
    rnd = random.Random(5)
    centre = [f"w{rnd.randrange(9000)}" for _ in range(200)]
    rows = [(i, " ".join(changed(rnd, centre, 5, i))) for i in range(1500)]
    rows.append((9999, " ".join(centre)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_duplicates(docs, words=4).collect()
    assert len(got) == 1501
    assert {r.component_id for r in got} == {0}


def test_crowd_of_several_components_against_all_pairs(spark):
    rnd = random.Random(11)
    base = [f"w{rnd.randrange(9000)}" for _ in range(160)]
    rows = []
    for c in range(25):  # variants of one text, too far from each other, with copies around each
        middle = changed(rnd, base, 9, f"c{c}")
        rows += [changed(rnd, middle, rnd.randint(2, 5), f"d{c}x{k}") for k in range(12)]
        rows.append(middle)
    rows = [(i, " ".join(r)) for i, r in enumerate(rows)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r[0]: tuple(r[1:]) for r in near_duplicates(docs, words=4, few=4, near=1).collect()}
    want = brute(rows, 4)
    assert 1 < len({v[1] for v in want.values()}) < 325
    assert got == want
