"""Line dedup against a search of all earlier positions."""

import random

import pytest

from tradewake.llm.common import Stage
from tradewake.llm.line_dedup import dedup_lines, delete_runs, earlier_copies, levels


def longest_earlier(rows):
    """For every position, the longest run that also starts at an earlier position."""
    docs = [(d, [x.rstrip(" \t\r\x0b\x0c") for x in (t or "").split("\n")]) for d, t in sorted(rows)]
    docs = [(d, [x for x in lines if x]) for d, lines in docs]
    seen, out = [], {}
    for d, lines in docs:
        for p in range(len(lines)):
            best = 0
            for other, q in seen:
                n = 0
                while p + n < len(lines) and q + n < len(other) and lines[p + n] == other[q + n]:
                    n += 1
                best = max(best, n)
            if best:
                out[d, p] = best
            seen.append((lines, p))
    return out


def brute(rows, min_lines, min_words):
    runs = {}
    for (d, p), n in longest_earlier(rows).items():
        runs.setdefault(d, []).append((p, n))
    return {d: t if t is None else delete_runs(t, runs.get(d, []), min_lines, min_words)[0]
            for d, t in rows}


def corpus(seed):
    rnd = random.Random(seed)
    line = lambda: " ".join(rnd.choices("abcdefgh", k=rnd.randint(1, 6)))
    passage = [line() for _ in range(9)]
    rows = []
    for d in range(40):
        lines = [line() if rnd.random() < .7 else "boiler plate line" for _ in range(rnd.randint(0, 9))]
        if rnd.random() < .4:
            a, b = sorted(rnd.sample(range(10), 2))
            lines[2:2] = passage[a:b]
        if rnd.random() < .2:
            lines += [rnd.choice(lines or ["x"])] * rnd.randint(2, 11)
        if rnd.random() < .3:
            lines.insert(0, "")
        rows.append((d, "\n".join(lines)))
    rows += [(50, rows[3][1]), (51, rows[3][1] + "\nlast"), (52, None), (53, ""), (54, "\n\n"),
             (55, "one  \ntwo\t"), (56, "one\ntwo"), (57, "ab\n" * 37), (58, "ab\ncd\n" * 9)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_longest_earlier_copies(spark, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    stage = Stage(spark, "t")
    at, found = levels(docs, stage)
    got = {(r.d, r.p): r.length
           for r in at.join(earlier_copies(at, found, stage), "at").collect()}
    assert got == longest_earlier(rows)


@pytest.mark.parametrize("least", [(1, 1), (1, 8), (3, 1)])
def test_deleted_text(spark, least):
    rows = corpus(7)
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, d int")
    out = dedup_lines(docs.repartition(4), *least)
    assert out.columns == ["doc_id", "text", "d", "__deleted", "__left"]
    assert {r.doc_id: r.text for r in out.collect()} == brute(rows, *least)


def test_edges(spark):
    assert dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    rows = [(1, "same words in this line here now ok"), (1, "same words in this line here now ok"),
            (None, "same words in this line here now ok"), (3, "unique")]
    out = dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, out), key=str) == sorted(
        [(1, "", 1, 0), (1, "", 1, 0), (None, rows[0][1], 0, 1), (3, "unique", 0, 1)], key=str)
