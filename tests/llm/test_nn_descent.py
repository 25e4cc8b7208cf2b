"""NN-descent against all pairs."""

import numpy as np

from tradewake.llm import nn_descent
from tradewake.llm.nn_descent import near_vectors


def brute(rows, at_least=0.9):
    good = [(i, np.array(x) / np.abs(x).max()) for i, x in rows
            if x and None not in x and np.isfinite(x).all() and np.any(x)]
    out = {i: [0, i] for i, _ in rows}
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for n, (i, x) in enumerate(good):
        for j, y in good[n + 1:]:
            if i != j and len(x) == len(y) and \
                    x @ y / np.sqrt((x @ x) * (y @ y)) >= at_least:
                out[i][0] += 1
                out[j][0] += 1
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (n, root(i), root(i) == i) for i, (n, _) in out.items()}


def test_against_all_pairs(spark):
    rng = np.random.default_rng(4)
    rows, i = [], 0
    for size in [1] * 400 + [2] * 60 + [5] * 10 + [70, 130]:
        base = rng.standard_normal(32)
        for _ in range(size):
            x = base + (0.12 * rng.standard_normal(32) if size > 1 else 0)
            rows.append((i, [float(np.float32(c)) for c in x]))
            i += 1
    rows += [(5000 + k, rows[3][1]) for k in range(40)]  # a crowd of copies
    rows += [(6000, None), (6001, []), (6002, [0.0] * 32), (6003, [None] + [1.0] * 31),
             (6004, [float("nan")] + [1.0] * 31), (6005, [float("inf")] + [1.0] * 31),
             (6006, [1.0, 2.0]), (6007, [2.0, 4.0]), (6008, [1e200, 1e200]), (6009, [1.0, 1.0])]
    df = spark.createDataFrame([(i, x, 1, "n") for i, x in rows],
                               "vec_id long, embedding array<double>, id int, unit string")
    got = {r[0]: tuple(r[1:]) for r in near_vectors(df.repartition(4), block=50).collect()}
    assert got == brute(rows)


def test_nothing(spark):
    assert near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    df = spark.createDataFrame([(1, None), (2, [0.0])], "vec_id long, embedding array<float>")
    assert sorted(map(tuple, near_vectors(df).collect())) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_two_crowds_joined_by_a_few_pairs(spark):
    rng = np.random.default_rng(5)

    def at(degrees, spread):
        a = np.radians(degrees)
        x = np.zeros(32)
        x[:2] = np.cos(a), np.sin(a)
        return x + spread * rng.standard_normal(32)
    rows = [at(0, 0.004) for _ in range(90)] + [at(36, 0.004) for _ in range(120)]
    rows += [at(6, 0.001) for _ in range(2)] + [at(30, 0.001) for _ in range(3)]  # .913 apart
    rows += [at(54, 0.001)] + [rng.standard_normal(32) for _ in range(60)]
    rows = [(i, [float(c) for c in x]) for i, x in enumerate(rows)]
    rows += [(1000 + k, rows[210][1]) for k in range(3)]
    want = brute(rows)
    assert want[95][1] == 0 and want[0][0] > 90 and want[210][0] == 90 + 4 + 3
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = {r[0]: tuple(r[1:]) for r in near_vectors(df, block=5).collect()}
    assert got == want


def test_crowds_beyond_the_pivots_are_counted(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = []
    for _ in range(6):
        base = rng.standard_normal(24)
        rows += [base + 0.1 * rng.standard_normal(24) for _ in range(20)]
    rows = [(i, [float(c) for c in x]) for i, x in enumerate(rows)]
    real = nn_descent._pivots
    monkeypatch.setattr(nn_descent, "_pivots", lambda crowd, reach: real(crowd, reach, most=2))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = {r[0]: tuple(r[1:]) for r in near_vectors(df, k=4, widest=8, block=6).collect()}
    assert got == brute(rows)


def test_small_groups_grow_beside_many_settled_ones(spark):
    rng = np.random.default_rng(7)
    rows, want = [], {}
    for size in [3] * 6000 + [8] + [20]:
        base, first = rng.standard_normal(32), len(rows)
        for _ in range(size):
            want[len(rows)] = (size - 1, first, len(rows) == first)
            rows.append((len(rows), (base + 0.03 * rng.standard_normal(32)).tolist()))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = {r[0]: tuple(r[1:]) for r in near_vectors(df, k=2, trees=6).collect()}
    assert got == want
