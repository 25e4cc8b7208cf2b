"""Near-duplicate vectors by NN-descent.

Equal vectors are one class. The classes get a first neighbour graph from the leaves of random
projection orders. Then every list is refined by neighbours of neighbours: at each node whose list
changed, the vectors of its list are compared with each other, and a pair goes on if it is better
than the worst entry of either side. A node whose list holds nothing but links is saturated; its
list doubles, up to a width that keeps a round linear. When a round adds no link at all and no list
is left to double, the links of a
sample of nodes are audited against all vectors, and below the wanted recall the graph gets new
leaves and is refined further. Links are the graph's edges at or above the threshold, and components
follow from them. Where a list is still saturated at full width, links are counted exactly: such
vectors are put around pivots, and those of one pivot are compared block by block with every vector
that the angles to the pivot let reach them, whatever its component. Only counts are put out, and
one link for each two components that turn out to be one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Stage, in_batches
from .components import components

_UNIT = pa.schema([("vec_id", pa.int64()), ("unit", pa.binary())])
_CODED = pa.schema([("id", pa.int64()), ("tree", pa.int32()), ("code", pa.int64()),
                    ("unit", pa.binary())])
_EDGES = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("sim", pa.float64())])
_EDGE = "u long, v long, sim double"
_NUMBER = pa.schema([("u", pa.int64()), ("n", pa.int64())])
_HOME = pa.schema([("id", pa.int64()), ("home", pa.int64()), ("angle", pa.float64())])
_REACH = pa.schema([("cluster", pa.int64()), ("id", pa.int64())])
#: More than the rounding of an angle, in radians.
_SLACK = 1e-6


def _unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors of length 1 in double precision; null for those that link with nothing."""
    def rows():
        for batch in batches:
            for vec_id, x in zip(batch.column("vec_id").to_pylist(),
                                 batch.column("embedding").to_pylist()):
                unit = None
                if x and None not in x:
                    a = np.array(x, dtype=np.float64)
                    most = np.abs(a).max()
                    if np.isfinite(most) and most > 0:
                        a = a / most  # no overflow in the squares
                        unit = (a / np.sqrt((a * a).sum())).tobytes()
                yield vec_id, unit
    return in_batches(_UNIT, rows())


def _code(batches: Iterator[pa.RecordBatch], trees: int, bits: int, seed: int
          ) -> Iterator[pa.RecordBatch]:
    """Per vector and tree: the sides of random hyperplanes as bits of a number."""
    planes: dict[int, np.ndarray] = {}
    weights = 1 << np.arange(bits, dtype=np.int64)
    for batch in batches:
        ids, units = batch.column("id").to_pylist(), batch.column("unit").to_pylist()
        rows = []
        for i, raw in zip(ids, units):
            x = np.frombuffer(raw)
            if len(x) not in planes:
                planes[len(x)] = np.random.default_rng([seed, len(x)]).standard_normal(
                    (trees * bits, len(x)))
            side = (planes[len(x)] @ x > 0).reshape(trees, bits)
            rows += [(i, t, int(c), raw) for t, c in enumerate(side @ weights)]
        yield from in_batches(_CODED, iter(rows), most=2048)


def _best(sims: np.ndarray, k: int) -> np.ndarray:
    """Columns of the ``k`` largest values per row."""
    k = min(k, sims.shape[1])
    return np.argpartition(-sims, k - 1, axis=1)[:, :k]


def _matrix(units: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and vectors, one group per dimension; vectors of other length never meet."""
    sizes = np.array([len(u) for u in units])
    return [(at, np.frombuffer(b"".join(units[i] for i in at)).reshape(len(at), -1))
            for s in np.unique(sizes) for at in [np.flatnonzero(sizes == s)]]


def _leaves(batches: Iterator[pa.RecordBatch], leaf: int, k: int) -> Iterator[pa.RecordBatch]:
    """The best ``k`` neighbours of each vector among ``leaf`` rows next to it in the order."""
    ids: list[int] = []
    units: list[bytes] = []

    def compare():
        for at, x in _matrix(units):
            if len(at) < 2:
                continue
            sims = x @ x.T
            np.fill_diagonal(sims, -2)
            best = _best(sims, k)
            own = np.array(ids)[at]
            u = np.repeat(own, best.shape[1])
            v = own[best.ravel()]
            s = np.take_along_axis(sims, best, axis=1).ravel()
            ok = u != v
            yield pa.RecordBatch.from_arrays([pa.array(c[ok]) for c in (u, v, s)], schema=_EDGES)

    for batch in batches:
        ids += batch.column("id").to_pylist()
        units += batch.column("unit").to_pylist()
        while len(ids) >= 2 * leaf:
            rest = ids[leaf:], units[leaf:]
            ids, units = ids[:leaf], units[:leaf]
            yield from compare()
            ids, units = rest
    yield from compare()


def _top(edges: DataFrame, sizes: DataFrame, k: int) -> DataFrame:
    """The best entries of every node: ``k``, or as many as ``sizes`` says."""
    order = Window.partitionBy("u").orderBy(F.desc("sim"), "v")
    # A node stands in few lists at a time, so its entries fit; repeated pairs go first.
    ranked = edges.groupBy("u", "v").agg(F.max("sim").alias("sim"), F.min("new").alias("new")) \
        .withColumn("place", F.row_number().over(order))
    return ranked.join(sizes, "u", "left").where(
        F.col("place") <= F.coalesce("size", F.lit(k))).drop("size")


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs within each node's list that beat the worst entry of either side."""
    def compare(frame):
        ws, worst, news = (np.array(frame[c]) for c in ("w", "worst", "new"))
        for at, x in _matrix(frame["unit"]):
            if len(at) < 2:
                continue
            sims = x @ x.T
            bar = worst[at]
            ok = (sims > np.minimum(bar[:, None], bar[None, :]))
            ok &= news[at][:, None] | news[at][None, :]
            i, j = np.nonzero(np.triu(ok, 1))
            if len(i):
                a, b, s = ws[at][i], ws[at][j], sims[i, j]
                keep = a != b
                a, b, s = a[keep], b[keep], s[keep]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in ((a, b), (b, a), (s, s))],
                    schema=_EDGES)

    held = {c: [] for c in ("node", "w", "worst", "new", "unit")}
    for batch in batches:
        for c in held:
            held[c] += batch.column(c).to_pylist()
        nodes = np.array(held["node"])
        cuts = [0, *(np.flatnonzero(np.diff(nodes)) + 1).tolist()]
        for a, b in zip(cuts, cuts[1:]):
            yield from compare({c: held[c][a:b] for c in held})
        held = {c: held[c][cuts[-1]:] for c in held}
    if held["node"]:
        yield from compare(held)


def _against(batches: Iterator[pa.RecordBatch], ids, units, at_least: float
             ) -> Iterator[pa.RecordBatch]:
    """How many links the audited vectors have among the rows of each batch."""
    groups = _matrix(units)
    for batch in batches:
        own = np.array(batch.column("id").to_pylist())
        for at, x in _matrix(batch.column("unit").to_pylist()):
            for qa, q in groups:
                if q.shape[1] == x.shape[1]:
                    u = np.array(ids)[qa]
                    n = ((q @ x.T >= at_least) & (u[:, None] != own[at][None, :])).sum(axis=1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(u[n > 0]), pa.array(n[n > 0].astype(np.int64))], schema=_NUMBER)


def links(vectors: DataFrame, stage: Stage, at_least: float = 0.9, k: int = 12, widest: int = 48,
          trees: int = 10, bits: int = 24, leaf: int = 64, audit: int = 1024, recall: float = 0.99,
          tries: int = 4) -> tuple[DataFrame, DataFrame]:
    """Links ``(u, v)``, both directions, among distinct unit ``vectors(id, unit)``; and the nodes
    ``u`` that may have more links than are listed, since nothing but links is in their list.

    ``audit`` vectors at most, those with the least hash of their id, are compared with all others
    to measure the recall of links, of ``widest`` a node; they are the only rows that are collected.
    If the recall stays too low, every node counts as one with more links.
    """
    graph = None
    sizes = vectors.sparkSession.createDataFrame([], "u long, size int")
    sample = vectors.orderBy(F.xxhash64("id"), "id").limit(audit).collect()
    truth = stage.save(vectors.mapInArrow(partial(
        _against, ids=[r.id for r in sample], units=[bytes(r.unit) for r in sample],
        at_least=at_least), "u long, n long").groupBy("u").agg(
        F.least(F.sum("n"), F.lit(widest)).alias("n")))
    wanted = truth.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    for attempt in range(tries):
        coded = stage.save(vectors.mapInArrow(
            partial(_code, trees=trees, bits=bits, seed=attempt),
            "id long, tree int, code long, unit binary"))
        found = coded.repartitionByRange("tree", "code").sortWithinPartitions(
            "tree", "code", "id").mapInArrow(partial(_leaves, leaf=leaf, k=k), _EDGE)
        found = found.withColumn("new", F.lit(0))
        if graph is not None:
            found = found.union(graph.select("u", "v", "sim", F.lit(1).alias("new")))
        graph = stage.save(_top(found, sizes, k))
        stage.drop(coded)
        before = -1
        while True:
            number = graph.where(F.col("sim") >= at_least).count()
            # Lists that hold only links double, until the last entry is none.
            now = stage.save(graph.join(sizes, "u", "left").groupBy("u").agg(
                F.coalesce(F.max("size"), F.lit(k)).alias("old"), F.min("sim").alias("worst"),
                F.count("*").alias("n")).select("u", "old", F.when(
                    (F.col("worst") >= at_least) & (F.col("n") >= F.col("old")),
                    F.least(F.col("old") * 2, F.lit(widest))).otherwise(F.col("old"))
                    .cast("int").alias("size")).where(F.col("size") > k))
            grown = now.where("size > old").limit(1).count()
            sizes = now.select("u", "size")
            # Goes on for a single link or list, so that no group depends on the table's size.
            if number <= before and not grown:
                break
            before = number
            graph, old = _refine(graph, vectors, sizes, k, widest, stage), graph
            stage.drop(old)
        edges = graph.where(F.col("sim") >= at_least)
        linked = stage.save(edges.select("u", "v").union(edges.select("v", "u")).distinct())
        had = linked.groupBy("u").agg(F.count("*").alias("found")).join(truth, "u").agg(
            F.coalesce(F.sum(F.least("found", "n")), F.lit(0))).first()[0]
        if had >= recall * wanted:
            break
    else:
        return linked, vectors.select(F.col("id").alias("u"))
    crowded = edges.groupBy("u").agg(F.count("*").alias("n")).join(sizes, "u", "left").where(
        F.col("n") >= F.coalesce("size", F.lit(k))).select("u")
    return linked, crowded.union(linked.groupBy("u").agg(F.count("*").alias("n")).where(
        F.col("n") >= widest).select("u")).distinct()


def _angles(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(x @ y.T, -1, 1))


def _home(batches: Iterator[pa.RecordBatch], pivots: list[bytes], reach: float
          ) -> Iterator[pa.RecordBatch]:
    """The nearest pivot of each vector, if one is within ``reach``; else minus its length."""
    groups = _matrix(pivots) if pivots else []
    for batch in batches:
        ids = np.array(batch.column("id").to_pylist())
        for at, x in _matrix(batch.column("unit").to_pylist()):
            home, angle = np.full(len(at), -x.shape[1]), np.full(len(at), np.pi)
            for of, y in groups:
                if y.shape[1] == x.shape[1]:
                    far = _angles(x, y)
                    best = far.argmin(axis=1)
                    least = far[np.arange(len(at)), best]
                    home[least <= reach] = of[best][least <= reach]
                    angle[least <= reach] = least[least <= reach]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (ids[at], home, angle)],
                                             schema=_HOME)


def _pivots(crowd: DataFrame, reach: float, most: int = 2048, rounds: int = 8, sample: int = 1024
            ) -> list[bytes]:
    """Vectors of ``crowd`` more than ``reach`` apart, until all are within ``reach`` of one or
    ``most`` or ``rounds`` is reached; what is left then is compared with all vectors."""
    chosen: list[bytes] = []
    for _ in range(rounds):
        bare = crowd.select("id", "unit").mapInArrow(
            partial(_home, pivots=chosen, reach=reach), "id long, home long, angle double") \
            .where("home < 0").orderBy(F.xxhash64("id"), "id").limit(sample)
        rows = crowd.join(bare.select("id"), "id").orderBy(F.xxhash64("id"), "id") \
            .select("unit").collect()
        new: dict[int, list[np.ndarray]] = {}
        for (raw,) in rows:
            x = np.frombuffer(raw)
            near = new.setdefault(len(x), [])
            if len(chosen) < most and (
                    not near or _angles(x[None, :], np.array(near)).min() > reach):
                near.append(x)
                chosen.append(bytes(raw))
        if len(rows) < sample or len(chosen) >= most:
            break
    return chosen


def _reached(batches: Iterator[pa.RecordBatch], pivots: list[bytes], radius: dict[int, float],
             reach: float) -> Iterator[pa.RecordBatch]:
    """The pivots other than its own whose vectors may link with a vector."""
    groups = _matrix(pivots) if pivots else []
    for batch in batches:
        ids = np.array(batch.column("id").to_pylist())
        homes = np.array(batch.column("home").to_pylist(), dtype=np.int64)
        for at, x in _matrix(batch.column("unit").to_pylist()):
            rest = -x.shape[1]
            found = [(np.full(len(at), rest), np.arange(len(at)))] if rest in radius else []
            for of, y in groups:
                if y.shape[1] == x.shape[1]:
                    bound = np.array([radius.get(int(c), -np.inf) for c in of]) + reach + _SLACK
                    i, j = np.nonzero(_angles(x, y) <= bound)
                    found.append((of[j], i))
            for cluster, i in found:
                ok = cluster != homes[at][i]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cluster[ok]), pa.array(ids[at][i][ok])], schema=_REACH)


def _count(frame: pd.DataFrame, at_least: float, block: int) -> pd.DataFrame:
    """Linked members of the vectors of a pair of blocks, a block with itself coming once; and one
    link for each two components that links join."""
    i, j = frame["i"].iloc[0], frame["j"].iloc[0]
    left, right = frame[frame["own"] == i], frame[frame["own"] == j]
    sides = [(f["id"].to_numpy(), f["members"].to_numpy(), f["component"].to_numpy())
             for f in (left, right)]
    totals = [np.zeros(len(left), np.int64), np.zeros(len(right), np.int64)]
    parent: dict[int, int] = {}
    joins = []

    def root(c: int) -> int:
        while parent.get(c, c) != c:
            c = parent[c]
        return c

    def join(a: np.ndarray, b: np.ndarray) -> None:
        for c, d in np.unique(np.stack([a, b], axis=1), axis=0).tolist():
            x, y = root(c), root(d)
            if x != y:
                parent[max(x, y)] = min(x, y)
                joins.append((c, d))

    parts = [[(at[n:n + block], x[n:n + block]) for at, x in _matrix(list(f["unit"]))
              for n in range(0, len(at), block)] for f in (left, right)]
    for a, x in parts[0]:
        for b, y in parts[1]:
            if x.shape[1] != y.shape[1]:
                continue
            hit = (x @ y.T >= at_least) & (sides[0][0][a][:, None] != sides[1][0][b][None, :])
            totals[0][a] += hit @ sides[1][1][b]
            totals[1][b] += hit.T @ sides[0][1][a]
            c, d = (np.array([root(int(n)) for n in side[2][at]], dtype=np.int64)
                    for side, at in zip(sides, (a, b)))
            other = hit & (c[:, None] != d[None, :])
            if other.any():
                p, q = np.nonzero(other)
                join(c[p], d[q])
    out = [(sides[0][0], totals[0])]
    if i != j:
        # A crowded vector is counted where its own pivot is, against all that may link with it.
        takes = (right["home"] | ~right["crowded"]).to_numpy()
        out.append((sides[1][0][takes], totals[1][takes]))
    counts = pd.DataFrame({"id": np.concatenate([o[0] for o in out]),
                           "others": np.concatenate([o[1] for o in out])})
    ends = pd.DataFrame(joins, columns=["a", "b"], dtype="int64")
    return pd.concat([counts[counts["others"] > 0], ends])[["id", "others", "a", "b"]].astype("Int64")


def _counted(classes: DataFrame, joined: DataFrame, crowded: DataFrame, stage: Stage, block: int,
             at_least: float) -> DataFrame:
    """``id, others, a, b``: exact counts of the links that ``crowded`` nodes ``u`` have, for both
    of their ends, and links ``(a, b)`` of components, which have the other columns null.

    Every crowded vector belongs to one cluster, that of its nearest pivot or the one of all that
    have none. A vector whose angle to the pivot is more than the cluster's radius and the
    threshold's angle together links with none of its vectors; all others are compared with them.
    """
    reach = float(np.arccos(at_least))
    crowd = stage.save(classes.join(crowded, F.col("id") == F.col("u"), "left_semi"))
    pivots = _pivots(crowd, reach)
    homes = stage.save(crowd.select("id", "unit").mapInArrow(
        partial(_home, pivots=pivots, reach=reach), "id long, home long, angle double"))
    radius = {r.home: r.far for r in homes.groupBy("home").agg(F.max("angle").alias("far")).collect()}
    own = homes.select("id", F.col("home").alias("cluster"))
    none = -(2**62)  # no cluster has this number
    nodes = classes.join(own, "id", "left").join(
        joined, F.col("id") == F.col("node"), "left").select(
        "id", "unit", "members", F.coalesce("component", "id").alias("component"),
        F.col("cluster").isNotNull().alias("crowded"),
        F.coalesce("cluster", F.lit(none)).alias("home"))
    nodes = stage.save(nodes) if radius else nodes.limit(0)
    met = nodes.select("id", "unit", "home").mapInArrow(
        partial(_reached, pivots=pivots, radius=radius, reach=reach), "cluster long, id long")
    placed = stage.save(met.withColumn("home", F.lit(False)).union(
        own.select("cluster", "id", F.lit(True))))
    span = 8 * block
    size = placed.groupBy("cluster").agg(
        F.ceil(F.sum(F.col("home").cast("int")) / span).cast("int").alias("inner"),
        F.ceil(F.sum((~F.col("home")).cast("int")) / span).cast("int").alias("outer"))
    # Blocks of the cluster's own vectors come first; blocks of others aren't compared together.
    spread = F.xxhash64("id")
    block_of = F.when(F.col("home"), F.pmod(spread, "inner")).otherwise(
        F.col("inner") + F.pmod(spread, F.greatest("outer", F.lit(1)))).cast("int")
    last = F.when(F.col("home"), F.col("inner") + F.col("outer")).otherwise(F.col("inner"))
    pairs = placed.join(size, "cluster").withColumn("own", block_of).select(
        "cluster", "id", "home", "own", F.explode(F.sequence(F.lit(0), last - 1)).alias("other"))
    rows = pairs.join(nodes.drop("home"), "id").select(
        "cluster", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        "own", "home", "id", "unit", "members", "component", "crowded")
    return stage.save(rows.groupBy("cluster", "i", "j").applyInPandas(
        partial(_count, at_least=at_least, block=block), "id long, others long, a long, b long"))


def _refine(graph: DataFrame, vectors: DataFrame, sizes: DataFrame, k: int, widest: int,
            stage: Stage) -> DataFrame:
    """One round: lists of both directions, compared where they changed, merged into the graph."""
    worst = graph.join(sizes, "u", "left").groupBy("u").agg(
        F.min("sim").alias("low"), F.count("*").alias("n"),
        F.coalesce(F.max("size"), F.lit(k)).alias("size")).select(
        "u", F.when(F.col("n") < F.col("size"), -2.0).otherwise(F.col("low")).alias("worst"))
    entry = vectors.join(worst, F.col("id") == F.col("u")).select(
        F.col("id").alias("v"), "worst", "unit")
    ways = graph.select("u", "v", "sim", "new").union(
        graph.select("v", "u", "sim", "new"))
    lists = _top(ways, sizes.withColumn("size", F.least(F.col("size") * 2, F.lit(widest))), 2 * k)
    # ``new`` is 0 for entries of the last round, 1 for older ones.
    changed = lists.where("new = 0").select("u").distinct()
    filled = lists.join(changed, "u", "left_semi").join(entry, "v").select(
        F.col("u").alias("node"), F.col("v").alias("w"), "worst",
        (F.col("new") == 0).alias("new"), "unit")
    pairs = filled.repartition("node").sortWithinPartitions("node").mapInArrow(_local, _EDGE)
    merged = pairs.withColumn("new", F.lit(0)).union(
        graph.select("u", "v", "sim", F.lit(1).alias("new")))
    # A pair that was there before isn't new: the flag of a repeated pair is the older one.
    order = merged.groupBy("u", "v").agg(F.max("sim").alias("sim"), F.max("new").alias("new"))
    return stage.save(_top(order, sizes, k))


def near_vectors(table: DataFrame, at_least: float = 0.9, widest: int = 48, block: int = 1024,
                 **options) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    ``table`` has ``vec_id`` and ``embedding``, an array of numbers; other columns are ignored.
    Vectors with a cosine of at least ``at_least`` in double precision are linked; ``n_links`` counts
    the other vectors linked directly, equal ones included. A component is named by its least
    ``vec_id``, and that vector is kept. Vectors that are null, empty or zero or hold a null or a
    number that isn't finite link with nothing, and so do vectors of different length. Rows that
    repeat an id and its vector count as one partner, and each of them has its row in the result;
    rows without an id are ignored; an empty table gives an empty table.
    """
    stage = Stage(table.sparkSession, "vectors")
    units = stage.save(table.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
                       .where("vec_id is not null")
                       .mapInArrow(_unit, "vec_id long, unit binary"))
    alike = units.where("unit is not null").groupBy("unit").agg(
        F.min("vec_id").alias("id"), F.count_distinct("vec_id").alias("members"))
    classes = stage.save(alike)
    found, crowded = links(classes.select("id", "unit"), stage, at_least, widest=widest, **options)
    crowded = stage.save(crowded)
    joined = stage.save(components(found.select(F.col("u").alias("a"), F.col("v").alias("b")),
                                   stage))
    sizes = classes.select(F.col("id").alias("v"), "members")
    exact = _counted(classes, joined, crowded, stage, block, at_least)
    # Links with a crowded node at either end are all in the exact counts, the others in lists.
    plain = found.join(crowded, "u", "left_anti").join(
        crowded.withColumnRenamed("u", "v"), "v", "left_anti")
    others = plain.join(sizes, "v").select(F.col("u").alias("id"), F.col("members").alias("others")) \
        .union(exact.where("id is not null").select("id", "others")) \
        .groupBy("id").agg(F.sum("others").alias("others"))
    # Components that exact links join become one.
    merged = components(exact.where("id is null").select("a", "b"), stage).withColumnRenamed(
        "component", "whole")
    joined = classes.select("id").join(joined, F.col("id") == F.col("node"), "left").select(
        F.col("id").alias("node"), F.coalesce("component", "id").alias("part")).join(
        merged.withColumnRenamed("node", "part"), "part", "left").select(
        "node", F.coalesce("whole", "part").alias("component"))
    named = classes.join(others, "id", "left").join(
        joined, F.col("id") == F.col("node"), "left").select(
        "unit", (F.col("members") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
        F.coalesce("component", "id").alias("component_id"))
    out = units.join(named, "unit", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), (component == F.col("vec_id")).alias("kept"))
