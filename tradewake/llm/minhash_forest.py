"""Near-duplicate documents by an LSH forest of MinHash signatures.

A document is its set of distinct word shingles. Equal sets are classes of their own; only one
document of a class goes on. Every class gets a MinHash signature, cut into ``trees`` keys of
``depth`` values. Each tree is one global sort order of the keys. In it, documents that share a
long key prefix are neighbours, and how long the prefix has to be is settled region by region:
where few documents share ``least_depth`` values, all of them are compared; where many do, the
shallowest prefix that few share decides, and the crowded region is linked by nearest neighbours
and by its first document. Candidates pass a comparison of whole signatures, and are confirmed on
the full shingle sets. Links give connected components. What a crowded region still holds of
different components is then compared in blocks, so that no link between them is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stage, emit, in_batches, lower_ascii, mix, rows_of, shingle_set
from .components import components

_SIGNED = pa.schema([
    ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_hi", pa.int64()),
    ("set_lo", pa.int64()), ("signature", pa.binary()), ("low", pa.binary())])
_PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def multipliers(count: int) -> np.ndarray:
    """Odd multipliers of the hash functions, the same in every task."""
    return mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) \
        | np.uint64(1)


def minhash(shingles: np.ndarray, factors: np.ndarray, chunk: int = 2048) -> np.ndarray:
    """Upper 32 bits of the least value of every hash function over a non-empty set."""
    least = np.full(len(factors), np.uint64(2**64 - 1))
    for at in range(0, len(shingles), chunk):
        part = factors[:, None] * shingles[None, at:at + chunk]
        np.minimum(least, part.min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def _sign(batches: Iterator[pa.RecordBatch], words: int, count: int) -> Iterator[pa.RecordBatch]:
    factors = multipliers(count)

    def rows():
        for doc_id, text in rows_of(batches, "doc_id", "text"):
            s = shingle_set(lower_ascii(text), words)
            if not len(s):
                yield doc_id, 0, 0, 0, None, None
                continue
            # Two independent sums over the set tell equal sets from different ones.
            hi = mix(s).sum(dtype=np.uint64).view(np.int64)
            lo = mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64).view(np.int64)
            values = minhash(s, factors)
            # The lowest byte of each value tells equal ones; chance adds under half a percent.
            yield (doc_id, len(s), int(hi), int(lo), values.astype(">u4").tobytes(),
                   values.astype(np.uint8).tobytes())
    return in_batches(_SIGNED, rows())


def _lcp(keys: np.ndarray) -> np.ndarray:
    """Equal leading values of each row and the next; 0 after the last row."""
    if len(keys) < 2:
        return np.zeros(len(keys), dtype=np.int64)
    same = keys[1:] == keys[:-1]
    return np.append(np.cumprod(same, axis=1).sum(axis=1), 0)


def neighbours(keys: np.ndarray, ids: np.ndarray, trees: np.ndarray, least_depth: int,
               few: int, near: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Candidate pairs among sorted keys, and the rows whose region they don't settle.

    ``few`` bounds the regions that are compared as a whole; in larger regions a document meets
    its ``near`` next ones and the first document of the deepest crowded region. Rows of larger
    regions, and of the first and last one, which may go on outside, are marked.
    """
    n, depth = keys.shape
    if n < 2:
        return ids[:0], ids[:0], np.ones(n, dtype=bool)
    lcp = _lcp(keys)
    lcp[:-1][trees[1:] != trees[:-1]] = -1
    lcp[-1] = -1
    own = np.full(n, depth + 1)
    crowded = np.full(n, -1)
    for d in range(depth, least_depth - 1, -1):
        start = np.append(True, lcp[:-1] < d)
        region = np.cumsum(start) - 1
        size = np.bincount(region)[region]
        own[size <= few] = d
        first = np.flatnonzero(start)[region]
        deepest = (size > few) & (crowded < 0)
        crowded[deepest] = first[deepest]
    open_ = (own > least_depth) | (region == 0) | (region == region[-1])
    left, right = [], []
    low = np.full(n, depth)
    for step in range(1, min(few, n)):
        low = low[:n - step]
        low = np.minimum(low, lcp[step - 1:n - 1])
        ok = low >= (np.minimum(own[:n - step], least_depth) if step <= near
                     else own[:n - step])
        at = np.flatnonzero(ok)
        left.append(at)
        right.append(at + step)
    at = np.flatnonzero((crowded >= 0) & (crowded != np.arange(n)))
    left.append(crowded[at])
    right.append(at)
    a, b = ids[np.concatenate(left)], ids[np.concatenate(right)]
    return np.minimum(a, b), np.maximum(a, b), open_


def _unpack(batches: list[pa.RecordBatch], depth: int):
    table = pa.Table.from_batches(batches)
    keys = np.frombuffer(b"".join(table.column("key").to_pylist()), dtype=">u4")
    return (table.column("tree").to_numpy().astype(np.int64),
            keys.reshape(-1, depth).astype(np.uint32), table.column("doc_id").to_numpy())


_SEEN = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("tree", pa.int32()),
                   ("key", pa.binary()), ("seam", pa.int64())])


def _scan(batches: Iterator[pa.RecordBatch], depth: int, least_depth: int, few: int,
          near: int, most: int = 1 << 17) -> Iterator[pa.RecordBatch]:
    """Candidate pairs of a sorted partition, read ``most`` rows at a time; the rows of unsettled
    regions with their region's key; and the rows at both sides of every seam."""
    part = TaskContext.get().partitionId()
    seam, tail = part << 32, []

    def chunks():
        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n >= most:
                yield _unpack(held, depth)
                held, n = [], 0
        if held:
            yield _unpack(held, depth)

    for trees, keys, ids in chunks():
        a, b, unsettled = neighbours(keys, ids, trees, least_depth, few, near)
        pairs = np.unique(np.stack([a, b]), axis=1) if len(a) else np.zeros((2, 0), np.int64)
        for at in range(0, pairs.shape[1], 65536):
            x = pairs[:, at:at + 65536]
            none = [pa.nulls(x.shape[1], f.type) for f in list(_SEEN)[2:]]
            yield pa.RecordBatch.from_arrays([pa.array(x[0]), pa.array(x[1]), *none], schema=_SEEN)
        at = np.flatnonzero(unsettled)
        yield from in_batches(_SEEN, (
            (int(ids[i]), None, int(trees[i]), keys[i, :least_depth].astype(">u4").tobytes(), None)
            for i in at), most=65536)

        def edge(span, place):
            return [(int(ids[i]), None, int(trees[i]), keys[i].astype(">u4").tobytes(), place)
                    for i in span]
        n = len(ids)
        if tail:
            yield emit(_SEEN, [(*row[:4], seam) for row in tail])
        yield emit(_SEEN, edge(range(min(few, n)), seam))
        seam += 1
        tail = edge(range(max(0, n - few), n), None)
    if tail:
        yield emit(_SEEN, [(*row[:4], part + 1 << 32) for row in tail])


def _per_group(fn, **args):
    """A function of one group, with the type hints that Spark looks for."""
    def run(table: pa.Table) -> pa.Table:
        return fn(table, **args)
    return run


def _seam(table: pa.Table, depth: int, least_depth: int, few: int, near: int) -> pa.Table:
    """Candidate pairs among the rows around one seam."""
    rows = sorted(rows_of(table.to_batches(), "tree", "key", "a"))
    keys = np.frombuffer(b"".join(r[1] for r in rows), dtype=">u4").reshape(-1, depth)
    a, b, _ = neighbours(keys.astype(np.uint32), np.array([r[2] for r in rows]),
                         np.array([r[0] for r in rows]), least_depth, few, near)
    return pa.Table.from_arrays([pa.array(a), pa.array(b)], schema=_PAIRS)


def candidates(signed: DataFrame, stage: Stage, trees: int, depth: int, least_depth: int,
               few: int, near: int) -> tuple[DataFrame, DataFrame]:
    """Distinct pairs ``(a, b)``, ``a < b``, that are neighbours in some tree; and rows
    ``(doc_id, tree, key)`` for the documents of regions that these pairs don't settle."""
    width = 4 * depth
    forest = signed.select(
        "doc_id", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"),
        "signature").select(
        "doc_id", "tree", F.expr(f"substring(signature, tree * {width} + 1, {width})").alias("key"))
    # The id is part of the order, so that equal keys of any number spread over partitions.
    order = forest.repartitionByRange("tree", "key", "doc_id").sortWithinPartitions(
        "tree", "key", "doc_id")
    args = {"depth": depth, "least_depth": least_depth, "few": few, "near": near}
    seen = stage.save(order.mapInArrow(
        partial(_scan, **args), "a long, b long, tree int, key binary, seam long"))
    seams = seen.where("seam is not null").groupBy("seam").applyInArrow(
        _per_group(_seam, **args), "a long, b long")
    pairs = seen.where("b is not null").select("a", "b").union(seams).where("a <> b").distinct()
    return pairs, seen.where("b is null and seam is null").select(
        F.col("a").alias("doc_id"), "tree", "key")


_BLOCK_ROWS, _BLOCK_BYTES = 2048, 16 << 20
_REGION = ["tree", "key"]


def _blocks(members: DataFrame) -> DataFrame:
    """Pairs of blocks ``(lo, hi)`` that every member of a region has to be in.

    ``members`` has the region, ``doc_id``, ``label`` and ``size`` in bytes. Regions of one label
    go. The documents of a region's most common label need not meet each other, so their blocks
    meet the blocks of the others only. A block has about 2,048 documents or 16 MB at most, dealt
    by a hash of the id, whatever the size of the region.
    """
    labels = members.groupBy(*_REGION, "label").agg(
        F.count("*").alias("n"), F.sum("size").alias("bytes"))
    regions = labels.groupBy(*_REGION).agg(
        F.max_by("label", F.struct("n", "label")).alias("main"), F.max("n").alias("n_main"),
        F.max_by("bytes", F.struct("n", "label")).alias("b_main"),
        F.sum("n").alias("n_all"), F.sum("bytes").alias("b_all")).where("n_all > n_main").select(
        *_REGION, "main",
        F.expr(f"cast(ceil(greatest(n_main / {_BLOCK_ROWS}, b_main / {_BLOCK_BYTES})) as int)")
        .alias("d"),
        F.expr(f"cast(ceil(greatest((n_all - n_main) / {_BLOCK_ROWS}, "
               f"(b_all - b_main) / {_BLOCK_BYTES})) as int)").alias("k"))
    placed = members.join(regions, _REGION).withColumn("block", F.expr(
        "cast(if(label = main, k + pmod(xxhash64(doc_id), d), pmod(xxhash64(doc_id), k)) as int)"))
    return placed.withColumn("other", F.explode(F.expr(
        "sequence(0, if(block < k, k + d, k) - 1)"))).select(
        *_REGION, "doc_id", "label", "block", F.least("block", "other").alias("lo"),
        F.greatest("block", "other").alias("hi"))


def _sides(table: pa.Table):
    """Places of the rows of both blocks of a pair; ``lo = hi`` compares a block with itself."""
    block, lo, hi = (table.column(c).to_numpy() for c in ("block", "lo", "hi"))
    return np.flatnonzero(block == lo), np.flatnonzero(block == hi)


def _bytes(table: pa.Table, column: str, kind, *shape: int) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(column).to_pylist()), dtype=kind).reshape(
        -1, *shape)


def _near(table: pa.Table, count: int, percent: int, least: float, below: float = 2.0,
          rows: int = 512):
    """Places ``(x, y)`` and agreement of pairs with other labels, sizes that allow a link, and an
    agreement from ``least`` to ``below`` of their signatures, some rows at a time."""
    left, right = _sides(table)
    low = _bytes(table, "low", np.uint8, count)
    label = table.column("label").to_numpy()
    size = table.column("n_shingles").to_numpy()
    across = np.ascontiguousarray(low[right].T)
    for at in range(0, len(left), rows):
        some = left[at:at + rows]
        same = np.zeros((len(some), len(right)), dtype=np.uint16)
        for value in range(count):
            same += low[some, value][:, None] == across[value][None, :]
        ok = (label[some][:, None] != label[right][None, :]) & (
            100 * np.minimum.outer(size[some], size[right])
            >= percent * np.maximum.outer(size[some], size[right])) & (
            same >= least * count) & (same < below * count)
        i, j = np.nonzero(ok)
        yield some[i], right[j], same[i, j]


def _unsettled(table: pa.Table, count: int, percent: int, least: float) -> pa.Table:
    """The documents of a pair of blocks that a document of another label may be linked with."""
    found = np.zeros(table.num_rows, dtype=bool)
    for x, y, _ in _near(table, count, percent, least):
        found[x] = found[y] = True
    return table.select([*_REGION, "doc_id"]).filter(pa.array(found))


def _join_labels(table: pa.Table, count: int, depth: int, least_depth: int, percent: int,
                 least: float, below: float) -> pa.Table:
    """Confirmed links between documents of other labels, best agreement first. What the links of
    this pair of blocks have joined is not compared again, so the links are fewer than the rows.
    A pair that shares a region of an earlier tree is left to that one."""
    ids, label = table.column("doc_id").to_numpy(), table.column("label").to_numpy()
    tree = table.column("tree")[0].as_py() if table.num_rows else 0
    deep = _bytes(table, "signature", ">u4", count // depth, depth)[:, :tree, :least_depth]
    sets = table.column("shingles")
    top = {int(v): int(v) for v in label}
    held: dict[int, np.ndarray] = {}

    def find(v: int) -> int:
        while top[v] != v:
            top[v] = v = top[top[v]]
        return v

    def shingles(i: int) -> np.ndarray:
        if i not in held:
            held[i] = np.frombuffer(sets[i].as_py(), dtype=np.uint64)
        return held[i]

    links = []
    for x, y, same in _near(table, count, percent, least, below):
        order = np.argsort(-same.astype(np.int64), kind="stable")
        for at in range(0, len(order), 4096):
            i, j = x[order[at:at + 4096]], y[order[at:at + 4096]]
            new = ~(deep[i] == deep[j]).all(axis=2).any(axis=1)
            for p, q in zip(i[new].tolist(), j[new].tolist()):
                a, b = find(int(label[p])), find(int(label[q]))
                if a == b:
                    continue
                s, t = shingles(p), shingles(q)
                both = len(np.intersect1d(s, t, assume_unique=True))
                if 100 * both >= percent * (len(s) + len(t) - both):
                    top[max(a, b)] = min(a, b)
                    links.append((min(ids[p], ids[q]), max(ids[p], ids[q])))
    return pa.Table.from_batches([emit(_PAIRS, links)])


def _shingle_rows(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("shingles", pa.binary())])
    return in_batches(schema, (
        (doc_id, shingle_set(lower_ascii(text), words).tobytes())
        for doc_id, text in rows_of(batches, "doc_id", "text")))


def settle(crowd: DataFrame, classes: DataFrame, docs: DataFrame, joined: DataFrame, stage: Stage,
           count: int, depth: int, least_depth: int, words: int, percent: int, screen: float
           ) -> DataFrame:
    """Components ``(node, component)`` after the links of crowded regions are whole.

    Only links between documents of different components are looked for. Every two documents of a
    region that have different labels are compared by signature, in blocks; no pairs are put out,
    only the documents that have a partner. Their sets are then compared in the order of agreement,
    in three bands, with new labels after each. Quadratic in the documents of a region outside its
    most common label, with bounded memory.
    """
    lowest = percent / 100 - screen

    def labelled(rows: DataFrame) -> DataFrame:
        return rows.join(joined.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left"
                         ).withColumn("label", F.coalesce("component", "doc_id")).drop("component")

    about = classes.select("doc_id", "n_shingles", "low", "signature")
    members = labelled(crowd).withColumn("size", F.lit(count))
    rows = _blocks(members).join(about.drop("signature"), "doc_id")
    flagged = stage.save(rows.groupBy(*_REGION, "lo", "hi").applyInArrow(
        _per_group(_unsettled, count=count, percent=percent, least=lowest),
        "tree int, key binary, doc_id long").distinct())
    if flagged.isEmpty():
        return joined
    ends = flagged.select("doc_id").distinct()
    sets = stage.save(docs.hint("merge").join(ends, "doc_id", "left_semi").dropDuplicates(
        ["doc_id"]).mapInArrow(
        partial(_shingle_rows, words=words), "doc_id long, shingles binary"))
    below = 2.0
    for least in (lowest + 0.11, lowest + 0.05, lowest):
        members = labelled(flagged.join(about.select(
            "doc_id", (8 * F.col("n_shingles")).alias("size")), "doc_id"))
        rows = _blocks(members).join(about, "doc_id").join(sets, "doc_id")
        links = stage.save(rows.groupBy(*_REGION, "lo", "hi").applyInArrow(
            _per_group(_join_labels, count=count, depth=depth, least_depth=least_depth,
                       percent=percent, least=least, below=below), "a long, b long"))
        below = least
        if not links.isEmpty():
            joined = stage.save(components(joined.select(
                F.col("node").alias("a"), F.col("component").alias("b")).union(links), stage))
    return joined


def _alike(batches: Iterator[pa.RecordBatch], count: int, at_least: float
           ) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint8)
                .reshape(-1, count) for c in ("x", "y"))
        keep = pa.array((x == y).mean(axis=1) >= at_least)
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b")], schema=_PAIRS).filter(keep)


def _confirm(batches: Iterator[pa.RecordBatch], words: int, percent: int
             ) -> Iterator[pa.RecordBatch]:
    held: tuple = (None, None)

    def rows():
        nonlocal held
        for a, b, x, y in rows_of(batches, "a", "b", "x", "y"):
            if held[0] != a:
                held = (a, shingle_set(lower_ascii(x), words))
            s, t = held[1], shingle_set(lower_ascii(y), words)
            both = len(np.intersect1d(s, t, assume_unique=True))
            if 100 * both >= percent * (len(s) + len(t) - both):
                yield a, b
    return in_batches(_PAIRS, rows())


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, trees: int = 16,
                    depth: int = 8, least_depth: int = 3, few: int = 12, near: int = 3,
                    screen: float = 0.15) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    ``docs`` has ``doc_id`` and ``text``; other columns are ignored. Words are
    ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z in lower case; shingles have ``words`` words, a
    shorter text is one shingle. Documents are linked when the intersection of their sets is at
    least ``percent`` of the union; a component is named by its least ``doc_id`` and that document
    is kept. Null and empty texts have no shingles, link with nothing and are kept. Repeated texts
    form one class; a null ``doc_id`` row is ignored. An empty table gives an empty table.

    At similarity 0.8 a pair shares ``least_depth`` = 3 values in a tree with probability 0.51, so
    16 trees miss it with 1e-5, in crowded regions as well. ``screen`` is the margin below ``percent`` at which the signature
    of 128 values drops a candidate: over four standard deviations.
    """
    spark = docs.sparkSession
    stage = Stage(spark, "forest")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(
        "doc_id is not null")
    count = trees * depth
    signed = stage.save(docs.mapInArrow(
        partial(_sign, words=words, count=count),
        "doc_id long, n_shingles long, set_hi long, set_lo long, signature binary, low binary"))
    firsts = signed.where("n_shingles > 0").groupBy("set_hi", "set_lo", "n_shingles").agg(
        F.min("doc_id").alias("doc_id"))
    classes = stage.save(signed.join(firsts.select("doc_id"), "doc_id", "left_semi")
                         .dropDuplicates(["set_hi", "set_lo", "n_shingles"]))
    pairs, crowd = candidates(classes, stage, trees, depth, least_depth, few, near)

    bytes_of = classes.select("doc_id", F.col("low").alias("s"))
    likely = stage.save(
        pairs.join(bytes_of.select(F.col("doc_id").alias("a"), F.col("s").alias("x")), "a")
        .join(bytes_of.select(F.col("doc_id").alias("b"), F.col("s").alias("y")), "b")
        .select("a", "b", "x", "y")
        .mapInArrow(partial(_alike, count=count, at_least=percent / 100 - screen),
                    "a long, b long"))

    # Texts of documents in candidate pairs are set apart. Their ids grow with the input, so the
    # join is a merge at any size. First every document meets its least candidate; what that has
    # not connected already is confirmed in a second pass.
    ends = likely.select(F.col("a").alias("doc_id")).union(likely.select("b")).distinct()
    texts = stage.save(docs.hint("merge").join(ends, "doc_id", "left_semi"))

    def confirmed(some: DataFrame) -> DataFrame:
        left = some.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("x")), "a")
        full = left.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("y")), "b")
        return full.select("a", "b", "x", "y").mapInArrow(
            partial(_confirm, words=words, percent=percent), "a long, b long")

    first = stage.save(likely.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"))
    links = stage.save(confirmed(first))
    # Where two steps along confirmed links lead to one document, the pair is connected already.
    step = links.select(F.col("b").alias("node"), F.col("a").alias("top"))
    beyond = step.select(F.col("node").alias("top"), F.col("top").alias("next"))
    tops = stage.save(step.join(beyond, "top", "left").select(
        "node", F.coalesce("next", "top").alias("top")))
    rest = likely.join(first, ["a", "b"], "left_anti")
    for side in ("a", "b"):
        rest = rest.join(tops.select(F.col("node").alias(side), F.col("top").alias(f"top_{side}")),
                         side, "left")
    rest = rest.where(F.coalesce("top_a", "a") != F.coalesce("top_b", "b")).select("a", "b")
    more = confirmed(rest)
    joined = stage.save(components(links.union(more), stage))
    joined = settle(crowd, classes, docs, joined, stage, count, depth, least_depth, words, percent,
                    screen)

    named = classes.join(joined, classes.doc_id == joined.node, "left").select(
        "set_hi", "set_lo", "n_shingles",
        F.coalesce("component", "doc_id").alias("component_id"))
    out = signed.select("doc_id", "n_shingles", "set_hi", "set_lo").join(
        named, ["set_hi", "set_lo", "n_shingles"], "left")
    return out.select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"),
        (F.coalesce("component_id", "doc_id") == F.col("doc_id")).alias("kept"))
