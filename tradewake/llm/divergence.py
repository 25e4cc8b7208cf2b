"""How sources of a language differ in their vocabulary.

A language keeps the terms that occur in enough of its documents. The kept terms are range-sorted
and each range becomes a minimal acyclic transducer, whose paths spell terms and add up to their
ordinals in the language. Every task combines the terms of its texts by language and source, deals
them out by the ranges, and each range streams them through its transducer to recount them. From
here on a term is its ordinal, which also breaks ties, as ordinals have the order of the terms.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewake.operators.sides import broadcast_if_small

from .common import Stage, in_batches, only, rows_of
from .running import running
from .transducer import Transducer

#: Terms are runs of letters: a-z, A-Z in lower case and everything beyond ASCII.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
_TERMS = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20
               for b in range(256))

SCALE = 1_000_000_000  #: what the shares of a group's terms sum to, about

#: Distinct terms that a task holds before it passes them on.
HELD = 500_000

#: Rows of a batch between Python and the JVM.
BATCH = 50_000


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in order; null counts as empty."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").translate(_TERMS).split()


_DOCUMENTS = pa.schema([("lang", pa.string()), ("term", pa.binary()), ("df", pa.int64())])


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many documents of a language a term occurs, combined in the task."""
    held: dict[str, Counter] = defaultdict(Counter)
    size = 0

    def passed():
        for lang, found in held.items():
            terms, counts = list(found), list(found.values())
            for at in range(0, len(terms), BATCH):
                part = pa.array(terms[at:at + BATCH], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(part), pa.string()), part,
                     pa.array(counts[at:at + BATCH], pa.int64())], schema=_DOCUMENTS)
        held.clear()

    for lang, text in rows_of(batches, "lang", "text"):
        found = held[lang]
        size -= len(found)
        found.update(set(terms_of(text)))
        size += len(found)
        if size >= HELD:
            yield from passed()
            size = 0
    yield from passed()


_RANGES = pa.schema([("lang", pa.string()), ("first", pa.binary()), ("base", pa.int64()),
                     ("machine", pa.binary())])


def _machines(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """A transducer for every run of at most ``most`` terms of one language; a partition has its
    terms in order, with their ordinals."""
    def rows():
        held: list[bytes] = []
        lang = base = None

        def done():
            return lang, held[0], base, Transducer.build(held).to_bytes()

        for of, term, ordinal in rows_of(batches, "lang", "term", "ordinal"):
            if held and (of != lang or len(held) >= most):
                yield done()
                held = []
            if not held:
                lang, base = of, ordinal
            held.append(term)
        if held:
            yield done()
    return in_batches(_RANGES, rows())


_TEXTS = pa.schema([("lang", pa.string()), ("range", pa.int64()),
                    ("sources", pa.list_(pa.string())), ("sizes", pa.list_(pa.int64())),
                    ("terms", pa.binary()), ("counts", pa.binary()), ("machine", pa.binary())])
_TEXTS_SQL = ("lang string, range long, sources array<string>, sizes array<long>, terms binary, "
              "counts binary, machine binary")


def _dealt(batches: Iterator[pa.RecordBatch], bounds: dict[str, tuple[list[bytes], list[int]]]
           ) -> Iterator[pa.RecordBatch]:
    """The terms of a task's texts, combined by language and source and dealt out by range: one row
    for each range, with a list of terms for each source.

    ``bounds`` has, for each language, the first terms of its ranges and the ranges' numbers.
    """
    def parted(held):
        parts: dict[int, list] = defaultdict(list)
        for (lang, source), found in held.items():
            firsts, numbers = bounds[lang]
            terms = sorted(found)
            low = bisect_left(terms, firsts[0])
            while low < len(terms):
                k = bisect_right(firsts, terms[low]) - 1
                high = bisect_left(terms, firsts[k + 1]) if k + 1 < len(firsts) else len(terms)
                own = terms[low:high]
                parts[numbers[k]].append((lang, source, len(own), b" ".join(own), np.array(
                    [found[t] for t in own], dtype="<i8").tobytes()))
                low = high
        for number, lists in parts.items():
            langs, sources, sizes, terms, counts = zip(*lists)
            yield (langs[0], number, list(sources), list(sizes), b" ".join(terms),
                   b"".join(counts), None)

    def rows():
        held: dict = defaultdict(Counter)
        size = 0
        for lang, source, text in rows_of(batches, "lang", "source", "text"):
            if lang not in bounds:
                continue
            found = held[lang, source]
            size -= len(found)
            found.update(terms_of(text))
            size += len(found)
            if size >= HELD:
                yield from parted(held)
                held.clear()
                size = 0
        yield from parted(held)
    return in_batches(_TEXTS, rows())


_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("ordinal", pa.int64()),
                     ("n", pa.int64())])


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of ``n`` by key."""
    if not len(keys):
        return keys, n
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1))
    return keys[first], np.add.reduceat(n, first)


def _recounted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Term lists through the transducer of their range, which comes before them.

    The lists of a batch go through together. What is counted is held by source and ordinal until
    the range ends, or until it is much.
    """
    machine, lang, base, size = None, None, 0, 1
    places: dict[str, int] = {}
    keys = n = np.zeros(0, dtype=np.int64)

    def passed():
        names = pa.array(list(places), pa.string())
        for at in range(0, len(keys), BATCH):
            source, ordinal = np.divmod(keys[at:at + BATCH], size)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(source), pa.string()), names.take(pa.array(source)),
                 pa.array(base + ordinal), pa.array(n[at:at + BATCH])], schema=_COUNTS)

    for batch in batches:
        rows = list(rows_of([batch], *_TEXTS.names))
        at = 0
        while at < len(rows):
            number, raw = rows[at][1], rows[at][6]
            if raw is not None:
                yield from passed()
                machine, lang, base = Transducer.from_bytes(raw), rows[at][0], number
                size = machine.size
                places, keys, n = {}, keys[:0], n[:0]
                at += 1
                continue
            stop = at + 1
            while stop < len(rows) and rows[stop][1] == number:
                stop += 1
            part = rows[at:stop]
            at = stop
            found = machine.ordinals(b" ".join(r[4] for r in part))
            source = np.repeat(
                [places.setdefault(s, len(places)) for r in part for s in r[2]],
                [k for r in part for k in r[3]])
            counts = np.frombuffer(b"".join(r[5] for r in part), dtype="<i8")
            known = found >= 0
            keys, n = _summed(np.concatenate((keys, source[known] * size + found[known])),
                              np.concatenate((n, counts[known])))
            if len(keys) >= 4 * HELD:
                yield from passed()
                keys, n = keys[:0], n[:0]
    yield from passed()


def vocabulary(docs: DataFrame, stage: Stage, least_docs: int) -> DataFrame:
    """``lang, term, ordinal`` of the terms in at least ``least_docs`` documents of a language;
    ordinals count from 0 in the order of the terms' bytes, over all languages."""
    seen = only(docs, "lang", "text").mapInArrow(
        _document_counts, "lang string, term binary, df long")
    kept = stage.save(seen.groupBy("lang", "term").agg(F.sum("df").alias("df"))
                      .where(F.col("df") >= least_docs)
                      .select("lang", "term", F.lit(1).cast("long").alias("one")))
    ordered = running(kept, ["lang", "term"], ["one"], stage)
    return stage.save(ordered.select("lang", "term", F.col("before_one").alias("ordinal")))


def term_counts(docs: DataFrame, terms: DataFrame, stage: Stage, per_range: int = 50_000
                ) -> DataFrame:
    """``lang, source, ordinal, n``: how often each term of the vocabulary ``terms`` occurs in the
    documents of a language and source; terms that don't occur there have no row.

    Ranges have at most ``per_range`` terms and are as many as partitions at least, so that they
    spread. The first terms of the ranges go to all tasks: one term for every ``per_range`` of the
    vocabulary, or for every partition.
    """
    n = terms.count()
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = max(1, min(per_range, -(-n // (2 * parts))))
    machines = stage.save(
        terms.repartitionByRange(max(1, min(parts, n // 1000), -(-n // per_range)), "ordinal")
        .sortWithinPartitions("ordinal").mapInArrow(
            partial(_machines, most=most),
            "lang string, first binary, base long, machine binary"))
    bounds: dict[str, tuple[list[bytes], list[int]]] = {}
    for lang, first, base in machines.select("lang", "first", "base").orderBy("base") \
            .toLocalIterator():
        firsts, numbers = bounds.setdefault(lang, ([], []))
        firsts.append(bytes(first))
        numbers.append(base)  # a range is known by its first ordinal
    dealt = only(docs, "lang", "source", "text").mapInArrow(
        partial(_dealt, bounds=bounds), _TEXTS_SQL)
    first = machines.select("lang", F.col("base").alias("range"), "machine")
    counted = dealt.unionByName(first, allowMissingColumns=True).repartition(parts, "range").sortWithinPartitions(
        "range", F.col("machine").isNull()).mapInArrow(
            _recounted, "lang string, source string, ordinal long, n long")
    return stage.save(counted.groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n")))


def _share(n: F.Column, total: F.Column, kept: F.Column) -> F.Column:
    """1 + floor(SCALE * (n + 1) / (total + kept)) without loss; decimals hold the product."""
    return 1 + F.call_function("div", (n + 1).cast("decimal(20,0)") * F.lit(SCALE).cast(
        "decimal(10,0)"), (total + kept).cast("decimal(20,0)"))


def _distance(p: F.Column, q: F.Column) -> F.Column:
    """floor((p - q)^2 / q) for shares, whose squares a long holds."""
    return F.call_function("div", (p - q) * (p - q), q)


_PAIRS = pa.schema([("lang", pa.string()), ("g", pa.int64()), ("h", pa.int64()),
                    ("value", pa.int64())])


def share(n: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (n + 1) / whole), three digits at a time: exact for totals under 9e15."""
    rest, out = np.divmod(n + 1, whole)[::-1]
    for _ in range(3):
        part, rest = np.divmod(rest * 1000, whole)
        out = out * 1000 + part
    return 1 + out


def _pair_sums(batches: Iterator[pa.RecordBatch], totals: dict[str, tuple[int, list[int]]]
               ) -> Iterator[pa.RecordBatch]:
    """Sums over a task's terms of the distance of every two sources of their language.

    A row is a term with the sources it occurs in. ``totals`` has, for each language, the number of
    its terms and what its sources' counts sum to.
    """
    def rows():
        sums: dict = {}
        size = 0

        def passed():
            for (lang, g), row in sums.items():
                yield from ((lang, g, h, v) for h, v in enumerate(row.tolist()) if h != g)
            sums.clear()

        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            lists = batch.column("found")
            # Which row an entry belongs to, whatever part of its buffers the batch is.
            of = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
            groups, counts = (lists.flatten().field(k).to_numpy() for k in (0, 1))
            for lang in sorted(set(langs)):
                kept, n = totals[lang]
                whole = np.array(n, dtype=np.int64) + kept
                rest = share(np.zeros(len(n), dtype=np.int64), whole)
                own = np.flatnonzero(langs == lang)
                step = max(1, (1 << 20) // len(n))
                for at in range(0, len(own), step):
                    rows = own[at:at + step]
                    place = np.full(batch.num_rows, -1)
                    place[rows] = np.arange(len(rows))
                    here = place[of] >= 0
                    g = groups[here]
                    p = np.tile(rest, (len(rows), 1))
                    p[place[of[here]], g] = share(counts[here], whole[g])
                    for g in range(len(n)):
                        if (lang, g) not in sums:
                            sums[lang, g] = np.zeros(len(n), dtype=np.int64)
                            size += len(n)
                        gap = p[:, g:g + 1] - p
                        sums[lang, g] += (gap * gap // p).sum(axis=0)
                        if size >= 1 << 22:
                            yield from passed()
                            size = 0
        yield from passed()
    return in_batches(_PAIRS, rows())


def audit(docs: DataFrame, least_docs: int = 3, top: int = 200, per_range: int = 50_000
          ) -> DataFrame:
    """``lang, source, part, item, value, rank`` for every language and source of ``docs``.

    Part ``pair`` ranks the other sources of the language by the chi-square like distance of the
    group's shares to theirs, summed over all terms the language keeps. Part ``term`` ranks the
    terms that the group has more of than its language, the ``top`` of them. Ties go by the bytes
    of the item. Null ``text``, ``lang`` and ``source`` count as empty; groups without terms have
    shares all the same, and pairs of a language that keeps no term are 0 apart. Repeated rows
    are documents of their own. An empty table gives an empty table; other columns are ignored.

    The groups' totals go to all tasks. Their number is the root of that of the rows of part
    ``pair``.
    """
    stage = Stage(docs.sparkSession, "divergence")
    blank = only(docs, "text", "lang", "source").select(*(
        F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")))
    terms = vocabulary(blank, stage, least_docs)
    counts = term_counts(blank, terms, stage, per_range)

    kept = terms.groupBy("lang").agg(F.count("*").alias("kept"))
    total = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    place = Window.partitionBy("lang").orderBy("source")
    groups = stage.save(
        blank.select("lang", "source").distinct().join(total, ["lang", "source"], "left")
        .join(kept, "lang", "left").select(
            "lang", "source", F.coalesce("total", F.lit(0)).alias("total"),
            F.coalesce("kept", F.lit(0)).alias("kept"),
            (F.row_number().over(place) - 1).cast("long").alias("g")))
    known = broadcast_if_small(groups)

    totals: dict[str, tuple[int, list[int]]] = {}
    for row in groups.where("kept > 0").orderBy("lang", "g").toLocalIterator():
        totals.setdefault(row.lang, (row.kept, []))[1].append(row.total)
    placed = counts.join(known.select("lang", "source", "g"), ["lang", "source"])
    by_term = placed.groupBy("lang", "ordinal").agg(
        F.collect_list(F.struct("g", "n")).alias("found"))
    sums = by_term.mapInArrow(partial(_pair_sums, totals=totals),
                              "lang string, g long, h long, value long") \
        .groupBy("lang", "g", "h").agg(F.sum("value").alias("value"))
    one, other = groups.alias("a"), groups.alias("b")
    both = one.join(other, (F.col("a.lang") == F.col("b.lang")) & (F.col("a.g") != F.col("b.g"))) \
        .select("a.lang", "a.source", "a.g", F.col("b.source").alias("item"),
                F.col("b.g").alias("h"))
    pairs = both.join(sums, ["lang", "g", "h"], "left").select(
        "lang", "source", "item", F.coalesce("value", F.lit(0)).alias("value")).withColumn(
            "rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(
                F.desc("value"), "item")))

    in_lang = counts.groupBy("lang", "ordinal").agg(F.sum("n").alias("lang_n"))
    whole = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    shares = counts.join(in_lang, ["lang", "ordinal"]) \
        .join(known, ["lang", "source"]).join(broadcast_if_small(whole), "lang") \
        .withColumn("p", _share(F.col("n"), F.col("total"), F.col("kept"))) \
        .withColumn("q", _share(F.col("lang_n"), F.col("lang_total"), F.col("kept"))) \
        .where("p > q") \
        .withColumn("value", _distance(F.col("p"), F.col("q")))
    best = shares.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal"))) \
        .where(F.col("rank") <= top)
    named = best.join(terms.select("ordinal", F.col("term").cast("string").alias("item")), "ordinal")
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(*columns).unionByName(
        named.withColumn("part", F.lit("term")).select(*columns))


def oracle(least_docs: int = 3, top: int = 200) -> str:
    """DuckDB SQL for the rows of :func:`audit`."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

    def share(n, total):
        return (f"1 + (CAST({n} AS HUGEINT) + 1) * {SCALE} // (CAST({total} AS HUGEINT) + v)")

    return f"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '{TERM}') AS terms
  FROM documents),
o AS (SELECT row, lang, source, unnest(terms) AS term FROM d),
k AS (SELECT lang, term FROM o GROUP BY lang, term HAVING count(DISTINCT row) >= {least_docs}),
c AS (SELECT lang, source, term, count(*) AS n FROM o JOIN k USING (lang, term) GROUP BY ALL),
g AS (
  SELECT lang, source, coalesce(total, 0) AS total, coalesce(v, 0) AS v
  FROM (SELECT DISTINCT lang, source FROM d)
  LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL) USING (lang, source)
  LEFT JOIN (SELECT lang, count(*) AS v FROM k GROUP BY lang) USING (lang)),
s AS (
  SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n, {share('coalesce(n, 0)', 'total')} AS p
  FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM s a JOIN s b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
l AS (
  SELECT lang, term, {share('n', 'total')} AS q
  FROM (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL)
  JOIN (SELECT lang, sum(total) AS total, any_value(v) AS v FROM g GROUP BY lang) USING (lang)),
every AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q
  FROM s JOIN l USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (
        PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM every)
WHERE part = 'pair' OR rank <= {top}"""
