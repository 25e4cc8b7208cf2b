"""Repeated runs of lines, by a suffix array over line ids.

Every document is a sequence of line ids. Distributed prefix doubling sorts the suffixes: after
round k, suffixes that agree on 2**k lines share a rank, and ranks follow the sort order of those
lines. Suffixes that have become unique leave, so a round handles only what still repeats. The
ranks of all rounds are the levels of the tree of longest-common-prefix intervals. A descent over
them gives every position the deepest interval that also holds an earlier position: the longest
run from there that has been seen before. Runs that are long enough are deleted, so the first copy
of a passage stays, wherever the later ones are and however often they overlap.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stage, free_name, in_batches, rows_of

_NULL_ID = -(1 << 63)
_BLANK = re.compile(r"[ \t\r\x0b\x0c]*\Z")
_NUMBERED = pa.schema([("at", pa.int64()), ("d", pa.int64()), ("t", pa.int64()),
                       ("p", pa.int32()), ("h", pa.int64()), ("g", pa.int64())])


def _keyed(docs: DataFrame) -> DataFrame:
    """Documents with their key: the id, and a hash of the text for ids that occur twice."""
    return docs.withColumn("__d", F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID))) \
        .withColumn("__t", F.xxhash64("text"))


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers in document order that are consecutive only for consecutive lines."""
    part = TaskContext.get().partitionId()

    def rows():
        at, last = part << 40, (None, None, -2)
        for d, t, p, h, g in rows_of(batches, "d", "t", "p", "h", "g"):
            at += 1 if last == (d, t, p - 1) else 2
            last = (d, t, p)
            yield at, d, t, p, h, g
    return in_batches(_NUMBERED, rows(), most=65536)


def _ranked(classes: DataFrame, *keys: str) -> DataFrame:
    """Classes with a rank in the order of their keys; the keys are distinct, so it is even."""
    return classes.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(
        "rank", F.monotonically_increasing_id())


def levels(docs: DataFrame, stage: Stage) -> tuple[DataFrame, list[DataFrame]]:
    """Positions of repeated lines, and for every k the ranks of repeated runs of 2**k lines.

    The first table has ``at, d, t, p``: a number that is consecutive for consecutive lines, the
    document's key and the line's index among its lines that aren't blank. Each level has ``at,
    rank``.
    """
    text = F.transform(F.split("text", "\n"), lambda x: F.rtrim(F.regexp_replace(
        x, r"[ \t\r\x0b\x0c]+$", "")))
    lines = _keyed(docs).select("__d", "__t", F.posexplode(F.filter(text, lambda x: x != "")))
    # Two hashes with different seeds make a line id of 128 bits.
    hashed = lines.select(F.col("__d").alias("d"), F.col("__t").alias("t"), F.col("pos").alias("p"),
                          F.xxhash64("col").alias("h"), F.xxhash64(F.lit(1), "col").alias("g"))
    repeated = hashed.groupBy("h", "g").agg(F.count("*").alias("n")).where("n > 1").select("h", "g")
    # A row that repeats the id and the text of another is the same document.
    at = stage.save(
        hashed.join(repeated, ["h", "g"]).dropDuplicates(["d", "t", "p"])
        .repartitionByRange("d", "t").sortWithinPartitions("d", "t", "p")
        .select("d", "t", "p", "h", "g")
        .mapInArrow(_number, "at long, d long, t long, p int, h long, g long"))
    classes = stage.save(_ranked(
        at.groupBy("h", "g").agg(F.count("*").alias("n")).where("n > 1").select("h", "g"), "h", "g"))
    found = [stage.save(at.join(classes, ["h", "g"]).select("at", "rank"))]
    while True:
        step = 1 << (len(found) - 1)
        one = found[-1]
        two = one.select((F.col("at") - step).alias("at"), F.col("rank").alias("next"))
        both = stage.save(one.join(two, "at"))
        classes = stage.save(_ranked(
            both.groupBy("rank", "next").agg(F.count("*").alias("n")).where("n > 1")
            .select(F.col("rank").alias("r"), F.col("next").alias("s")), "r", "s"))
        more = stage.save(both.select("at", F.col("rank").alias("r"), F.col("next").alias("s"))
                          .join(classes, ["r", "s"]).select("at", "rank"))
        stage.drop(both, classes)
        if more.isEmpty():
            return at, found
        found.append(more)


def earlier_copies(at: DataFrame, found: list[DataFrame], stage: Stage) -> DataFrame:
    """``at, length``: the longest run from each position that occurs at an earlier one too.

    A state is an interval, named by its first position ``m`` and its depth ``length``. From the
    longest level down, a position goes to the deeper interval if that one holds an earlier
    position. The first position of a deeper interval stays where it is, since nothing comes before
    it there, and leaves a mark in the deeper one for those to come; there is one mark an interval.
    """
    state = stage.save(found[0].select("at", F.lit(0).cast("long").alias("m"),
                                       F.lit(0).alias("length"), F.lit(False).alias("mark")))
    for k in range(len(found) - 1, -1, -1):
        level = found[k].select(F.col("at").alias("there"), "rank")
        tried = state.withColumn("there", F.col("at") + F.col("length")).join(level, "there")
        least = tried.groupBy("m", "length", "rank").agg(
            F.min("at").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
        least = stage.save(least)
        deeper = tried.where("not mark").join(least, ["m", "length", "rank"]) \
            .where("first < at").select(
                "at", F.col("first").alias("new_m"), (F.col("length") + (1 << k)).alias("new_length"))
        real = state.where("not mark").join(deeper, "at", "left").select(
            "at", F.coalesce("new_m", "m").alias("m"),
            F.coalesce("new_length", "length").alias("length"), "mark")
        marks = state.where("mark").union(least.select(
            F.col("first").alias("at"), F.col("first").alias("m"),
            (F.col("length") + (1 << k)).alias("length"), F.lit(True).alias("mark")))
        after = stage.save(real.union(marks))
        stage.drop(state, least)
        state = after
    return state.where("length > 0 and not mark").select("at", "length")


def repeated_runs(docs: DataFrame, stage: Stage) -> DataFrame:
    """``d, t, runs``: per document, all ``(line, length)`` runs that occur earlier."""
    at, found = levels(docs, stage)
    runs = earlier_copies(at, found, stage)
    return at.join(runs, "at").groupBy("d", "t").agg(
        F.collect_list(F.struct("p", "length")).alias("runs"))


def delete_runs(text: str, runs: list[tuple[int, int]], min_lines: int, min_words: int
                ) -> tuple[str, int, int]:
    """The text without the runs that are long enough, lines deleted and lines left."""
    lines = text.split("\n")
    solid = [i for i, x in enumerate(lines) if not _BLANK.match(x)]
    sums = [0]
    for i in solid:
        sums.append(sums[-1] + len(lines[i].split()))
    gone: set[int] = set()
    end = 0
    for p, n in sorted(runs):
        if p + n > end:  # not inside the run before it
            end = p + n
            if n >= min_lines and sums[p + n] - sums[p] >= min_words:
                gone.update(range(p, p + n))
    if not gone:
        return text, 0, len(solid)
    kept, drop, k = [], False, -1
    for i, line in enumerate(lines):
        if k + 1 < len(solid) and solid[k + 1] == i:
            k += 1
            drop = k in gone
        if not drop:
            kept.append(line)  # a blank line goes with the line before it
    return "\n".join(kept), len(gone), len(solid) - len(gone)




def _clean(batches: Iterator[pa.RecordBatch], min_lines: int, min_words: int
           ) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, deleted, left = [], [], []
        for text, runs in zip(batch.column("text").to_pylist(),
                              batch.column("__runs").to_pylist()):
            if text is None or not runs:
                new = (text, 0, 0 if text is None else 1)
            else:
                new = delete_runs(text, [(r["p"], r["length"]) for r in runs],
                                  min_lines, min_words)
            for out, x in zip((texts, deleted, left), new):
                out.append(x)
        names = [n for n in batch.schema.names if n != "__runs"]
        columns = [pa.array(texts, pa.string()) if n == "text" else batch.column(n) for n in names]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(deleted, pa.int32()), pa.array(left, pa.int32())],
            names=[*names, "__deleted", "__left"])


def dedup_lines(docs: DataFrame, min_lines: int = 1, min_words: int = 8) -> DataFrame:
    """All documents, ``text`` without later copies of repeated line runs.

    Returns the columns of ``docs`` and ``__deleted``, ``__left`` (with one more underscore for a
    column of ``docs`` that has the name): the lines deleted and those not
    deleted that aren't blank (1 for a text without repeated runs, which isn't counted). A run is
    deleted if it occurs at an earlier place, in order of ``doc_id`` and line, and has at least
    ``min_lines`` lines and ``min_words`` words. Lines are compared without trailing white space;
    blank ones don't count and are deleted with the line before them.

    Null and empty texts stay as they are. Rows that repeat the id and the text of another count as
    one document and are treated alike; rows without an id come first. An empty table gives an
    empty table.
    """
    stage = Stage(docs.sparkSession, "lines")
    runs = stage.save(repeated_runs(docs.select("doc_id", "text"), stage))
    # The other columns go by number, so that no name of theirs can clash.
    names = [c if c in ("doc_id", "text") else f"c{i}" for i, c in enumerate(docs.columns)]
    joined = _keyed(docs.toDF(*names)).join(
        runs.select(F.col("d").alias("__d"), F.col("t").alias("__t"), F.col("runs").alias("__runs")),
        ["__d", "__t"], "left").select(*names, "__runs")
    fields = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, docs.schema))
    out = joined.mapInArrow(partial(_clean, min_lines=min_lines, min_words=min_words),
                            f"{fields}, __deleted int, __left int")
    return out.toDF(*docs.columns, free_name(docs, "__deleted"), free_name(docs, "__left"))
