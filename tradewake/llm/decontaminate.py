"""Benchmark passages in documents, by CGK embedding, bit sampling and exact edit distance.

Texts are sequences of lower-case words. The CGK embedding is a random walk over a sequence: at
every step it puts out the word it stands on, and a random bit of that word and step tells whether
it goes on to the next. Two sequences a few edits apart fall back into step, so that their
embeddings differ at few places: edit distance becomes Hamming distance. Bit sampling takes a few
places of the embedding as a key; several walks and samples make a miss unlikely. The longer a walk
under many edits, the less likely it falls back into step, so an item of many words is embedded in
parts: of the parts of an item within the tolerance, at least one is within the tolerance itself.
Every window of a document that can match a part of its size is hashed like the parts, windows and
items with a common key are candidates, and an exact edit distance to the whole item decides.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stage, free_name, in_batches, mix, rows_of, word_hashes
from .running import running

_BETWEEN = np.ones(256, dtype=bool)
_BETWEEN[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


@dataclass(frozen=True)
class Plan:
    """``tolerance``: edits per item word. ``walks`` times ``samples`` keys of ``places`` words each.

    Items over ``part_words`` words are embedded in parts of that many at most. ``filter_words``
    bounds the item words and keys that are sent to every task at once (and one item more): a larger
    benchmark is taken in blocks, each of which reads the documents once.
    """

    tolerance: float = 0.2
    walks: int = 12
    samples: int = 4
    places: int = 3
    growth: float = 1.25
    part_words: int = 40
    filter_words: int = 2_000_000

    def edits(self, words: int) -> int:
        return int(self.tolerance * words + 1e-9)

    def size_class(self, words: int) -> int:
        return int(math.log(words, self.growth) + 1e-9)

    def least(self, size: int) -> int:
        """Least number of words of a class."""
        n = max(1, math.floor(self.growth ** size))
        while self.size_class(n) < size:
            n += 1
        return n

    def most(self, size: int) -> int:
        return max(self.least(size), self.least(size + 1) - 1)


def words_of(text: str | None) -> np.ndarray:
    """Hashes of the words of a text: letters, digits and all beyond ASCII, in lower case."""
    return word_hashes((text or "").lower().encode("utf-8", "surrogatepass"), _BETWEEN)


def pairs_of(words: np.ndarray) -> np.ndarray:
    """Hashes of the pairs of neighbouring words."""
    return mix(words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:])


class Screen:
    """What a window must have to be within the tolerance of some item of its size.

    ``n`` edits leave all but ``n`` of an item's words and all but ``2 * n`` of its word pairs in the
    matching stretch. So a window with too many foreign words or too few pairs of items can't match;
    no window that can is left out. Hash tables with false hits only let more windows pass.
    """

    def __init__(self, words: np.ndarray, pairs: np.ndarray):
        self.words, self.pairs = np.zeros(1 << 22, dtype=bool), np.zeros(1 << 24, dtype=bool)
        self.words[words & np.uint64(len(self.words) - 1)] = True
        self.pairs[pairs & np.uint64(len(self.pairs) - 1)] = True

    def sums(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Foreign words and pairs of items before each place."""
        foreign = ~self.words[words & np.uint64(len(self.words) - 1)]
        known = self.pairs[pairs_of(words) & np.uint64(len(self.pairs) - 1)]
        return (np.concatenate(([0], np.cumsum(foreign))), np.concatenate(([0], np.cumsum(known))))

    @staticmethod
    def passing(sums, n: int, starts: np.ndarray, size: int, plan: Plan) -> np.ndarray:
        foreign, known = sums
        least, most = plan.least(size), plan.most(size)
        edits = plan.edits(most)
        ends = np.minimum(starts + least, n)
        over = foreign[ends] - foreign[starts] + (starts + least - ends)  # beyond the end is foreign
        need = min(w - 1 - 2 * plan.edits(w) for w in range(least, most + 1))
        last = np.minimum(starts + most + edits, n) - 1
        pairs = known[np.maximum(last, starts)] - known[starts]
        return starts[(over <= edits) & (pairs >= need)]


@lru_cache(maxsize=256)
def _walks(size: int, plan: Plan) -> tuple[int, list]:
    """Steps of a class, and per walk the bits of the steps and which samples look at a step."""
    steps = max(plan.places, math.ceil(1.6 * plan.least(size)))
    walks = []
    for walk in range(plan.walks):
        rng = np.random.default_rng([size, walk])
        bits = rng.integers(1, 2**63, steps, dtype=np.uint64) | np.uint64(1)
        looks: list[list[int]] = [[] for _ in range(steps)]
        for sample in range(plan.samples):
            for place in rng.choice(steps, min(plan.places, steps), replace=False):
                looks[place].append(sample)
        last = max(i for i, x in enumerate(looks) if x)
        walks.append((bits, looks[:last + 1]))
    return steps, walks


def embedded_keys(words: np.ndarray, starts: np.ndarray, size: int, plan: Plan) -> np.ndarray:
    """Keys of the windows of size class ``size`` at ``starts``: walks * samples columns.

    A sequence in ``words`` is followed by as many zeros as a walk of the class has steps.
    """
    _, walks = _walks(size, plan)
    keys = np.empty((plan.walks * plan.samples, len(starts)), dtype=np.uint64)
    for walk, (bits, looks) in enumerate(walks):
        first = walk * plan.samples
        for sample in range(plan.samples):
            keys[first + sample] = (size << 20) + first + sample + 1
        at = starts.copy()
        for step, samples in enumerate(looks):
            word = words[at]
            for sample in samples:
                keys[first + sample] = mix(keys[first + sample] * np.uint64(0x9E3779B97F4A7C15)
                                           + word)
            at += ((word * bits[step]) >> np.uint64(63)).astype(np.int64)
    return keys.T


_PART = pa.struct([("size", pa.int32()), ("before", pa.int32()), ("after", pa.int32()),
                   ("keys", pa.list_(pa.int64()))])
_ITEMS = pa.schema([("k", pa.int64()), ("item_id", pa.int64()), ("words", pa.binary()),
                    ("n_words", pa.int32()), ("weight", pa.int64()), ("parts", pa.list_(_PART))])
_ITEM = ("k long, item_id long, words binary, n_words int, weight long, "
         "parts array<struct<size int, before int, after int, keys array<long>>>")


def parts_of(words: np.ndarray, plan: Plan) -> list[dict]:
    """Parts of an item of nearly equal length: size class, keys, and how many words of a document
    before and after a part the rest of the item can take up."""
    n = len(words)
    edges = np.linspace(0, n, math.ceil(n / plan.part_words) + 1).astype(int).tolist()
    out = []
    for lo, hi in zip(edges, edges[1:]):
        size = plan.size_class(hi - lo)
        padded = np.concatenate([words[lo:hi], np.zeros(_walks(size, plan)[0], dtype=np.uint64)])
        keys = embedded_keys(padded, np.zeros(1, dtype=np.int64), size, plan)[0]
        out.append({"size": size, "before": lo + plan.edits(n) if lo else 0,
                    "after": n - hi + plan.edits(n) if hi < n else 0,
                    "keys": np.unique(keys).view(np.int64).tolist()})
    return out


def _items(batches: Iterator[pa.RecordBatch], plan: Plan) -> Iterator[pa.RecordBatch]:
    def rows():
        for k, item_id, text in rows_of(batches, "k", "item_id", "text"):
            words = words_of(text)
            if len(words):
                parts = parts_of(words, plan)
                weight = max(len(words), sum(len(p["keys"]) for p in parts))
                yield k, item_id, words.tobytes(), len(words), weight, parts
    return in_batches(_ITEMS, rows(), most=256)


class Index:
    """What the tasks need of a block of items: their words and pairs, size classes, sorted keys,
    and the largest room before and after that an item with a key can take up."""

    def __init__(self, items: list[tuple[bytes, list]]):
        words = [np.frombuffer(w, dtype=np.uint64) for w, _ in items]
        parts = [p for _, ps in items for p in ps]
        none = [np.zeros(0, np.uint64)]
        self.words = np.unique(np.concatenate(words or none))
        self.pairs = np.unique(np.concatenate([pairs_of(w) for w in words] or none))
        self.sizes = sorted({p["size"] for p in parts})
        counts = [len(p["keys"]) for p in parts]
        keys = np.array([k for p in parts for k in p["keys"]], dtype=np.int64).view(np.uint64)
        self.keys, place = np.unique(keys, return_inverse=True)
        self.before, self.after = (np.zeros(len(self.keys), dtype=np.int64) for _ in range(2))
        np.maximum.at(self.before, place, np.repeat([p["before"] for p in parts], counts))
        np.maximum.at(self.after, place, np.repeat([p["after"] for p in parts], counts))


_WINDOWS = pa.schema([("doc_id", pa.int64()), ("t", pa.int64()), ("start", pa.int32()),
                      ("before", pa.int32()), ("window", pa.binary()),
                      ("keys", pa.list_(pa.int64()))])
_WINDOW = "doc_id long, t long, start int, before int, window binary, keys array<long>"
_SPAN = 8192  # window starts of one row at most


def _windows(batches: Iterator[pa.RecordBatch], plan: Plan, known) -> Iterator[pa.RecordBatch]:
    """Windows that share a key with some part, with room for the whole item around."""
    index: Index = known.value
    screen = Screen(index.words, index.pairs)
    pad = np.zeros(max(_walks(s, plan)[0] for s in index.sizes) + 1, dtype=np.uint64)

    def rows():
        for batch in batches:
            docs = batch.column("doc_id").to_pylist()
            hashes = batch.column("t").to_pylist()
            words = [words_of(t) for t in batch.column("text").to_pylist()]
            sums = [screen.sums(w) if len(w) else None for w in words]
            # All texts of the batch in one array, each followed by room for a walk.
            ends = np.cumsum([len(w) + len(pad) for w in words])
            all_words = np.concatenate([x for w in words for x in (w, pad)] or [pad])
            for size in index.sizes:
                edits = plan.edits(plan.most(size))
                found = []
                for k, w in enumerate(words):
                    n = len(w)
                    starts = np.arange(min(n, max(0, n - plan.least(size) + edits + 1)))
                    if n:
                        starts = screen.passing(sums[k], n, starts, size, plan)
                    found.append(starts + (int(ends[k]) - n - len(pad)))
                starts = np.concatenate(found) if found else np.zeros(0, dtype=np.int64)
                for at in range(0, len(starts), 16384):
                    yield from hits(size, edits, starts[at:at + 16384], docs, hashes, words, ends,
                                    all_words)

    def hits(size, edits, starts, docs, hashes, words, ends, all_words):
        keys = embedded_keys(all_words, starts, size, plan)
        place = np.minimum(np.searchsorted(index.keys, keys), len(index.keys) - 1)
        hit = index.keys[place] == keys
        some = np.flatnonzero(hit.any(axis=1))
        if not len(some):
            return
        at, hit, place, keys = starts[some], hit[some], place[some], keys[some]
        before = np.where(hit, index.before[place], 0).max(axis=1)
        after = np.where(hit, index.after[place], 0).max(axis=1)
        # Hits of one document that are close, or whose items reach each other, go on as one window
        # that covers them all; a very long one is cut into overlapping windows.
        doc = np.searchsorted(ends, at, side="right")
        cut = (np.diff(doc) > 0) | (np.diff(at) > edits + 1 + np.maximum(after[:-1], before[1:]))
        first = np.concatenate(([0], np.flatnonzero(cut) + 1))
        span = (at - np.repeat(at[first], np.diff(np.append(first, len(at))))) // _SPAN
        cuts = np.flatnonzero(cut | (np.diff(span) != 0)) + 1
        for run in np.split(np.arange(len(at)), cuts):
            d = int(doc[run[0]])
            origin = int(ends[d]) - len(words[d]) - len(pad)
            start = int(at[run[0]]) - origin
            lo = max(0, int((at[run] - before[run]).min()) - origin - edits - 1)
            hi = int((at[run] + after[run]).max()) - origin + plan.most(size) + edits + 1
            yield (docs[d], hashes[d], start, start - lo, words[d][lo:hi].tobytes(),
                   np.unique(keys[run][hit[run]]).view(np.int64).tolist())
    return in_batches(_WINDOWS, rows(), most=2048)


def best_match(item: np.ndarray, words: np.ndarray) -> tuple[int, int, int]:
    """Least edits between the item and any stretch of words, and the stretch."""
    n = len(words)
    index = np.arange(n + 1)
    row, origin = np.zeros(n + 1, dtype=np.int64), index.copy()
    for i, word in enumerate(item, 1):
        step = np.empty(n + 1, dtype=np.int64)
        source = np.empty(n + 1, dtype=np.int64)
        step[0], source[0] = i, 0
        match = row[:-1] + (words != word)
        drop = row[1:] + 1
        step[1:] = np.minimum(match, drop)
        source[1:] = np.where(match <= drop, origin[:-1], origin[1:])
        # Extra words of the document: a running minimum of cost minus place.
        cost = step - index
        low = np.minimum.accumulate(cost)
        first = np.maximum.accumulate(np.where(cost == low, index, 0))
        row, origin = low + index, source[first]
    end = int(np.argmin(row))
    return int(row[end]), int(origin[end]), end


_MATCHES = pa.schema([("doc_id", pa.int64()), ("t", pa.int64()), ("item_id", pa.int64()),
                      ("n_words", pa.int32()), ("n_edits", pa.int32()),
                      ("start", pa.int32()), ("end", pa.int32())])
_MATCH = ("doc_id long, t long, item_id long, n_words int, n_edits int, start int, end int")


def _verify(batches: Iterator[pa.RecordBatch], plan: Plan) -> Iterator[pa.RecordBatch]:
    def rows():
        for doc_id, t, start, before, window, item_id, words in rows_of(
                batches, "doc_id", "t", "start", "before", "window", "item_id", "words"):
            item = np.frombuffer(words, dtype=np.uint64)
            place = np.frombuffer(window, dtype=np.uint64)
            # Every word of the item that the window doesn't have is an edit.
            if np.count_nonzero(~np.isin(item, place)) > plan.edits(len(item)):
                continue
            edits, a, b = best_match(item, place)
            if edits <= plan.edits(len(item)):
                first = start - before
                yield doc_id, t, item_id, len(item), edits, first + a, first + b
    return in_batches(_MATCHES, rows())


def contaminated(docs: DataFrame, benchmark: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """One row per document and item found in it.

    ``docs`` has ``doc_id, text``, ``benchmark`` has ``item_id, text``; other columns are ignored. A
    document holds an item if some stretch of its words is at most ``tolerance`` times the item's
    words away in insertions, deletions and substitutions of words. Returns ``doc_id, t, item_id,
    n_words, n_edits, start, end``: the item's words, the least edits, and the stretch in words of
    the document; ``t`` is a hash of the text for ids that occur twice.

    Null and empty texts and texts without a letter or digit neither hold nor are an item; repeated
    documents have one row each pair of id and text, repeated items one row each pair of id and
    number of words; null ids stay null. Empty tables give an empty table. Pairs at the tolerance
    are found with 0.9 and more, whatever the kind of the edits and the length of the item; closer
    ones are found nearly always.
    """
    spark = docs.sparkSession
    stage = Stage(spark, "leaks")
    items = stage.save(
        benchmark.select(F.monotonically_increasing_id().alias("k"),
                         F.col("item_id").cast("long").alias("item_id"), "text")
        .mapInArrow(partial(_items, plan=plan), _ITEM))
    total = items.agg(F.sum("weight")).first()[0] or 0
    most = max(1, plan.filter_words)
    items = (items.withColumn("before_weight", F.lit(0)) if total <= most
             else running(items, ["k"], ["weight"], stage))
    items = items.withColumn("block", F.floor(F.col("before_weight") / most))
    blocks = [r.block for r in items.select("block").distinct().collect()]  # total / most at most
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.xxhash64("text").alias("t"), "text")
    found = [_found(texts, items.where(F.col("block") == b), plan, stage) for b in sorted(blocks)]
    if not found:
        return spark.createDataFrame([], _MATCH)
    best = F.min(F.struct("n_edits", "start", "end"))
    return reduce(DataFrame.union, found).groupBy("doc_id", "t", "item_id", "n_words").agg(
        best.alias("b")).select("doc_id", "t", "item_id", "n_words", "b.n_edits", "b.start",
                                "b.end")


def _found(texts: DataFrame, items: DataFrame, plan: Plan, stage: Stage) -> DataFrame:
    """Verified matches of a block of items; its numbers are at most ``filter_words`` and one item."""
    held = items.select("words", "parts").collect()
    known = texts.sparkSession.sparkContext.broadcast(Index([(r.words, r.parts) for r in held]))
    windows = stage.save(texts.mapInArrow(partial(_windows, plan=plan, known=known), _WINDOW))
    known.destroy()
    item_keys = items.select("k", F.explode("parts.keys").alias("keys")).select(
        "k", F.explode("keys").alias("key"))
    pairs = windows.select("doc_id", "t", "start", F.explode("keys").alias("key")).join(
        item_keys, "key").select("doc_id", "t", "start", "k").distinct()
    full = pairs.join(windows.drop("keys").dropDuplicates(["doc_id", "t", "start", "before", "window"])
                      .withColumnsRenamed({"doc_id": "d", "t": "u", "start": "s"}),
                      F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("t") == F.col("u"))
                      & (F.col("start") == F.col("s"))).join(
        items.select("k", "item_id", "words"), "k")
    return full.select("doc_id", "t", "start", "before", "window", "item_id", "words").mapInArrow(
        partial(_verify, plan=plan), _MATCH)


def clean_documents(docs: DataFrame, benchmark: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """``docs`` without the documents that hold an item of the benchmark."""
    found = contaminated(docs, benchmark, plan).select(
        F.col("doc_id").alias(d := free_name(docs, "__d")),
        F.col("t").alias(t := free_name(docs, "__t"))).distinct()
    return docs.join(found, F.col("doc_id").cast("long").eqNullSafe(F.col(d))
                     & (F.xxhash64("text") == F.col(t)), "left_anti")
