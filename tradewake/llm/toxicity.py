"""Toxicity by compression distance: a toxic and an ordinary zstandard dictionary.

Both dictionaries begin with the same ordinary text, chosen by zstandard's trainer. The toxic one
goes on with segments of toxic text: stretches of words that many toxic and hardly any ordinary
training documents hold, checked once more by what they gain on ordinary windows. The ordinary one
goes on with as many zero bytes, so that distances in both agree. A window of a few words is
compressed with either; the bytes that the toxic dictionary saves are its margin. A logistic curve,
calibrated on training documents that the dictionaries haven't seen, turns a document's margins into
a score.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_batches, rows_of

WINDOW = 12         # words
SEGMENT = (4, 5, 6)  # bytes of the stretches that are counted
_PARAMETERS = dict(
    window_log=17, chain_log=16, hash_log=15, search_log=6, min_match=5, target_length=64,
    strategy=zstandard.STRATEGY_BTOPT, write_content_size=False, write_checksum=False,
    write_dict_id=False, format=zstandard.FORMAT_ZSTD1_MAGICLESS)


@dataclass(frozen=True)
class Model:
    """What the tasks need: two dictionaries of some 70 KB and four weights."""

    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]


def windows(text: str | None) -> list[bytes]:
    """The whole text in lower case, ``WINDOW`` words at a time with spaces between and around."""
    words = (text or "").lower().encode("utf-8", "surrogatepass").split()
    return [b" " + b" ".join(words[i:i + WINDOW]) + b" " for i in range(0, len(words), WINDOW)]


class Margins:
    def __init__(self, ordinary: bytes, toxic: bytes):
        parameters = zstandard.ZstdCompressionParameters(**_PARAMETERS)

        def compressor(content: bytes):
            d = zstandard.ZstdCompressionDict(content or b"\0" * 8,
                                              dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=parameters)
            return zstandard.ZstdCompressor(dict_data=d, compression_params=parameters)
        self.ordinary, self.toxic = compressor(ordinary).compress, compressor(toxic).compress

    def __call__(self, parts: list[bytes]) -> np.ndarray:
        return np.array([len(self.ordinary(p)) - len(self.toxic(p)) for p in parts], dtype=np.int64)


def features(margins: np.ndarray) -> list[float]:
    """Largest margin, windows with a clear one, windows, and a constant."""
    if not len(margins):
        return [0.0, 0.0, 0.0, 1.0]
    return [float(max(0, margins.max())), math.log1p(int((margins >= 2).sum())),
            math.log1p(len(margins)), 1.0]


def _grams(word: bytes) -> Iterator[tuple[int, bytes]]:
    for k in SEGMENT:
        for i in range(len(word) - k + 1):
            yield i, word[i:i + k]


def _doc_counts(docs: list[list[bytes]]) -> Counter:
    counts: Counter = Counter()
    for words in docs:
        counts.update({g for w in set(words) for _, g in _grams(w)})
    return counts


def _segments(docs: list[list[bytes]], good: set[bytes]) -> list[bytes]:
    """Stretches of words that good grams cover, in at least two documents, rarest first."""
    found: Counter = Counter()
    for words in docs:
        seen = set()
        for word in set(words):
            cover = np.zeros(len(word) + 2, dtype=np.int8)
            for i, g in _grams(word):
                if g in good:
                    cover[i + 1:i + 1 + len(g)] = 1
            edge = np.diff(cover)
            seen.update(word[a:b] for a, b in zip(np.flatnonzero(edge == 1),
                                                  np.flatnonzero(edge == -1)))
        found.update(seen)
    return [s for s, n in sorted(found.items(), key=lambda x: (x[1], x[0])) if n >= 2]


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + ridge * w
        hess = (x.T * np.maximum(p * (1 - p), 1e-9)) @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return w


def train(rows: list[tuple[str | None, int]], ordinary_bytes: int = 65536,
          toxic_bytes: int = 3072, share: float = 0.02, odds: float = 40.0) -> Model:
    """Fit on ``(text, label)`` rows; repeated texts count once. ``share`` is how many of the toxic
    documents a stretch has to occur in, ``odds`` how much more often than in ordinary ones."""
    rows = sorted({(t or "", int(y)) for t, y in rows})
    order = np.random.default_rng(0).permutation(len(rows))
    by = {label: [windows(rows[i][0]) for i in order if rows[i][1] == label] for label in (0, 1)}
    n_toxic, n_ordinary = len(by[1]), len(by[0])
    if not n_toxic or not n_ordinary:
        base = (n_toxic + 1) / (n_toxic + n_ordinary + 2)
        return Model(b"", b"", (0.0, 0.0, 0.0, math.log(base / (1 - base))))
    # Two thirds for the dictionaries, the rest to calibrate; with few documents, all for both.
    fit = {k: v[:max(1, 2 * len(v) // 3)] for k, v in by.items()}
    rest = {k: v[len(fit[k]):] or v for k, v in by.items()}
    words = {k: [[b" " + w + b" " for part in doc for w in part.split()] for doc in v]
             for k, v in fit.items()}
    toxic, plain = _doc_counts(words[1]), _doc_counts(words[0])

    def more(n1: int, n0: int) -> bool:
        return (n1 + .5) / (len(fit[1]) + 1) > odds * (n0 + .5) / (len(fit[0]) + 1)
    least = max(2, share * len(fit[1]))
    good = {g for g, n in toxic.items() if n >= least and more(n, plain[g])}
    segments = _segments(words[1], good)

    sample = [p for doc in fit[0] for p in doc]
    sample = [sample[i] for i in np.random.default_rng(1).permutation(len(sample))[:60_000]]
    try:
        base = zstandard.train_dictionary(ordinary_bytes, sample, k=64, d=6).as_bytes()
    except zstandard.ZstdError:  # too little text for the trainer
        base = b"".join(sample)
    base = base[-ordinary_bytes:]

    def dictionaries() -> tuple[bytes, bytes]:
        tail = b"".join(segments)[-toxic_bytes:]
        return base + bytes(len(tail)), base + tail
    # What gains on windows of ordinary documents as well is no sign of toxic text.
    hits = {0: Counter(), 1: Counter()}
    margins = Margins(*dictionaries())
    for label, docs in fit.items():
        for doc in docs:
            gained = [p for p, m in zip(doc, margins(doc)) if m >= 1]
            hits[label].update({p[i:i + 5] for p in gained for i in range(len(p) - 4)})
    segments = [s for s in segments if all(more(hits[1][s[i:i + 5]], hits[0][s[i:i + 5]])
                                           for i in range(max(1, len(s) - 4)) if len(s) >= 5
                                           and hits[0][s[i:i + 5]])]
    pair = dictionaries()
    margins = Margins(*pair)
    x = np.array([features(margins(doc)) for k in (0, 1) for doc in rest[k]])
    y = np.repeat([0.0, 1.0], [len(rest[0]), len(rest[1])])
    return Model(*pair, tuple(_logistic(x, y)))


_SCORED = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def score_text(text: str | None, margins: Margins, weights: tuple[float, ...]) -> float:
    z = float(np.dot(features(margins(windows(text))), weights))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _score(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    margins = Margins(model.ordinary, model.toxic)
    return in_batches(_SCORED, ((d, score_text(t, margins, model.weights))
                                for d, t in rows_of(batches, "doc_id", "text")))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 1200, modulus: int = 5,
        rest: int = 0) -> Model:
    """Train on at most ``per_class`` toxic and ``3 * per_class`` ordinary labelled documents.

    Only rows whose crc32 of the id modulo ``modulus`` isn't ``rest`` are used; those with the least
    hash of the id are chosen. Rows without a label or id don't count. The chosen texts are the only
    ones that are collected, and no cluster size changes their number.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                          F.col("toxic").cast("int").alias("y")).where(
        "doc_id is not null and y is not null").where(
        F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus)) != rest)
    order = [F.xxhash64("doc_id"), "doc_id"]
    ids = known.where("y = 1").orderBy(*order).limit(per_class).union(
        known.where("y = 0").orderBy(*order).limit(3 * per_class))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        F.broadcast(ids), "doc_id").select("text", "y").collect()
    return train([(r.text, r.y) for r in rows])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` for every row of ``docs``, from its whole text.

    Null, empty and blank texts have no window and get the score of a text without any margin; very
    long texts are scored window by window. Repeated rows are scored alike, a null id stays null,
    other columns are ignored, and an empty table gives an empty table.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        partial(_score, model=model), "doc_id long, score double")


def _keep(batches: Iterator[pa.RecordBatch], model: Model, threshold: float
          ) -> Iterator[pa.RecordBatch]:
    margins = Margins(model.ordinary, model.toxic)
    for batch in batches:
        keep = [score_text(t, margins, model.weights) < threshold
                for t in batch.column("text").to_pylist()]
        yield batch.filter(pa.array(keep, pa.bool_()))


def drop_toxic(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score under ``threshold``, all columns as they are."""
    return docs.mapInArrow(partial(_keep, model=model, threshold=threshold), docs.schema)
