"""Language by nearest centroid over TF-IDF vectors of letter n-grams.

A text becomes the hashed counts of its one to three letter n-grams, dampened by a logarithm,
weighted by inverse document frequency and normalised to length 1. Every language has several
centroids, found by spherical k-means over its training texts, since one language is written in
several ways. The nearest centroid by cosine names the language; a text further from it than nearly
all training texts of that language is marked as rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_batches, rows_of

_LETTER: np.ndarray | None = None
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)


def _letters() -> np.ndarray:
    global _LETTER
    if _LETTER is None:
        _LETTER = np.array([chr(i).isalpha() for i in range(0x110000)])
    return _LETTER


@dataclass(frozen=True)
class Model:
    """``centroids``: a row of ``bits`` hashed dimensions each, with the language it belongs to."""

    bits: int
    idf: np.ndarray
    centroids: np.ndarray
    languages: tuple[str, ...]
    limits: np.ndarray


def counts(text: str | None, bits: int) -> np.ndarray | None:
    """Hashed n-gram counts of the whole text; None without a letter. Words get a space around."""
    if not text:
        return None
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = _letters()[code]
    if not letter.any():
        return None
    code = np.where(letter, code, np.uint32(32))
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # one space after each word
    code = np.concatenate([[np.uint32(32)], code[keep], [np.uint32(32)]]).astype(np.uint32)
    total = np.zeros(1 << bits, dtype=np.float32)
    key = np.zeros(len(code), dtype=np.uint32)
    for n in range(3):
        key = key[:len(code) - n] * np.uint32(31) + (code[n:] + np.uint32(n + 1)) * _FACTORS[n]
        place = (key ^ key >> np.uint32(15)) * np.uint32(0x2C1B3C6D) >> np.uint32(32 - bits)
        total += np.bincount(place, minlength=1 << bits)
    return total


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-12)


def _cluster(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; starts spread out from the mean, so it needs no chance."""
    centers = [_unit(x.mean(axis=0))]
    near = x @ centers[0]
    for _ in range(min(k, len(x)) - 1):
        centers.append(x[int(np.argmin(near))])
        near = np.maximum(near, x @ centers[-1])
    c = np.stack(centers)
    for _ in range(rounds):
        own = np.argmax(x @ c.T, axis=1)
        c = np.stack([_unit(x[own == i].mean(axis=0)) if (own == i).any() else c[i]
                      for i in range(len(c))])
    return c


def train(rows: list[tuple[str | None, str | None]], bits: int = 13, per_language: int = 4,
          rejected: float = 0.002) -> Model:
    """Fit on ``(text, language)`` rows; ``rejected`` is the share of them beyond the limit."""
    made = [(counts(t, bits), lang) for t, lang in sorted(rows, key=str) if lang is not None]
    made = [(x, lang) for x, lang in made if x is not None]
    languages = sorted({lang for _, lang in made})
    if not made:
        return Model(bits, np.zeros(1 << bits, np.float32), np.zeros((0, 1 << bits), np.float32),
                     (), np.zeros(0))
    x = np.stack([v for v, _ in made])
    df = (x > 0).sum(axis=0)
    idf = np.log((1 + len(x)) / (1 + df)).astype(np.float32) + np.float32(1)
    np.log1p(x, out=x)
    x *= idf
    x = _unit(x)
    own = np.array([languages.index(lang) for _, lang in made])
    centroids, names, limits = [], [], []
    for i, lang in enumerate(languages):
        part = x[own == i]
        c = _cluster(part, per_language)
        limit = np.quantile((part @ c.T).max(axis=1), rejected)
        centroids.append(c)
        names += [lang] * len(c)
        limits += [limit] * len(c)
    return Model(bits, idf, np.concatenate(centroids).astype(np.float32), tuple(names),
                 np.array(limits))


_FOUND = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()),
                    ("rejected", pa.bool_())])


def predict(texts: list[str | None], model: Model) -> list[tuple[str, float, bool]]:
    out: list[tuple[str, float, bool]] = [("und", 0.0, True)] * len(texts)
    made = [(i, counts(t, model.bits)) for i, t in enumerate(texts)]
    made = [(i, x) for i, x in made if x is not None]
    if made and len(model.centroids):
        x = _unit(np.log1p(np.stack([v for _, v in made])) * model.idf)
        near = x @ model.centroids.T
        best = near.argmax(axis=1)
        for (i, _), b, row in zip(made, best, near):
            cosine = float(min(1.0, max(0.0, row[b])))
            out[i] = (model.languages[b], cosine, bool(cosine < model.limits[b]))
    return out


def _predict(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    def rows():
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = predict(part.column("text").to_pylist(), model)
                yield from ((d, *f) for d, f in zip(part.column("doc_id").to_pylist(), found))
    return in_batches(_FOUND, rows())


def fit(docs: DataFrame, per_language: int = 800, modulus: int = 4, rest: int = 2, **options
        ) -> Model:
    """Train on about ``per_language`` texts of each value of ``lang``, chosen by a hash of the id.

    Rows whose crc32 of the id modulo ``modulus`` is ``rest`` are held out, and those without a
    text, language or id don't count. One count per language and the chosen texts are collected,
    and no cluster size changes their number.
    """
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").where(
        "doc_id is not null and text is not null and lang is not null").where(
        F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus)) != rest)
    number = {r.lang: r.n for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not number:
        return train([])
    share = F.create_map(*(F.lit(x) for lang, n in number.items()
                           for x in (lang, min(1 << 20, -(-(per_language << 20) // n)))))
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share[F.col("lang")])
    return train([(r.text, r.lang) for r in chosen.select("text", "lang").collect()], **options)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` for every row, from its whole text alone.

    ``score`` is the cosine with the nearest centroid. Null and empty texts and texts without a
    letter are ``und`` with score 0, as is everything if there was nothing to learn from; very long
    texts count in full. Repeated rows are treated alike, a null id stays null, other columns are
    ignored, and an empty table gives an empty table.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        partial(_predict, model=model),
        "doc_id long, lang_pred string, score double, rejected boolean")
