"""Ids of whole texts, wavelet matrices and packing against plain versions."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tradewake.llm import tokens
from tradewake.llm.common import Stage
from tradewake.llm.packing import Capacity, best_fit, pack, pack_documents
from tradewake.llm.tokens import Encoder, encoder
from tradewake.llm.wavelet import WaveletMatrix, look_up, read_documents, write_shards

PATH = public_tokenizers.path("word_bpe_49k.json")

TEXTS = [
    None, "", " ", "It's 42 o'clock.\nNext\tline", "ÉCOLE école école", "́start ́",
    "a b c\u0085d\x1ce\x1ff", "<|endoftext|> x<|startoftext|>y", "ΟΔΟΣ Σ İI ß ẞ",
    "汉字 かな 🙂🙂 ‍﻿", "x" * 5000, "don't 'll 're'd  ''s", "\x00 \x0b\x0c\r\n",
    "word " * 3000, "naïve Größe—ÿ÷×ÆØ ªº µ", "''s'tx don't!'s ('ll) 'REd <|x 3½", "`~^_{}|a1b22",
    "a'" * 50, "éÈß" * 40, "s\u0301 e\u0301 \u0301!", "x<|endoftext|", "\x7fa\x1bb"]


def whole(text):
    return encoder(PATH).tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("text", TEXTS)
def test_same_ids_as_whole_text(text):
    got = np.frombuffer(next(encoder(PATH).encode([text])), dtype="<u4")
    assert got.tolist() == whole(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=4))
def test_same_ids_for_any_text(texts):
    got = [np.frombuffer(x, dtype="<u4").tolist() for x in encoder(PATH).encode(texts)]
    assert got == [whole(t) for t in texts]


PLAIN = "abcdeslmrtvÀéßÿ '!<|>`~0129.\n\té\x7f"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=PLAIN, max_size=80), max_size=4))
def test_same_ids_for_plain_text(texts):
    got = [np.frombuffer(x, dtype="<u4").tolist() for x in encoder(PATH).encode(texts)]
    assert got == [whole(t) for t in texts]


def test_new_words_take_the_model_alone():
    text = "It's naïve: 42 o'clock, ÉCOLE ßàÿ!?"
    enc, ids = Encoder(PATH), whole(text)
    enc.tokenizer = None
    assert np.frombuffer(next(enc.encode([text])), dtype="<u4").tolist() == ids


def test_remembered_words_are_bounded_within_a_text(monkeypatch):
    monkeypatch.setattr(tokens, "MOST_KEYS", 50)
    text, enc = " ".join(f"wort{chr(97 + i // 20)}é{chr(97 + i % 20)}" for i in range(400)), Encoder(PATH)
    assert np.frombuffer(next(enc.encode([text])), dtype="<u4").tolist() == whole(text)
    assert len(enc.known) <= 50


def test_words_of_many_texts_are_looked_up_once():
    class Counted(dict):
        def __getitem__(self, key):
            asked.append(key)
            return super().__getitem__(key)

    texts = ["One two\u2014three don't", None, "two ONE  two", "two\u2014three two\u2014three "] * 300
    enc, asked = Encoder(PATH), []
    enc.known = Counted({w: enc.known[w] for w in ["one", "two", "two\u2014three", "don", "'t"]})
    got = [np.frombuffer(x, dtype="<u4").tolist() for x in enc.encode(texts)]
    assert got == [whole(t) for t in texts[:4]] * 300
    assert sorted(asked) == sorted(enc.known)


@pytest.mark.parametrize("together", [1, 40, 4 << 20])
def test_same_ids_however_many_texts_are_cut_together(monkeypatch, together):
    monkeypatch.setattr(tokens, "TOGETHER", together)
    texts = [*TEXTS, "'", "s", "<", "|endoftext|>", "x'", "re", "", *TEXTS[::-1], "", ""]
    got = [np.frombuffer(x, dtype="<u4").tolist() for x in Encoder(PATH).encode(texts)]
    assert got == [whole(t) for t in texts]


def test_planes_of_mixed_bits():
    ids = np.random.default_rng(3).integers(0, 49408, 5000)
    m = WaveletMatrix.from_row(*WaveletMatrix.build(ids, 16).row())
    assert m.decode().tolist() == ids.tolist() == m.access(np.arange(len(ids))).tolist()
    assert m.zeros[0] == int((ids < 1 << 15).sum())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 60), max_size=1500), st.integers(0, 63))
def test_wavelet_matrix(ids, symbol):
    m = WaveletMatrix.from_row(*WaveletMatrix.build(np.array(ids, dtype=np.int64), 6).row())
    assert m.decode().tolist() == ids
    assert m.access(np.arange(len(ids))).tolist() == ids
    places = [i for i, x in enumerate(ids) if x == symbol]
    assert m.count(symbol) == len(places)
    assert m.occurrences(symbol).tolist() == places
    assert m.select(symbol, len(places)) == -1
    for end in (0, len(ids) // 2, len(ids)):
        assert m.rank(symbol, end) == ids[:end].count(symbol)
    assert m.count(64) == 0


def documents(spark):
    rnd = random.Random(5)
    rows = [(i * 3, t, "x") for i, t in enumerate(TEXTS)]
    rows += [(100 + i, " ".join(rnd.choices(["alpha", "beta", "gamma"], k=rnd.randint(1, 400))), "y")
             for i in range(80)]
    rnd.shuffle(rows)
    return rows, spark.createDataFrame(rows, "doc_id long, text string, start string").repartition(5)


def test_shards_round_trip(spark):
    rows, docs = documents(spark)
    place = Stage(spark, "shards").path
    write_shards(docs, place, PATH, most=2000)
    at, want = 0, {}
    for doc_id, text, _ in sorted(rows):
        ids = np.array([*whole(text), 1], dtype="<u4")
        want[doc_id] = (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    got = {r[0]: tuple(r[1:]) for r in read_documents(spark, place).collect()}
    assert got == want
    symbol = whole("beta")[0]
    found = sorted(map(tuple, look_up(spark, place, symbol).collect()))
    assert found == sorted((d, k) for d, t, _ in rows
                           for k, x in enumerate([*whole(t), 1]) if x == symbol)


def test_shards_of_nothing_and_null_ids(spark):
    place = Stage(spark, "shards").path
    write_shards(spark.createDataFrame([], "doc_id long, text string"), place, PATH)
    assert read_documents(spark, place).count() == 0
    place = Stage(spark, "shards").path
    write_shards(spark.createDataFrame([(None, "b"), (None, "a"), (2, "b"), (2, "b")],
                                       "doc_id long, text string"), place, PATH)
    rows = read_documents(spark, place).orderBy("start").collect()
    assert [(r.doc_id, r.start, r.n_tokens) for r in rows] == [
        (None, 0, 2), (None, 2, 2), (2, 4, 2), (2, 6, 2)]


def check_packing(rows, capacity, lengths=None):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    documents, cost = capacity.documents or 10**9, capacity.cost or 10**18
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= capacity.tokens or len(items) == 1
        assert len(items) <= documents
        assert sum(n * n for _, n in items) <= cost or len(items) == 1
    return len(bins)


@pytest.mark.parametrize("capacity", [
    Capacity(100), Capacity(100, documents=3, weights=(1, 1, 0)),
    Capacity(100, documents=4, cost=4000, weights=(1, .5, 1), rule="dot"),
    Capacity(100, cost=5000, weights=(1, 0, 2))])
def test_constraints_hold(spark, capacity):
    rnd = random.Random(2)
    rows = [(i, rnd.choice([1, 5, 20, 33, 60, 99, 100])) for i in range(700)]
    df = spark.createDataFrame(rows, "id long, length long")
    out = pack(df, capacity, Stage(spark, "p"), block=150).collect()
    assert sorted((r.id, r.length) for r in out) == rows
    n = check_packing(out, capacity)
    if capacity == Capacity(100):
        assert n <= -(-sum(r[1] for r in rows) // 100) * 1.03 + 1


def test_best_fit_takes_the_tightest_sequence():
    place = best_fit(np.array([70, 60, 30, 40]), Capacity(100))
    assert place[0] == place[2] and place[1] == place[3]
    assert len(set(best_fit(np.zeros(0), Capacity(10)))) == 0
    # Two documents at most: the third small piece needs a new sequence.
    assert len(set(best_fit(np.array([1, 1, 1]), Capacity(10, documents=2)))) == 2


def test_pack_documents(spark):
    rows, docs = documents(spark)
    out = pack_documents(docs, PATH, capacity=Capacity(300)).collect()
    by = defaultdict(list)
    for r in out:
        by[r.doc_id].append(r)
    for doc_id, text, _ in rows:
        ids = np.array([*whole(text), 1], dtype="<u4")
        pieces = sorted(by[doc_id], key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(-(-len(ids) // 300)))
        for r in pieces:
            part = ids[r.start:r.start + r.length]
            assert r.start == 300 * r.piece and r.length == len(part)
            assert r.ids_crc32 == zlib.crc32(part.tobytes())
    n = check_packing(out, Capacity(300))
    assert n <= sum(r.length for r in out) / 300 * 1.02 + 2
    assert pack_documents(docs.limit(0), PATH).count() == 0
