"""The pipeline against plain versions of its stages, each on its own input."""

import random

import public_tokenizers
import pytest

import corpus_pipeline
from tradewake.llm.common import Stage
from tradewake.llm.line_dedup import delete_runs
from tradewake.llm.tokens import encoder

from .test_decontaminate import least_edits, words
from .test_line_dedup import longest_earlier
from .test_minhash_forest import brute as near_brute
from .test_toxicity import text as toxic_text


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    place = str(tmp_path_factory.mktemp("tables"))
    rnd = random.Random(9)
    vocabulary = ["".join(rnd.choices("abcdefgh", k=rnd.randint(2, 7))) for _ in range(300)]
    line = lambda n: " ".join(rnd.choices(vocabulary, k=n))
    items = [line(rnd.randint(12, 40)) for _ in range(6)]
    passage = [line(20), line(40)]
    docs = []
    for i in range(600):
        lines = [line(rnd.randint(4, 25)) for _ in range(rnd.randint(1, 6))]
        if i % 9 == 0:
            lines[1:1] = passage
        if i % 14 == 0:
            lines.append(rnd.choice(items))
        if i % 3 == 2:
            lines = [toxic_text(rnd, i % 2)]
        docs.append((i, "\n".join(lines)))
    docs += [(900 + k, docs[k][1]) for k in range(4)]                      # exact copies
    docs += [(920 + k, docs[k][1].replace(" a", " z", 1)) for k in range(0, 40, 3)]
    docs += [(1400, None), (1401, ""), (1402, "short")]
    frame = spark.createDataFrame([(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in docs],
                                  "doc_id long, text string, lang string, source string, n_chars long")
    frame.repartition(3).write.parquet(f"{place}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 3 == 2 and i % 2)) for i in range(600)],
                          "doc_id long, quality int, toxic int").write.parquet(f"{place}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string") \
        .write.parquet(f"{place}/benchmark.parquet")
    return place, items


def test_stages(spark, tables):
    place, items = tables
    stage = Stage(spark, "test")
    docs = spark.read.parquet(f"{place}/documents.parquet")
    seen = {}
    for name, step in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        out = stage.save(step(spark, docs, place))
        if name != "packing":
            assert out.schema.simpleString() == docs.schema.simpleString()
        seen[name] = before, out.collect()
        docs = out

    before, after = seen["toxicity"]
    gone = {d for d, _ in before} - {r.doc_id for r in after}
    toxic = {d for d, t in before if t and any(w in t for w in ("zarglub", "krexnit", "vomplork"))}
    assert len(gone & toxic) >= 0.9 * len(toxic) and len(gone - toxic) <= 2

    before, after = seen["line_dedup"]
    runs = {}
    for (d, p), n in longest_earlier(before).items():
        runs.setdefault(d, []).append((p, n))
    want = {}
    for d, t in before:
        text, deleted, left = (t, 0, 1) if not t else delete_runs(t, runs.get(d, []), 1, 8)
        if not deleted or left:
            want[d] = (text, len(text or ""))
    assert {r.doc_id: (r.text, r.n_chars) for r in after} == want

    before, after = seen["minhash_near_dedup"]
    assert {r.doc_id for r in after} == {d for d, x in near_brute(before, 5).items() if x[2]}

    before, after = seen["decontamination"]
    leaks = {d for d, t in before for i in items
             if least_edits(words(i), words(t)) <= int(0.2 * len(words(i)) + 1e-9)}
    assert {r.doc_id for r in after} == {d for d, _ in before} - leaks

    before, after = seen["packing"]
    total = {d: len(encoder(public_tokenizers.path("word_bpe_49k.json")).tokenizer.encode(
        t or "", add_special_tokens=False).ids) + 1 for d, t in before}
    got = {}
    for r in after:
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == total
    assert len({r.sequence_id for r in after}) == -(-sum(total.values()) // 4096)


def test_run_and_empty_tables(spark, tables, tmp_path):
    place, _ = tables
    assert corpus_pipeline.run(spark, place).count() > 50
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{place}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_near_duplicates_of_repeated_and_null_ids(spark):
    a, b, c = (" ".join(f"{w}{n}" for n in range(40)) for w in "abc")
    rows = [(1, a), (2, a), (2, b), (3, c), (3, c), (None, c), (None, "d " + b), (4, None), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [(1, a), (2, b), (3, c), (4, None), (4, None)], key=str)


def test_columns_that_clash_with_inner_names(spark):
    names = ["__d", "__t", "__runs", "__deleted", "__left", "__key", "size", "label", "rank"]
    line = "one two three four five six seven eight nine"
    rows = [(1, f"first {line}", *names), (2, f"{line}\nown words", *names),
            (3, f"{line}\nother words", *names)]
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names))
    lines = corpus_pipeline.drop_repeated_lines(spark, docs, "")
    assert lines.columns == docs.columns
    assert sorted(map(tuple, lines.collect())) == [*rows[:2], (3, "other words", *names)]
    near = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert near.columns == docs.columns and sorted(map(tuple, near.collect())) == rows
    items = spark.createDataFrame([(7, "own words")], "item_id long, text string")
    clean = corpus_pipeline.decontaminate.clean_documents(docs, items)
    assert clean.columns == docs.columns
    assert {tuple(r)[2:] for r in clean.collect()} == {tuple(names)}
