"""License scan: hand-made notices, and the same rows from SQL."""

import time

import duckdb
import pytest

from tradewake.llm.licenses import RULES, SENTENCES, oracle, scan

MIT = """/*
 * The MIT License
 *
 * Copyright (c) 2020 Someone.
 *
 * Permission is hereby granted, free of charge, to any person obtaining a copy of this
 * software and associated documentation files (the "Software"), to deal in the Software
 * without restriction, including without limitation the rights to use, copy, modify, merge,
 * publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons
 * to whom the Software is furnished to do so, subject to the following conditions:
 *
 * The above copyright notice and this permission notice shall be included in all copies or
 * substantial portions of the Software.
 *
 * THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,
 * INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR
 * PURPOSE AND NONINFRINGEMENT. IN NO EVENT
 */
"""

DOCS = [
    (1, "Some text.\nLicensed under the Apache License, Version 2.0.\nMore."),
    (2, "no stop before\nReleased under the MIT License.\nAll rights reserved."),
    (3, MIT), (4, None), (5, ""), (6, "the mit license"),
    (7, "Licensed under CC BY-NC 4.0.  Licensed under CC BY-NC 4.0."),
    (8, "Licensed under the Apache License, Version 2.0, sort of."),
    (9, "Substantial portions. Permission is hereby granted"), (10, "…É. ALL RIGHTS RESERVED!"),
    (11, "This work is licensed under the GNU\nGeneral Public License,\nversion 3."),
    (11, "All rights reserved"), (None, "SPDX-License-Identifier: MIT"),
    (12, "# SPDX-License-Identifier: Apache-2.0\n"), (13, "x " * 50_000 + ". All rights reserved.")]

WANT = {(1, "Apache-2.0", 1, 1), (2, "MIT", 1, 1), (2, "All-Rights-Reserved", 1, 1), (3, "MIT", 4, 0),
        (7, "CC-BY-NC-4.0", 1, 0), (10, "All-Rights-Reserved", 1, 1), (11, "GPL-3.0", 1, 0),
        (11, "All-Rights-Reserved", 1, 0), (13, "All-Rights-Reserved", 1, 1)}


def test_notices(spark):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in DOCS],
                                 "doc_id long, text string, license string, lines int")
    out = [tuple(r) for r in scan(docs).collect()]
    assert len(out) == len(set(out))
    got = set(out)
    assert WANT <= got
    assert {r[0] for r in got} == {r[0] for r in WANT}
    assert scan(docs.limit(0)).count() == 0


def test_same_rows_from_sql(spark, tmp_path):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/d/*.parquet'")
    assert sorted(map(str, con.execute(oracle()).fetchall())) == sorted(
        str(tuple(r)) for r in scan(docs).collect())


def test_native_plan(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    plan = scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


@pytest.mark.parametrize("license, names", RULES)
def test_rules_use_known_sentences(license, names):
    assert set(names) <= set(SENTENCES)


def test_repeated_sentences_take_linear_time(spark):
    """A megabyte of all sentences of a rule but the last, again and again; then the last."""
    names = next(n for _, n in RULES if len(n) == 6)
    text = ". ".join(SENTENCES[n] for n in names[:-1]) + ".\n"
    many = text * (1_000_000 // len(text))
    docs = spark.createDataFrame([(1, many), (2, many + SENTENCES[names[-1]] + "."), (3, text[:-2])],
                                 "doc_id long, text string")
    began = time.time()
    got = sorted(map(tuple, scan(docs).collect()))
    assert time.time() - began < 60
    assert (2, "Apache-2.0", 6, 0) in got
    assert {r[0] for r in got if r[2] == 6} == {2}
