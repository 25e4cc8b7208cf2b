"""License notices by sentence rules, with DataFrame functions only.

Known licence sentences have identifiers. A document's sentences are normalised and mapped to them;
the sequence of identifiers is matched against rules: ordered lists of sentences that name a licence.
One pass over the sequence moves every rule on as its next sentence comes. Of the rules of one licence
that are through, the best counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licences and of common notices, normalised by ``normal``, with
# the identifiers that the rules use.
SENTENCES = {
    "apache-2-notice": "licensed under the apache license version 2 0",
    "apache-2-the": "licensed under the apache license version 2 0 the license",
    "apache-2-comply": "you may not use this file except in compliance with the license",
    "apache-2-copy": "you may obtain a copy of the license at",
    "apache-2-url": "http www apache org licenses license 2 0",
    "apache-2-spdx": "spdx license identifier apache 2 0",
    "asis-apache": "unless required by applicable law or agreed to in writing software distributed "
                   "under the license is distributed on an as is basis without warranties or "
                   "conditions of any kind either express or implied",
    "apache-2-see": "see the license for the specific language governing permissions and "
                    "limitations under the license",
    "mit-released": "released under the mit license",
    "mit-licensed": "licensed under the mit license",
    "mit-title": "the mit license",
    "mit-title-short": "mit license",
    "mit-spdx": "spdx license identifier mit",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this "
                 "software and associated documentation files the software to deal in the software "
                 "without restriction including without limitation the rights to use copy modify "
                 "merge publish distribute sublicense and or sell copies of the software and to "
                 "permit persons to whom the software is furnished to do so subject to the "
                 "following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all "
                  "copies or substantial portions of the software",
    "asis-mit": "the software is provided as is without warranty of any kind express or implied "
                "including but not limited to the warranties of merchantability fitness for a "
                "particular purpose and noninfringement",
    "gpl-3-work": "this work is licensed under the gnu general public license version 3",
    "gpl-3-program": "this program is licensed under the gnu general public license version 3",
    "gpl-3-spdx": "spdx license identifier gpl 3 0 only",
    "gpl-free": "this program is free software you can redistribute it and or modify it under the "
                "terms of the gnu general public license as published by the free software "
                "foundation either version 3 of the license or at your option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any "
                "warranty without even the implied warranty of merchantability or fitness for a "
                "particular purpose",
    "gpl-details": "see the gnu general public license for more details",
    "cc-by-nc-4": "licensed under cc by nc 4 0",
    "cc-by-nc-4-work": "this work is licensed under cc by nc 4 0",
    "cc-by-nc-4-long": "this work is licensed under a creative commons attribution noncommercial 4 0 "
                       "international license",
    "cc-by-4": "licensed under cc by 4 0",
    "cc-by-4-long": "this work is licensed under a creative commons attribution 4 0 international "
                    "license",
    "cc-by-sa-4": "licensed under cc by sa 4 0",
    "cc0-1": "this work is dedicated to the public domain under cc0 1 0",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are "
                 "permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list "
                  "of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this "
                  "list of conditions and the following disclaimer in the documentation and or other "
                  "materials provided with the distribution",
    "bsd-name": "neither the name of the copyright holder nor the names of its contributors may be "
                "used to endorse or promote products derived from this software without specific "
                "prior written permission",
    "mpl-2": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "mpl-2-copy": "if a copy of the mpl was not distributed with this file you can obtain one at "
                  "http mozilla org mpl 2 0",
    "rights-reserved": "all rights reserved",
}

# Licences and their rules, each an ordered list of sentence identifiers.
RULES = [
    ("Apache-2.0", ["apache-2-notice"]),
    ("Apache-2.0", ["apache-2-spdx"]),
    ("Apache-2.0", ["apache-2-the", "apache-2-comply", "apache-2-copy", "apache-2-url",
                    "asis-apache", "apache-2-see"]),
    ("MIT", ["mit-released"]),
    ("MIT", ["mit-licensed"]),
    ("MIT", ["mit-spdx"]),
    ("MIT", ["mit-title", "mit-grant", "mit-notice", "asis-mit"]),
    ("MIT", ["mit-title-short", "mit-grant", "mit-notice", "asis-mit"]),
    ("MIT", ["mit-grant", "mit-notice", "asis-mit"]),
    ("GPL-3.0", ["gpl-3-work"]),
    ("GPL-3.0", ["gpl-3-program"]),
    ("GPL-3.0", ["gpl-3-spdx"]),
    ("GPL-3.0", ["gpl-free", "gpl-hope", "gpl-details"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4-work"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4-long"]),
    ("CC-BY-4.0", ["cc-by-4"]),
    ("CC-BY-4.0", ["cc-by-4-long"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4"]),
    ("CC0-1.0", ["cc0-1"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-name"]),
    ("MPL-2.0", ["mpl-2", "mpl-2-copy"]),
    ("All-Rights-Reserved", ["rights-reserved"]),
]

# What ends a sentence, in text whose lines are broken anywhere and in text with a
# sentence a line; what comment lines begin with; what separates words.
ENDS = {"wrapped": r"[.!?:;]+[ \t\r\n]+|\n[ \t\r]*\n", "lines": r"[.!?:;]+[ \t\r]+|\n"}
COMMENT = r"\n[ \t]*[#*/;-]+[ \t]*"
BETWEEN = r"[^0-9a-z\x{80}-\x{10FFFF}]+"


def _sentences(text: Column, ends: str) -> Column:
    """Normalised sentences in order; comment marks at the start of lines go first."""
    plain = F.regexp_replace(F.concat(F.lit("\n"), text), COMMENT, "\n")
    words = F.transform(F.split(plain, ends), lambda s: F.trim(F.regexp_replace(
        F.lower(s), BETWEEN, " ")))
    return F.filter(words, lambda s: s != "")


def _pattern(names: list[str]) -> str:
    """Matches a sequence of identifiers with commas around that has ``names`` in this order."""
    return "," + ",(.*,)?".join(names) + ","


def _progress(hits: str, rules: list[tuple[str, list[str]]]) -> Column:
    """How many of its sentences each rule has met, in order, after all of a document's."""
    wanted = F.array(*(F.array(*map(F.lit, names)) for _, names in rules))
    return F.aggregate(
        f"{hits}.name", F.array_repeat(F.lit(0), len(rules)),
        lambda met, name: F.zip_with(met, wanted, lambda k, names: F.when(
            F.get(names, k) == name, k + 1).otherwise(k)))


def _place(hits: str, name: str) -> Column:
    """Place of the first sentence ``name``."""
    return F.try_element_at(F.filter(hits, lambda h: h["name"] == name), F.lit(1))["place"]


def scan(docs: DataFrame, sentences: dict[str, str] = SENTENCES,
         rules: list[tuple[str, list[str]]] = RULES) -> DataFrame:
    """One row per document and licence: ``doc_id, license, rule_sentences, first_sentence``.

    ``docs`` has ``doc_id`` and ``text``; other columns are ignored. A rule holds if all its
    sentences occur in its order, others between them or not. Sentences are cut in two ways, with
    line breaks as white space and with line breaks as ends, and either may match. Of the rules of a
    licence that hold, the longest counts: ``rule_sentences`` is its length and ``first_sentence``
    the number, from 0, of the document's sentence that it begins with (the least, if both ways
    match).

    Null and empty texts have no licence. Repeated rows give repeated results, a null ``doc_id``
    stays null, and an empty table gives an empty table. Nothing is shuffled.
    """
    known = F.create_map(*(F.lit(x) for name, text in sentences.items() for x in (text, name)))

    def hits(ends: str) -> Column:
        numbered = F.transform(_sentences(F.col("text"), ends), lambda s, i: F.struct(
            i.alias("place"), F.try_element_at(known, s).alias("name")))
        return F.filter(numbered, lambda x: x["name"].isNotNull())

    # The generator keeps the filter from computing the hits a second time.
    found = docs.where("text is not null").select("doc_id", F.explode(F.array(F.struct(
        *(hits(ends).alias(way) for way, ends in ENDS.items())))).alias("x")).where(
        F.size("x.wrapped") + F.size("x.lines") > 0).select("doc_id", "x.*")
    # Again a generator, so that the progress isn't computed once for every rule.
    met = F.struct(*(_progress(way, rules).alias(f"{way}_met") for way in ENDS))
    found = found.select("*", F.inline(F.array(met)))
    held = [F.when(F.get(f"{way}_met", F.lit(i)) == len(names), F.struct(
        F.lit(license).alias("license"), F.lit(len(names)).alias("n"),
        (-_place(way, names[0])).alias("back"))) for way in ENDS
        for i, (license, names) in enumerate(rules)]
    each = found.select("doc_id", F.explode(F.array(F.array_compact(F.array(*held)))).alias("m"))
    named = each.select("doc_id", "m", F.explode(F.array_distinct("m.license")).alias("license"))
    best = F.array_max(F.transform(F.filter("m", lambda r: r["license"] == F.col("license")),
                                   lambda r: F.struct(r["n"], r["back"])))
    return named.select("doc_id", "license", best.alias("b")).select(
        "doc_id", "license", F.col("b.n").alias("rule_sentences"),
        (-F.col("b.back")).alias("first_sentence"))


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def oracle(table: str = "documents") -> str:
    """The scan as DuckDB SQL."""
    known = ", ".join(f"({_text(t)}, {_text(n)})" for n, t in SENTENCES.items())
    rules = ", ".join(f"({_text(license)}, {len(names)}, {_text(names[0])}, {_text(_pattern(names))})"
                      for license, names in RULES)
    ways = " UNION ALL ".join(
        f"SELECT row, doc_id, '{way}' AS way, list_filter(list_transform("
        f"string_split_regex(plain, {_text(ends)}), lambda x: trim(regexp_replace(lower(x), "
        f"{_text(BETWEEN)}, ' ', 'g'))), lambda x: x <> '') AS list FROM plain" for way, ends in ENDS.items())
    return f"""
WITH known(sentence, name) AS (VALUES {known}),
rules(license, n, first_name, pattern) AS (VALUES {rules}),
plain AS (SELECT row_number() OVER () AS row, doc_id,
          regexp_replace(chr(10) || text, {_text(COMMENT)}, chr(10), 'g') AS plain
          FROM {table} WHERE text IS NOT NULL),
cut AS ({ways}),
numbered AS (SELECT row, doc_id, way, unnest(list) AS sentence,
             unnest(range(len(list))) AS place FROM cut),
hits AS (SELECT row, doc_id, way, name, place FROM numbered JOIN known USING (sentence)),
sequences AS (SELECT row, doc_id, way, ',' || string_agg(name, ',' ORDER BY place) || ',' AS names
              FROM hits GROUP BY ALL),
firsts AS (SELECT row, way, name, min(place) AS place FROM hits GROUP BY ALL),
held AS (SELECT s.row, doc_id, license, n, f.place FROM sequences s
         JOIN rules ON regexp_matches(names, pattern)
         JOIN firsts f ON f.row = s.row AND f.way = s.way AND f.name = first_name),
best AS (SELECT *, row_number() OVER (PARTITION BY row, license ORDER BY n DESC, place) AS k
         FROM held)
SELECT doc_id, license, CAST(n AS INTEGER) AS rule_sentences,
       CAST(place AS INTEGER) AS first_sentence FROM best WHERE k = 1
"""
