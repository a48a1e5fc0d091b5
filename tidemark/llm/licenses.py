"""Licence scan by canonical digests, with built-in functions only.

A text is brought to a canonical form, in which case, punctuation, white space, copyright lines and equivalent spellings make no
difference, and the SHA-256 of the whole form is looked up in a table of known licence texts by a hash join. Looked up are the
whole document, each of its lines, since licence statements mostly stand on a line of their own, its blocks of lines between lines without
letters and digits, and its runs of comment lines; a text within a line is no match, as the method compares entire texts.

Known are the statements of ``KNOWN``, the full licence texts in license_texts.json (with the usual titles) and of these the paragraphs of ``PARAGRAPH_WORDS``
words or more that belong to one licence only, so a licence is found within a longer document by its paragraphs.

The form: lower case; lines that state a copyright are removed; every run of characters other than letters and digits is one
space; the spellings of ``SPELLINGS`` are unified word by word.

Each document's distinct forms are taken where it is read, and the known table, a list in the
code or given by the caller, is joined to them: broadcast up to ``BROADCAST_KNOWN`` rows, beyond that by shuffling digests, not texts.

Defined cases: null and empty texts, and texts of which the form is empty, match nothing. A line that occurs twice counts once; blocks add to the identifiers only. Repeated
rows and null doc_ids are scanned like others, each on its own. Extra columns are ignored. No known texts: no match.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Equivalent spellings, as found and as unified.
SPELLINGS = {
    "licence": "license", "licences": "licenses", "licenced": "licensed", "sublicence": "sublicense", "licencing": "licensing",
    "acknowledgement": "acknowledgment", "acknowledgements": "acknowledgments", "analogue": "analog", "analyse": "analyze",
    "artefact": "artifact", "authorisation": "authorization", "authorised": "authorized", "calibre": "caliber", "cancelled": "canceled",
    "centre": "center", "colour": "color", "favour": "favor", "fulfil": "fulfill", "fulfilment": "fulfillment", "initialise": "initialize",
    "judgement": "judgment", "labelling": "labeling", "labour": "labor", "modelling": "modeling", "offence": "offense", "optimise": "optimize",
    "organisation": "organization", "organise": "organize", "practise": "practice", "programme": "program", "realise": "realize",
    "recognise": "recognize", "signalling": "signaling", "utilisation": "utilization", "whilst": "while", "wilful": "willful",
    "noncommercial": "nc", "attribution": "by", "v2": "2", "v3": "3", "v4": "4",
}

# Licence statements and short licence texts by identifier.
KNOWN = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-3-Clause", "Licensed under the 3-Clause BSD License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("ARR", "All rights reserved."),
]

BROADCAST_KNOWN = 100_000
PARAGRAPH_WORDS = 20
TEXTS = Path(__file__).with_name("license_texts.json")
COMMENT = r"^\s*(?://|#|\*|/\*|--|;)"
NOT_WORD = r"[^\p{L}\p{N}]+"
COPYRIGHT = r"(?m)^[^\p{L}\p{N}\n]*(?:copyright(?:\s+(?:\(c\)|©|\d)[^\n]*|[ \t]+by[ \t][^\n]*)?|©[^\n]*|\(c\)\s*\d[^\n]*)$"


def canonical(text: Column) -> Column:
    """The form in which equal licences are equal; empty for null."""
    plain = F.regexp_replace(F.lower(F.coalesce(text.cast("string"), F.lit(""))), COPYRIGHT, " ")
    plain = F.concat(F.lit(" "), F.regexp_replace(plain, NOT_WORD, " "), F.lit(" "))
    found = F.regexp_replace(plain, " (?=(?:" + "|".join(SPELLINGS) + ") )", " \x01")
    for old, new in SPELLINGS.items():
        found = F.replace(found, F.lit(f"\x01{old} "), F.lit(f"{new} "))
    unified = F.when(plain.rlike(" (?:" + "|".join(SPELLINGS) + ") "), found).otherwise(plain)
    return F.trim(unified)


def digest(text: Column) -> Column:
    """SHA-256 of the canonical form; null where the form is empty."""
    form = canonical(text)
    return F.when(form != "", F.sha2(form.cast("binary"), 256))


def licence_texts() -> list[tuple[str, str]]:
    """The full texts, and their long paragraphs that one licence alone has."""
    whole = [(x["license_id"], x["text"]) for x in json.loads(TEXTS.read_text(encoding="utf-8"))]
    of: dict[str, set[str]] = {}
    found: dict[str, str] = {}
    for name, text in whole:
        for block in re.split(r"\n(?:[^\w\n]*\n)+", text):
            words = re.findall(r"[^\W_]+", block.lower())
            if len(words) >= PARAGRAPH_WORDS:
                of.setdefault(" ".join(words), set()).add(name)
                found[" ".join(words)] = block
    return whole + [(*of[form], block) for form, block in found.items() if len(of[form]) == 1]


def known_licenses(spark: SparkSession, texts: list[tuple[str, str]] | None = None) -> DataFrame:
    """license_id and digest of the known texts; a text known under several identifiers keeps the first of them."""
    rows = spark.createDataFrame(KNOWN + licence_texts() if texts is None else texts, "license_id string, text string")
    return rows.select("license_id", digest(F.col("text")).alias("digest")).where("digest is not null").groupBy("digest").agg(F.min("license_id").alias("license_id"))


def _blocks(lines: Column, inside: Callable[[Column], Column]) -> Column:
    """Runs of two or more lines for which ``inside`` holds."""
    runs = F.split(F.array_join(F.transform(lines, lambda x: F.when(inside(x), x).otherwise("")), "\n"), "\n{2,}")
    return F.filter(F.transform(runs, lambda x: F.trim(x, F.lit("\n"))), lambda x: F.contains(x, F.lit("\n")))


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """doc_id, license_ids (sorted), n_lines (distinct lines that are a licence) and whole (the entire text is one).

    One row per row of ``docs``.
    """
    if known.count() <= BROADCAST_KNOWN:
        known = F.broadcast(known)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    every = F.split(text, r"\R")
    lines = F.array_distinct(F.transform(every, lambda x: F.trim(x)))
    comments = F.when(F.exists(every, lambda x: x.rlike(COMMENT)), _blocks(every, lambda x: x.rlike(COMMENT))).otherwise(F.array().cast("array<string>"))
    blocks = F.array_distinct(F.concat(_blocks(every, lambda x: x.rlike(r"[\p{L}\p{N}]")), comments))

    def as_units(kind: str, parts: Column) -> Column:
        return F.transform(parts, lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("part")))

    units = F.concat(as_units("whole", F.array(text)), as_units("line", F.filter(lines, lambda x: x != "")), as_units("block", blocks))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", units.alias("units"))
    each = rows.select("row", "doc_id", F.explode("units").alias("unit")).select(
        "row", "doc_id", (F.col("unit.kind") == "whole").alias("whole"), (F.col("unit.kind") == "line").alias("line"), digest(F.col("unit.part")).alias("digest"))
    hits = each.join(known, "digest", "left").where("license_id is not null or whole").groupBy("row", "doc_id").agg(
        F.array_sort(F.collect_set("license_id")).alias("ids"),
        F.count_distinct(F.when(F.col("line") & F.col("license_id").isNotNull(), F.col("digest"))).alias("n_lines"),
        F.max(F.col("whole") & F.col("license_id").isNotNull()).alias("whole"))
    return hits.select("doc_id", F.array_join("ids", ",").alias("license_ids"), F.col("n_lines").cast("long").alias("n_lines"), "whole")


def oracle_sql() -> str:
    """The same scan for another SQL engine."""
    def form(text: str) -> str:
        return f"regexp_replace(regexp_replace(lower({text}), '{COPYRIGHT}', ' ', 'g'), '{NOT_WORD}', ' ', 'g')"

    words = "list_transform(string_split(trim({}), ' '), lambda w: coalesce(map_extract_value(spellings, w), w))"
    spellings = "MAP {" + ", ".join(f"'{a}': '{b}'" for a, b in SPELLINGS.items()) + "}"
    known = ", ".join("('{}', '{}')".format(a, b.replace("'", "''")) for a, b in KNOWN)

    def unified(text: str) -> str:
        return "array_to_string(" + words.format(form(text)) + ", ' ')"

    return f"""
WITH s AS (SELECT {spellings} AS spellings),
known AS (SELECT {unified('t')} AS f, min(id) AS id FROM (VALUES {known}) k(id, t), s GROUP BY 1),
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
u AS (SELECT r, true AS whole, text AS part FROM d
      UNION ALL SELECT r, false, x FROM (SELECT DISTINCT r, trim(unnest(regexp_split_to_array(text, '\\r\\n|[\\n\\x0B\\f\\r]'))) AS x FROM d) WHERE x <> ''),
f AS (SELECT r, whole, {unified('part')} AS f FROM u, s),
hits AS (SELECT r, string_agg(DISTINCT id, ',' ORDER BY id) AS ids, count(DISTINCT CASE WHEN NOT whole THEN f.f END) AS n, bool_or(whole) AS whole
         FROM f JOIN known ON f.f = known.f WHERE f.f <> '' GROUP BY r)
SELECT doc_id, coalesce(ids, '') AS license_ids, CAST(coalesce(n, 0) AS BIGINT) AS n_lines, coalesce(whole, false) AS whole
FROM d LEFT JOIN hits USING (r)"""
