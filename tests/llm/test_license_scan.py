import re

from attemptlog.llm import license_scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def brute(text):
    words = WORD.findall((text or "").translate(LOWER))
    found = []
    for phrase, label in license_scan.BASE.items():
        parts = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    places = [i for i, _ in found]
    return (
        len(words), len(found), min(places, default=None), max(places, default=None),
        ",".join(sorted({label for _, label in found})),
    )


TEXTS = [
    None, "", " . ", "Licensed under CC BY-NC 4.0.", "cc by cc   by, CC-BY\ncc\x00by",
    "Licensed under the GNU General Public License, version 3.", "ÀLL rights reserved",
    "éall rights reserved ALL RIGHTS  RESERVED. all rights reserved2",
    "SPDX-License-Identifier: Apache-2.0", "Apache License, Version 2.0 and MIT license",
    "mit der license", "released under the terms of the GNU Lesser General Public License v2.1",
    "word " * 30000 + "all rights reserved", "ccby cc byte occ by", "general public license" * 3,
]


def run(spark, texts):
    rows = [(i, t, 0.5) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score double")
    return {r.doc_id: r for r in license_scan.summary(df, "doc_id", "text").collect()}


def test_base_places_match_plain_search(spark):
    out = run(spark, TEXTS)
    for i, text in enumerate(TEXTS):
        assert tuple(out[i])[1:6] == brute(text), text
        assert set(filter(None, out[i].base_labels.split(","))) <= set(out[i].labels.split(","))
        assert 0 <= out[i].score <= 1


def test_rules_and_suppression(spark):
    out = run(spark, TEXTS)
    assert out[3].labels == "cc-by,cc-by-nc-4.0"
    assert out[5].labels == "gpl,gpl-3.0"
    assert out[8].labels == "apache-2.0" and out[8].score == 1
    assert out[9].labels == "apache-2.0,mit"
    assert out[10].labels == ""
    assert out[11].labels == "gpl,lgpl-2.1"
    assert out[1].score == 0


def test_rules_are_many_and_gated():
    rules = license_scan.signatures()
    assert len(rules) > 300
    assert all(gates for _, gates, _, _, _ in rules)


def test_prefilter_loses_nothing():
    """Every rule's own wording passes the words looked for first and its gates."""
    scanner = license_scan.Scanner()
    for phrase in (*license_scan.BASE, "unlicense", "cc0 1 0 universal", "gnu gplv3", "x11 license",
                   "creative commons attribution 4 0", "two clause bsd", "cecill b", "copyleft",
                   "creative commons zero", "mit no attribution", "public domain", "apache 2 0"):
        kept, places = scanner(phrase.encode())
        assert kept or places, phrase


def test_given_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: tuple(r)[1:6] for r in license_scan.summary(docs, "doc_id", "text").collect()}
    assert got == {r.doc_id: brute(r.text) for r in docs.collect()}
    assert license_scan.summary(docs.limit(0), "doc_id", "text").collect() == []


def test_null_and_repeated_keys(spark):
    df = spark.createDataFrame([(None, "cc by"), (1, "cc by"), (1, None)], "doc_id long, text string")
    assert sorted(r.n_base for r in license_scan.summary(df, "doc_id", "text").collect()) == [0, 1, 1]
