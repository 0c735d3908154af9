import re

from frames import EDGE, clashing, docs

from strata.llm import license_scan as L
from strata.llm.license_rules import BASE, literal, rules

SAMPLES = [
    "Released under GPL v3 or later.", "SPDX-License-Identifier: Apache-2.0 OR MIT",
    "Licensed under the Apache License, Version 2.0 (the License)", "mit der Lizenz",
    "BSD 3-Clause License", "this is free and unencumbered software released into the public domain",
    "CC-BY-NC-SA 4.0 licensed", "gnu general public license, version 2", "under the MIT license, the MIT License",
    "licensed under the terms of the Mozilla Public License v2.0", "distributed under creative commons zero",
    "cc by nc cc by nc", "the license of the apache tribe", "available under the ISC licence",
]


def test_rules_are_many_distinct_and_ordered():
    table = rules()
    assert len(table) >= 300 and len({r.pattern for r in table}) == len(table)
    assert [r.order for r in table] == list(range(len(table)))
    assert all(r.keyword and 0 < r.weight <= 1 for r in table)
    assert literal(r"gnu (?:lesser|library) general public license (?:version |v )?2 1") == \
        "general public license"


def test_the_gate_loses_no_match():
    scanner = L._standard()
    for text in SAMPLES:
        words = scanner.words(text)
        joined = b" ".join(words).decode("latin-1")
        every = {(m.start(), r.order) for r, p in scanner.rules for m in p.finditer(joined)}
        starts = [sum(len(w) + 1 for w in words[:i]) for i in range(len(words))]
        found = {(starts[a], r.order) for a, _, r in scanner.detections(words)}
        assert every <= found, text


def brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+",
                       "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    places = []
    for label, phrase in BASE:
        p = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i:i + len(p)] == p]
    return len(words), places


def check(rows, texts):
    assert len(rows) == len(texts)
    for r in rows:
        n, places = brute(texts[r.doc_id])
        starts = [i for i, _ in places]
        base = sorted({label for _, label in places})
        assert (r.n_words, r.n_base) == (n, len(places))
        assert (r.first_word, r.last_word) == ((min(starts), max(starts)) if starts else (None, None))
        assert r.base_labels == ",".join(base)
        labels = r.labels.split(",") if r.labels else []
        assert set(base) <= set(labels) and labels == sorted(set(labels))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(labels)


def test_base_phrases_against_brute_force(spark, small_sf):
    given = {r.doc_id: r.text for r in spark.read.parquet(f"{small_sf}/documents.parquet").collect()}
    check(L.op6_license_scan(spark, small_sf).collect(), given)
    texts = dict(enumerate([*SAMPLES, None, "", "under the mit license " * 300, "x " * 40_000]))
    rows = docs(spark, [(i, t, "en", "s") for i, t in texts.items()])
    check(L.summary(L.scan(rows)).collect(), texts)


def test_method_labels_and_suppression():
    scanner = L._standard()

    def labels(text):
        words = scanner.words(text)
        return [(a, b, r.label) for a, b, r in scanner.resolve(scanner.detections(words))]

    assert [x[2] for x in labels(SAMPLES[0])] == ["gpl-3"]
    assert [x[2] for x in labels(SAMPLES[2])] == ["apache-2"]       # the longer frame is the same license
    assert labels("mit der Lizenz") == [] and labels("the license of the apache tribe") == []
    assert [x[2] for x in labels("under the MIT License under the MIT License")] == ["mit", "mit"]


def test_edge_rows(spark):
    df = clashing(docs(spark, EDGE))
    out = L.summary(L.scan(df)).collect()
    assert len(out) == len(EDGE)
    assert {r.base_labels for r in out if r.doc_id in (2, 4)} == {"mit"}
    assert all(r.n_words == 0 and r.labels == "" and r.score == 0 for r in out if r.doc_id in (3, 5, 7))
    assert L.scan(df.limit(0)).count() == 0
