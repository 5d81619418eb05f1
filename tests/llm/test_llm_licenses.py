"""License scans against exact containment in every window."""

from __future__ import annotations

import re

from sparkbourse.llm import licenses


def words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def pairs(seq: list[str]) -> set:
    return set(zip(seq, seq[1:], strict=False))


def brute(text: str | None) -> set[str]:
    """Licenses some window of which holds a template well enough, less those that a better one overlaps."""
    found = words(text or "")
    best: dict[str, list] = {}
    for name, template in licenses.TEMPLATES:
        want = pairs(words(template))
        n = len(words(template))
        for at in range(0, max(1, len(found)), n):
            inside = found[at : at + 2 * n + 1]
            share = len(pairs(inside) & want) / len(want)
            if share >= licenses.CONTAINMENT:
                best.setdefault(name, []).append((at, share))
    return set(best)


FILLER = "some words of prose that say nothing about rights and go on for a while " * 3


def test_templates_and_variants(spark):
    mit = licenses.TEMPLATES[5][1]
    cut = mit.split()
    rows = [(i, FILLER + t.upper() + " " + FILLER, name) for i, (name, t) in enumerate(licenses.TEMPLATES)]
    rows += [(50, " ".join(cut[:20] + ["changed"] + cut[21:]), "MIT"), (51, None, ""), (52, "", ""), (53, FILLER, ""), (54, " ".join(cut[::-1]), "")]
    rows += [(None, "All rights reserved.", "proprietary"), (55, FILLER * 500 + "Released under the MIT License", "MIT")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, licenses string")
    want = {(r[0], r[2]) for r in rows}
    got = {(r.doc_id, ",".join(sorted({m.license for m in r.licenses}))) for r in licenses.scan(frame).collect()}
    assert got == want
    assert licenses.scan(frame.limit(0)).collect() == []


def test_spans(spark):
    text = "first words here Licensed under CC BY-NC 4.0. then more"
    row = licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [(m.license, m.start_word, m.end_word, m.containment) for m in row.licenses] == [("CC-BY-NC-4.0", 3, 10, 1.0)]


def test_query_misses_nothing(spark):
    from sparkbourse.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op8_license_scans"](spark, folder).collect()
    assert len(rows) == len(texts) and any(r.n_matches for r in rows)
    for r in rows:
        got = set(filter(None, r.licenses.split(",")))
        assert got <= brute(texts[r.doc_id]) and (got or not brute(texts[r.doc_id]))


def test_variants_are_told_apart(spark):
    gnu = "This {} is free software{} you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation{} either version {} of the License, or (at your option) any later version."
    rows = [
        (1, gnu.format("program", ":", "Affero General Public License", ",", "3"), "AGPL-3.0"),
        (2, gnu.format("library", ":", "Lesser General Public License", ",", "3"), "LGPL-3.0"),
        (3, gnu.format("library", ";", "Lesser General Public License", ";", "2.1"), "LGPL-2.1"),
        (4, gnu.format("program", ":", "General Public License", ",", "3"), "GPL-3.0"),
        (5, gnu.format("program", ";", "General Public License", ";", "2"), "GPL-2.0"),
        (6, "Distributed under the Boost Software License, Version 1.0. (See accompanying file)", "BSL-1.0"),
        (7, "This is free and unencumbered software released into the public domain.", "Unlicense"),
    ]
    frame = spark.createDataFrame([(i, FILLER + t + " " + FILLER) for i, t, _ in rows], "doc_id long, text string")
    assert {(r.doc_id, ",".join(sorted({m.license for m in r.licenses}))) for r in licenses.scan(frame).collect()} == {(i, want) for i, _, want in rows}
