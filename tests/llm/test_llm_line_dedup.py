"""Chunks of lines against plain Python."""

from __future__ import annotations

import hashlib
import random

import pytest

from sparkbourse.llm import line_dedup


def chunks(text: str) -> list[list[str]]:
    lines, done = text.split("\n"), [[]]
    hashes = [int(hashlib.md5(line.encode()).hexdigest()[:8], 16) for line in lines]
    for i, line in enumerate(lines):
        done[-1].append(line)
        if i and (hashes[i - 1] * line_dedup.ROLL + hashes[i]) % line_dedup.MEAN_LINES == 0 and i < len(lines) - 1:
            done.append([])
    return done


def brute(docs: list[tuple]) -> dict:
    seen, done = set(), {}
    for doc_id, text in sorted(docs):
        if text is None:
            done[doc_id] = (None, 0, 0, 0)
            continue
        kept, gone = [], []
        for chunk in chunks(text):
            body = "\n".join(chunk)
            if len(chunk) >= 2 and body.strip() and body in seen:
                gone.append(chunk)
            else:
                kept.append(body)
            seen.add(body)
        done[doc_id] = ("\n".join(kept), len(gone), sum(map(len, gone)), sum(len("\n".join(c)) for c in gone))
    return done


def made() -> list[tuple]:
    rng = random.Random(4)
    lines = [f"line {i} é" for i in range(60)]
    passage = [f"shared {i}" for i in range(12)]
    docs: list[tuple] = []
    for i in range(80):
        own = rng.choices(lines, k=rng.randint(0, 15))
        at = rng.randint(0, len(own))
        docs.append((i, "\n".join(own[:at] + (passage if i % 3 == 0 else []) + own[at:])))
    return [*docs, (100, None), (101, ""), (102, "\n\n\n\n\n\n"), (103, "\n\n\n\n\n\n"), (104, docs[5][1]), (105, "\n".join(passage * 500)), (106, "one\r\ntwo\r\n" * 4)]


@pytest.mark.parametrize("hash_values", [None, 3])
def test_against_plain_loops(spark, hash_values):
    docs = made()
    frame = spark.createDataFrame([(*d, 7, "k", "t") for d in docs], "doc_id long, text string, lines_removed int, k string, t string")
    cut = line_dedup.remove_repeats(frame, hash_values=hash_values)
    assert cut.columns == [*frame.columns, "chunks_removed", "_lines_removed", "chars_removed"]
    got = {r.doc_id: (r.text, r.chunks_removed, r._lines_removed, r.chars_removed) for r in cut.collect()}
    assert got == brute(docs)
    assert any(v[1] for v in got.values())


def test_very_many_lines(spark):
    rng = random.Random(2)
    lines = [f"{rng.randrange(10**9)} x" for _ in range(200_000)]
    other = lines[:90_000] + [f"own {i}" for i in range(20_000)] + lines[100_000:]
    docs = [(1, "\n".join(lines)), (2, "\n".join(other))]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: (r.text, r.chunks_removed, r.lines_removed, r.chars_removed) for r in line_dedup.remove_repeats(frame).collect()}
    assert got == brute(docs) and got[2][2] > 150_000


def test_repeated_rows_and_null_ids(spark):
    text = "\n".join(f"l{i}" for i in range(20))
    frame = spark.createDataFrame([(1, text), (1, text), (None, text), (2, text)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.text == text) for r in line_dedup.remove_repeats(frame).collect())
    assert got == [(0, True), (1, False), (1, False), (2, False)]


def test_no_rows_and_no_python(spark, capsys):
    cut = line_dedup.remove_repeats(spark.createDataFrame([], "doc_id long, text string"))
    assert cut.collect() == []
    cut.explain("formatted")
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan
