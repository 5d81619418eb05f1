"""Folding, matching and what is learned."""

from __future__ import annotations

import math
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sparkbourse.llm import toxicity
from sparkbourse.llm.queries import QUERIES

LEXICON = toxicity.Lexicon((("idiot", 5.0), ("trash", 4.0)), offset=-4.0, slope=2.0)


@pytest.mark.parametrize("word", ["idiot", "IDIOT!", "1d10t", "іdіоt", "ｉｄｉｏｔ", "id​iot", "!d!0t", "idiots", '"idiot"'])
def test_disguises(word):
    assert LEXICON.score(f"you {word} there") >= 0.7


@pytest.mark.parametrize("text", ["", "fine words", "a trash can", "Trash Bag.", "my idiot proof plan", "nonidiotic"])
def test_harmless(text):
    assert LEXICON.score(text) < 0.1


def test_longer_texts_score_lower_but_still_tell():
    short, long = LEXICON.weight("idiot"), LEXICON.weight("idiot " + "fine words " * 5000)
    assert 0 < long < short and LEXICON.score("trash can, you idiot") >= 0.7


WIDE = toxicity.Lexicon((("idio", 3.0), ("idiot", 5.0), ("trash", 4.0), ("can", 1.5), ("rash", 2.5)), offset=-4.0, slope=2.0)


def plain_weight(lexicon: toxicity.Lexicon, text: str) -> float:
    """Every place against every phrase and entry."""
    seen = toxicity.plain(text)
    folded, excused, hits = toxicity.unmask(seen), set(), {}
    starts = [i for i in range(len(seen)) if not i or not seen[i - 1].isalpha()]
    for i in starts:
        for phrase in map(toxicity.fold, lexicon.exceptions):
            end = i + len(phrase)
            if folded.startswith(phrase, i) and (end == len(seen) or not seen[end].isalpha()):
                excused |= set(range(i, end))
    for i in starts:
        fitting = [(w, word) for word, w in lexicon.entries if folded.startswith(word, i)]
        if i not in excused and fitting:
            hits.setdefault(max(fitting), []).append(i)
    total = sum(w * (1 + math.log(len(places))) for (w, _), places in hits.items())
    return total / toxicity.length_norm(len(seen))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["idiot", "1D10T", "idio", "trash", "Trash can", "can", "rash", " ", ".", "іdіоt", "ｃａｎ", "proof", "idiot proof", "x", "\u200b", "s"]), max_size=12).map("".join))
def test_weight_is_that_of_plain_loops(text):
    assert math.isclose(WIDE.weight(text), plain_weight(WIDE, text), abs_tol=1e-12)


def test_chain_of_beginnings():
    counts = [("badw", 30, 0), ("badwo", 30, 0), ("badwor", 30, 0), ("badword", 29, 0), ("badworda", 3, 0)]
    assert [w for w, _ in toxicity.choose_entries(counts, 100, 1000)] == ["badword"]


def labelled(spark, n=400):
    rows = [(i, f"clean words number {i} " * 5 + ("you absolute grumbler" if i % 4 == 0 else "good day")) for i in range(n)]
    docs = spark.createDataFrame([*rows, (None, None), (5000, None), (5001, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0, int(i % 4 == 0)) for i in range(n)] + [(None, 0, 1), (7, 0, None)], "doc_id long, quality int, toxic int")
    return docs, labels


def test_learns_only_from_rows_that_are_not_held_out(spark):
    docs, labels = labelled(spark)
    held = toxicity.held_out(labels["doc_id"])
    flipped = labels.withColumn("toxic", toxicity.F.when(held, 1 - labels["toxic"]).otherwise(labels["toxic"]))
    lexicon = toxicity.learn(docs, labels)
    assert lexicon == toxicity.learn(docs, flipped)
    assert any(w.startswith("grumb") for w, _ in lexicon.entries)
    rows = toxicity.score(docs, lexicon).collect()
    assert len(rows) == 403
    for r in rows:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert r.predicted == int(r.doc_id is not None and r.doc_id < 400 and r.doc_id % 4 == 0)
    assert toxicity.keep_clean(docs, lexicon).count() == 303


def test_nothing_to_learn_from(spark):
    docs, labels = labelled(spark, 20)
    lexicon = toxicity.learn(docs, labels.limit(0))
    assert lexicon.entries == () and {r.predicted for r in toxicity.score(docs, lexicon).collect()} == {0}
    assert toxicity.score(docs.limit(0), toxicity.learn(docs.limit(0), labels)).collect() == []


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op10_toxicity"](spark, folder).collect() if r.held_out and r.doc_id in labels]
    toxic = [r for r in rows if labels[r.doc_id]]
    clean = [r for r in rows if not labels[r.doc_id]]
    # About one label in twenty has no insult to show for it.
    assert sum(r.predicted for r in toxic) >= 0.88 * len(toxic)
    assert sum(r.predicted for r in clean) <= 0.01 * len(clean)
