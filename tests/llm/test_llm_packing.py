"""Packing against the tokenizer itself and plain checks of every sequence."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sparkbourse.llm import packing
from sparkbourse.llm.wordtokens import WordTokens

PATH = public_tokenizers.path(packing.TOKENIZER_FILE)
WHOLE = Tokenizer.from_file(PATH)
CHUNKED = WordTokens(PATH, keep=50)


def ids_of(text: str) -> list[int]:
    return WHOLE.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("abZ '.,!1é́ß漢Σσς\n\t\x1c İ<|>")) | st.characters(codec="utf-8"), max_size=40))
def test_chunks_give_the_ids_of_the_whole_tokenizer(text):
    assert np.frombuffer(CHUNKED.encode(text), "<u4").tolist() == ids_of(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|", "endoftext", "|>", " ", "hi", "É", "\n"]), max_size=8).map("".join))
def test_strings_of_special_tokens(text):
    assert np.frombuffer(CHUNKED.encode(text), "<u4").tolist() == ids_of(text)
    assert ids_of("<|endoftext|> hi") == [49407, 1883]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60))
def test_rule_is_followed(lengths):
    sequence, offset = packing.sum_of_squares(np.array(lengths, int), 20)
    rooms: dict[int, int] = {}
    for n, s, o in zip(lengths, sequence.tolist(), offset.tolist(), strict=True):

        def cost(to):
            after = dict(rooms)
            after[to] = after.get(to, 20) - n
            counts = np.bincount([r for r in after.values() if 0 < r], minlength=21)
            return int((counts[:20] ** 2).sum())

        choices = [s2 for s2, room in rooms.items() if room >= n] + [max(rooms, default=-1) + 1]
        assert s in choices and o == 20 - rooms.get(s, 20)
        assert cost(s) == min(cost(c) for c in choices)
        rooms[s] = rooms.get(s, 20) - n
        assert rooms[s] >= 0


def check(docs: list[tuple], placed, capacity: int) -> int:
    want = []
    for doc_id, text in docs:
        ids = [*ids_of(text or ""), 0]
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[at : at + capacity], "<u4").tobytes()
            want.append((doc_id is None, doc_id or 0, piece, at, len(part) // 4, zlib.crc32(part)))
    got = [(r.doc_id is None, r.doc_id or 0, r.piece, r.start, r.length, r.ids_crc32) for r in placed]
    assert sorted(got) == sorted(want)
    spans: dict[int, list] = {}
    for r in placed:
        spans.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in spans.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(spans)


def test_odd_rows(spark):
    docs = [(1, "one two three " * 30), (2, None), (3, ""), (None, "no id"), (5, "same"), (5, "same"), (6, "long " * 5000), (7, "x" * 3000)]
    frame = spark.createDataFrame([(*d, "p", 1.0) for d in docs], "doc_id long, text string, piece string, offset double")
    placed = packing.pack(frame, capacity=64, shard_pieces=50).collect()
    check(docs, placed, 64)
    whole = {r.sequence_id: r for r in packing.sequences(frame, packing.pack(frame, capacity=64), capacity=64).collect()}
    assert all(len(r.ids) == 4 * r.n_tokens <= 256 for r in whole.values())
    assert sum(r.n_tokens for r in whole.values()) == sum(len(ids_of(t or "")) + 1 for _, t in docs)


def test_no_rows(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query_packs_tightly(spark):
    from sparkbourse.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    placed = QUERIES["op1_best_fit_packing"](spark, folder).collect()
    sequences = check(docs, placed, 2048)
    assert sequences <= 1.02 * sum(r.length for r in placed) / 2048 + 2
