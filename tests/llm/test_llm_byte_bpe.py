"""Recursive contraction against the tiktoken library."""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from sparkbourse.llm import byte_bpe

PATH = public_tokenizers.path(byte_bpe.RANKS_FILE)
CODEC = byte_bpe.Codec(PATH, public_tokenizers.PATTERN, keep=40)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(PATH), special_tokens={})
ODD = ["", " ", "  a  b ", "a\n\n b\t c \n", "x\x1c y", "don't I'll", "a" * 500, "漢字 かな 😀👍🏽 é é", "<|endoftext|> 12 345", "tail ", " \n x"]


def ids(text: str) -> list[int]:
    return LIBRARY.encode_ordinary(text)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab' s.1\n\t\x1fé漢 ")) | st.characters(codec="utf-8"), max_size=40), max_size=5))
def test_texts(texts):
    got = CODEC.encode(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [ids(t) for t in texts]
    assert CODEC.decode(got) == [t.encode() for t in texts]


@pytest.mark.parametrize("word", ["ab" * 300, "qwertzuiopasdfghjklyxcvbnm" * 12, "-" * 999, "Ünterschiedsgröße" * 20])
def test_long_words(word):
    assert np.frombuffer(CODEC.encode([word])[0], "<u4").tolist() == ids(word)


def test_rows(spark):
    texts = [*ODD, None, "same", "same", "word " * 20000]
    rows = [(i if i % 4 else None, t, "x") for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = byte_bpe.round_trip(frame).collect()

    def digest(b):
        return hashlib.sha256(b).hexdigest()

    want = [(i, len(ids(t or "")), digest(np.array(ids(t or ""), "<u4").tobytes()), digest((t or "").encode())) for i, t, _ in rows]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    encoded = byte_bpe.encode(frame)
    assert sorted(bytes(r.bytes).decode() for r in byte_bpe.decode(encoded).collect()) == sorted(t or "" for t in texts)
    assert byte_bpe.round_trip(frame.limit(0)).collect() == []
