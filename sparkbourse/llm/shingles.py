"""Shingles of words as numbers, for whole batches of texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

#: What separates words, after lower-casing.
BREAKS = r"[^\pL\pN]+"
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit numbers (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(texts: pa.Array, size: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about so many bytes together, a longer text alone, so that working arrays stay small."""
    start, held = 0, 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        if held and held + n > size:
            yield start, i
            start, held = i, 0
        held += n + 1
    if start < len(texts):
        yield start, len(texts)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts in order, and where each text's begin (one more entry than texts)."""
    parts = pc.split_pattern_regex(pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), "")), BREAKS)
    words = pc.dictionary_encode(parts.flatten())
    hashes = pd.util.hash_array(words.dictionary.to_numpy(zero_copy_only=False).astype(object), categorize=False)
    ends = np.asarray(parts.offsets, dtype=np.int64)
    ends = ends - ends[0]
    real = np.append(pc.not_equal(words.dictionary, "").to_numpy(zero_copy_only=False), False)
    codes = words.indices.to_numpy()
    there = real[codes]
    before = np.concatenate([[0], np.cumsum(there)])
    return hashes[codes[there]], before[ends]


def shingle_hashes(words: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of each run of ``size`` words; a text of fewer words has one run of all of them."""
    counts = np.diff(at)
    runs = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    text = np.repeat(np.arange(len(counts)), runs)
    first = at[:-1][text] + np.arange(len(text)) - np.repeat(np.cumsum(runs) - runs, runs)
    end, padded = at[1:][text], np.append(words, np.zeros(size, np.uint64))
    total = np.zeros(len(text), np.uint64)
    for j in range(size):
        word = np.where(first + j < end, padded[first + j], np.uint64(j + 1))
        total = mix(total * _ODD + word)
    return total, text


def distinct(hashes: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes by text, the text numbers, and how often each occurs there."""
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    starts = np.flatnonzero(new)
    return hashes[starts], text[starts], np.diff(np.append(starts, len(hashes)))
