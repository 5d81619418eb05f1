"""Quality rules: word counts, repeats, and bands of zstandard ratios that depend on the length."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkbourse.llm.common import small_batches

#: What separates words, and what counts as a symbol.
SPACES, SYMBOLS = b"\t\n\x0b\x0c\r ", b"#*$%&|<>"
MIN_WORDS, MAX_REPEATED_PERCENT, WINDOW = 50, 50, 3
_INSIDE = bytes(range(0x80, 0xC0))  # bytes of UTF-8 that do not begin a code point
_SPACE = re.compile(b"[" + SPACES + b"]")


@dataclass(frozen=True)
class Band:
    """Least and largest ratio of compressed to plain bytes of texts with fewer than ``below`` bytes."""

    below: float
    least: float
    largest: float


#: Prose of whatever script lies well inside: it compresses to 0.5 to 0.75 at half a kilobyte and to 0.35 to 0.5 at some tens
#: of kilobytes. Below two thirds of that a text says much of it again and again; far above it, it holds next to no language
#: (base64: 0.76). Under 256 bytes the ratio tells nothing yet.
BANDS = (
    Band(256, 0.0, float("inf")),
    Band(512, 0.40, 1.0),
    Band(1024, 0.37, 0.88),
    Band(2048, 0.34, 0.78),
    Band(4096, 0.31, 0.72),
    Band(16384, 0.28, 0.69),
    Band(65536, 0.25, 0.67),
    Band(float("inf"), 0.22, 0.66),
)
CHUNK, LEVEL = 4096, 3
#: A text goes if more than this share of its bytes lies in chunks outside their band.
MAX_BAD_SHARE = 0.3

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_bytes", "n_chunks", "bad_chunk_bytes"]


class _Numbers(dict):
    """Numbers in order of first sight."""

    def __missing__(self, key: bytes) -> int:
        number = self[key] = len(self)
        return number


def _words(data: bytes, size: int = 1 << 20) -> np.ndarray:
    """A number for each word, equal for equal words; the words of about a megabyte exist at a time."""
    numbers, parts, start = _Numbers(), [], 0
    while start < len(data):
        gap = _SPACE.search(data, start + size)
        end = gap.start() if gap else len(data)
        parts.append(np.fromiter(map(numbers.__getitem__, data[start:end].split()), np.int64))
        start = end
    return np.concatenate(parts) if parts else np.empty(0, np.int64)


def repeated_words(words: np.ndarray, window: int = WINDOW) -> int:
    """Words that lie in a run of ``window`` words found twice or more, its first place included."""
    runs = len(words) - window + 1
    if runs < 2:
        return 0
    seen = words[:runs]
    for j in range(1, window):  # numbers stay below the number of words, so that the pairs are exact
        seen = np.unique(seen * len(words) + words[j : j + runs], return_inverse=True)[1]
    again = np.bincount(seen)[seen] > 1
    edges = np.zeros(len(words) + 1, np.int64)
    edges[:runs] += again
    edges[window : window + runs] -= again
    return int(np.count_nonzero(np.cumsum(edges[:-1])))


def band_of(length: int, bands: Sequence[Band] = BANDS) -> Band:
    return next(b for b in bands if length < b.below)


def _fits(band: Band, ratio: float) -> bool:
    return band.least <= ratio <= band.largest


def measure(data: bytes, bands: Sequence[Band], chunk: int, compress) -> tuple:
    """The ``MEASURES`` of a text, the ratio of the whole, and whether that lies in its band."""
    words = _words(data)
    lines = [line for line in data.split(b"\n") if line.strip()]
    n = len(data)
    counts = (
        len(words),
        len(data.translate(None, SPACES + _INSIDE)),
        n - len(data.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )
    ratio = len(compress(data)) / n if n else None
    bad, starts = 0, range(0, n, chunk)
    for start in starts:
        part = data[start : start + chunk]
        if not _fits(band_of(len(part), bands), len(compress(part)) / len(part)):
            bad += len(part)
    return *counts, n, len(starts), bad, ratio, ratio is None or _fits(band_of(n, bands), ratio)


def _measured(bands: Sequence[Band], chunk: int, level: int):
    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(level=level, write_checksum=False, write_content_size=False).compress
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            rows = [measure(text.as_py() or b"", bands, chunk, compress) for text in texts]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * (len(MEASURES) + 2)
            kinds = [pa.int64()] * len(MEASURES) + [pa.float64(), pa.bool_()]
            found = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.record_batch([batch.column("doc_id"), *found], ["doc_id", *MEASURES, "ratio", "in_band"])

    return measured


def judge(
    docs: DataFrame,
    bands: Sequence[Band] = BANDS,
    chunk: int = CHUNK,
    level: int = LEVEL,
    max_bad_share: float = MAX_BAD_SHARE,
    min_words: int = MIN_WORDS,
    max_repeated_percent: int = MAX_REPEATED_PERCENT,
) -> DataFrame:
    """``doc_id``, the ``MEASURES``, ``ratio``, ``in_band``, ``base_failed``, ``kept``: a row for every row of ``docs(doc_id, text)``.

    Words are runs of anything but ASCII white space. A row fails the base rules with fewer than ``min_words`` words, or if
    more than ``max_repeated_percent`` of them lie in three-word runs that occur again in the text. Of the others a row is
    kept if the zstandard ratio of the whole text lies in the band for its length, and the chunks of ``chunk`` bytes, the
    last one shorter, that lie outside the band for theirs make up no more than ``max_bad_share`` of the bytes.

    A null text counts as an empty one: no words, no ratio, base rules failed. Repeated rows are judged each by itself, null
    ids are passed on, other columns are not looked at, no rows give no rows. A row's verdict rests on its text alone, so
    there is no shuffle; a task holds one batch, and of a long text its bytes and a number for each word.
    """
    small_batches(docs.sparkSession, 200)
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    longs = ", ".join(f"{c} long" for c in MEASURES)
    found = read.mapInArrow(_measured(tuple(bands), chunk, level), f"doc_id long, {longs}, ratio double, in_band boolean")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeated_percent * F.col("n_words"))
    fits = F.col("in_band") & (F.col("bad_chunk_bytes") <= max_bad_share * F.col("n_bytes"))
    return found.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & fits)

