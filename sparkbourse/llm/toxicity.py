"""Toxicity by a weighted lexicon: folded text, one pass of an Aho-Corasick automaton, length-normalised weights."""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkbourse.llm.common import small_batches

#: Letters that look like Latin ones, and digits and signs used in their place. Fixed values.
LOOKALIKES = str.maketrans(
    "абвгеёзіїјкмнорѕтухцчьѵԁԛԝαβγεηικνορτυχω0134578@$!|€",
    "abbreesiijkmhopstyxuubvdqwabyenikvoptuxwoieastbasiie",
)
#: Invisible characters inside words are dropped.
INVISIBLE = dict.fromkeys(map(ord, "­​‌‍⁠﻿"))
ASCII_LOOKALIKES = {k: v for k, v in LOOKALIKES.items() if k < 128}
#: Harmless phrases that hold words of a lexicon; hits inside them do not count.
EXCEPTIONS = ("trash can", "trash cans", "trash bag", "clown fish", "idiot proof", "stupid simple", "pond scum")

THRESHOLD = 0.7
#: Labelled documents that the lexicon and its weights are learned from, at most (in expectation).
SAMPLE = 20_000
SHORTEST, LONGEST = 3, 12
#: An entry starts words of so large a share of the toxic sample, and of so many of its documents.
LEAST_SHARE, LEAST_DOCS = 0.005, 3
#: Log-odds of an entry, and how many standard errors they are from zero; entries beyond so many, by documents they
#: tell, are left out.
LEAST_ODDS, LEAST_ERRORS, ENTRIES = 2.5, 3.0, 2000

_letters = re.compile(r"[^\W\d_]+")
_automata: dict = {}


def plain(text: str) -> str:
    """Lower case, compatibility forms such as full-width letters resolved, invisible characters gone."""
    return text.lower() if text.isascii() else unicodedata.normalize("NFKC", text).lower().translate(INVISIBLE)


def unmask(lowered: str) -> str:
    """Look-alike letters, digits and signs turned into the Latin letters they stand for, one for one."""
    return lowered.translate(ASCII_LOOKALIKES if lowered.isascii() else LOOKALIKES)


def fold(text: str) -> str:
    return unmask(plain(text))


@dataclass(frozen=True)
class Lexicon:
    """Word beginnings with weights, phrases that excuse them, and how a weight sum becomes a score."""

    entries: tuple[tuple[str, float], ...]
    exceptions: tuple[str, ...] = EXCEPTIONS
    offset: float = -4.0
    slope: float = 1.0

    def automaton(self):
        if self not in _automata:
            import ahocorasick

            made = ahocorasick.Automaton()
            for phrase in self.exceptions:
                made.add_word(fold(phrase), (len(fold(phrase)), None))
            for number, (word, _) in enumerate(self.entries):
                made.add_word(word, (len(word), number))
            if len(made):
                made.make_automaton()
            _automata.clear()
            _automata[self] = made
        return _automata[self]

    def weight(self, text: str) -> float:
        """Sum of the weights of the words hit, each further hit of an entry counting less, over the length's root."""
        automaton = self.automaton()
        if not len(automaton):
            return 0.0
        seen, hits, excused = plain(text), [], []
        for last, (length, number) in automaton.iter(unmask(seen)):
            first = last - length + 1
            if first and seen[first - 1].isalpha():
                continue  # not at the beginning of a word
            if number is not None:
                hits.append((first, number))
            elif last + 1 == len(seen) or not seen[last + 1].isalpha():
                excused.append((first, last))
        at: dict[int, int] = {}  # of several entries from one place, the heaviest
        for first, number in hits:
            if any(a <= first <= b for a, b in excused):
                continue
            if first not in at or self.entries[number][1] > self.entries[at[first]][1]:
                at[first] = number
        total = sum(self.entries[number][1] * (1 + math.log(n)) for number, n in Counter(at.values()).items())
        return total / length_norm(len(seen))

    def score(self, text: str) -> float:
        return 1.0 / (1.0 + math.exp(-max(-700.0, min(700.0, self.offset + self.slope * self.weight(text)))))


def length_norm(chars: int) -> float:
    """Slow growth: one insult in a long text still tells, many harmless words dilute it a little."""
    return 1.0 + math.log1p(chars / 1000.0) / 4.0


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def _beginnings(words: set[str]) -> set[str]:
    return {w[:n] for w in words for n in range(SHORTEST, min(LONGEST, len(w)) + 1)}


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The smallest and the largest hash of five folded words, which near copies share."""
    import xxhash

    for batch in batches:
        ends = []
        for text in batch.column("text").to_pylist():
            words = _letters.findall(fold(text or ""))
            runs = [xxhash.xxh64_intdigest(" ".join(words[i : i + 5])) >> 1 for i in range(max(1, len(words) - 4))]
            ends.append((min(runs), max(runs)))
        sketches = [pa.array([e[i] for e in ends], pa.int64()) for i in (0, 1)]
        yield pa.record_batch([batch.column("text"), batch.column("toxic"), *sketches], ["text", "toxic", "least", "most"])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents by word beginning, toxic and others; the empty beginning counts all."""
    toxic, others = Counter(), Counter()
    for batch in batches:
        for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            (toxic if label else others).update(_beginnings(set(_letters.findall(fold(text or "")))) | {""})
    keys = list(toxic.keys() | others.keys())
    yield pa.record_batch([pa.array(keys, pa.string()), pa.array([toxic[k] for k in keys], pa.int64()), pa.array([others[k] for k in keys], pa.int64())], ["start", "toxic", "others"])


def training_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Texts and labels to learn from: rows that aren't held out, about ``sample`` of them, one of each group of copies.

    A document with several labels is toxic if one says so; null labels and ids are left out. Only ids of the sample are
    broadcast. Of documents with the same smallest or the same largest hash of five words, which is how near copies show, one stays.
    """
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    usable = usable.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = min(1.0, sample / max(1, usable.count()))
    chosen = usable.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = texts.join(F.broadcast(chosen), "doc_id").select("text", "toxic")
    sketched = rows.mapInArrow(_sketch, "text string, toxic int, least long, most long")
    once = sketched.groupBy("least", "toxic").agg(F.min(F.struct("text", "most")).alias("one"))
    return once.groupBy("one.most", "toxic").agg(F.min("one.text").alias("text")).select("text", "toxic")


def choose_entries(counts: list[tuple[str, int, int]], toxic: int, others: int) -> tuple[tuple[str, float], ...]:
    """The lexicon out of counts by word beginning: of a chain of beginnings the longest that loses no documents."""
    told = {start: n for start, n, _ in counts}
    odds = {start: math.log((a + 0.5) / (toxic + 1)) - math.log((b + 0.5) / (others + 1)) for start, a, b in counts}
    kept = []
    for start in sorted(told, key=lambda s: (len(s), s)):
        if any(start[:n] in odds and told[start] < 0.95 * told[start[:n]] and odds[start[:n]] > odds[start] - 0.7 for n in range(SHORTEST, len(start))):
            continue  # a shorter beginning that is as telling covers it
        kept.append(start)
    longest = {s for s in kept if not any(t != s and t.startswith(s) and told[t] >= 0.95 * told[s] for t in kept)}
    return tuple((s, odds[s]) for s in sorted(longest, key=lambda s: (-told[s] * odds[s], s))[:ENTRIES])


def fit_line(weights: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Offset and slope of a logistic curve, with a light pull towards zero slope; Newton steps."""
    at = np.array([-4.0, 1.0])
    if not len(weights) or toxic.min() == toxic.max():
        return float(at[0]), float(at[1])
    seen, pull = np.column_stack([np.ones(len(weights)), weights]), np.diag([1e-3, 0.05])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(seen @ at, -30, 30)))
        slope = seen.T @ (toxic - p) - pull @ at
        step = np.linalg.solve((seen * (p * (1 - p))[:, None]).T @ seen + pull, slope)
        at = at + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(at[0]), max(0.0, float(at[1]))


def learn(docs: DataFrame, labels: DataFrame, exceptions: tuple[str, ...] = EXCEPTIONS, sample: int = SAMPLE) -> Lexicon:
    """Learn lexicon and curve from a bounded sample of labelled rows that aren't held out.

    What reaches the driver is bounded by ``sample``: candidate entries and one weight per document. Without toxic rows
    the lexicon is empty and all scores are equal.
    """
    from sparkbourse.session import release, stage

    small_batches(docs.sparkSession)
    rows = stage(training_sample(docs, labels, sample), "labelled")
    counted = rows.mapInArrow(_count, "start string, toxic long, others long")
    counts = stage(counted.groupBy("start").agg(F.sum("toxic").alias("toxic"), F.sum("others").alias("others")), "beginnings")
    total = counts.filter("start = ''").first()
    toxic, others = (total["toxic"], total["others"]) if total else (0, 0)
    ratio = (F.col("toxic") + 0.5) * (others + 1) / ((F.col("others") + 0.5) * (toxic + 1))
    error = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("others") + 0.5))
    enough = (F.col("toxic") >= max(LEAST_DOCS, LEAST_SHARE * toxic)) & (F.log(ratio) >= LEAST_ODDS) & (F.log(ratio) >= LEAST_ERRORS * error)
    likely = counts.filter((F.col("start") != "") & enough)
    found = likely.orderBy(F.desc(F.col("toxic") * F.log(ratio)), "start").limit(20 * ENTRIES).collect()
    lexicon = Lexicon(choose_entries([tuple(r) for r in found], toxic, others), exceptions)
    weigh = F.pandas_udf(lambda texts: pd.Series([lexicon.weight(t or "") for t in texts], dtype="float64"), T.DoubleType())
    points = rows.select("toxic", weigh("text").alias("weight")).collect()
    offset, slope = fit_line(np.array([p["weight"] for p in points]), np.array([float(p["toxic"]) for p in points]))
    release(rows, counts)
    return Lexicon(lexicon.entries, exceptions, offset, slope)


def score_of(lexicon: Lexicon, text: Column) -> Column:
    """Score from 0 to 1 of whole texts; null counts as empty."""

    def scores(texts: pd.Series) -> pd.Series:
        return pd.Series([lexicon.score(t or "") for t in texts], dtype="float64")

    return F.pandas_udf(scores, T.DoubleType())(F.coalesce(text.cast("string"), F.lit("")))


def score(docs: DataFrame, lexicon: Lexicon, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` for every row of ``docs``; nothing but the text is scored."""
    small_batches(docs.sparkSession)
    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(doc_id.alias("doc_id"), held_out(doc_id).alias("held_out"), score_of(lexicon, F.col("text")).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_clean(docs: DataFrame, lexicon: Lexicon, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is under ``threshold``."""
    small_batches(docs.sparkSession)
    return docs.filter(score_of(lexicon, F.col("text")) < threshold)
