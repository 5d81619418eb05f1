"""Byte-level BPE: DuckDB recursive queries inside each partition contract token rows until nothing merges."""

from __future__ import annotations

import base64
import hashlib
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkbourse.llm.chunks import LONGEST_KEPT, slices
from sparkbourse.llm.common import small_batches

RANKS_FILE = "byte_bpe_multi_50k.tiktoken"
#: Words and chunks whose ids a worker remembers, each.
KEEP = 300_000
#: Characters that are encoded, or tokens that are decoded, at once; DuckDB likes many.
AT_ONCE = 3_000_000
#: Words of more bytes are contracted at several places in one step.
LONG = 64
#: A step looks at every pair of neighbours of a word, finds the leftmost one of least rank, and contracts it. Rank, place
#: and the neighbour's place are packed in one number, so that one minimum finds all three.
CONTRACT = """
WITH RECURSIVE step(w, p, t, done) AS (
  SELECT w, p, t, false FROM start
  UNION ALL
  (WITH near AS (
     SELECT w, p, t, lead(w) OVER o AS nw, lead(p) OVER o AS np, lead(t) OVER o AS nt FROM step WHERE NOT done WINDOW o AS (ORDER BY w, p)),
   best AS (
     SELECT n.w, min((CAST(m.z AS BIGINT) << 46) | (CAST(n.p AS BIGINT) << 23) | n.np) AS best
     FROM near n JOIN merges m ON m.l = n.t AND m.r = n.nt WHERE n.w = n.nw GROUP BY n.w)
   SELECT n.w, n.p, CASE WHEN n.p = (best >> 23) & 8388607 THEN CAST(best >> 46 AS INT) ELSE t END, best IS NULL
   FROM near n LEFT JOIN best b ON b.w = n.w WHERE best IS NULL OR n.p <> best & 8388607))
SELECT w, t FROM step WHERE done ORDER BY w, p
"""
#: The same for long words: all places of the least rank at once, every second one where they overlap, if no pair with the
#: merged token has a lower rank; else only the leftmost.
CONTRACT_LONG = """
WITH RECURSIVE step(w, p, t, done) AS (
  SELECT w, p, t, false FROM start
  UNION ALL
  SELECT w, p, coalesce(nt, t), best IS NULL FROM (
    SELECT *, lag(nt) OVER (PARTITION BY w ORDER BY p) AS swallowed FROM (
      SELECT w, p, t, best, CASE WHEN z = best AND
          CASE WHEN safe THEN (i - min(i) OVER (PARTITION BY w, z = best, i - k)) % 2 = 0 ELSE k = 1 END THEN z END AS nt
      FROM (
        SELECT *, row_number() OVER (PARTITION BY w, z = best ORDER BY p) AS k FROM (
          SELECT s.w, s.p, s.t, s.i, m.z, m.safe, min(m.z) OVER (PARTITION BY s.w) AS best
          FROM (SELECT *, lead(t) OVER o AS nx, row_number() OVER o AS i FROM step WHERE NOT done WINDOW o AS (PARTITION BY w ORDER BY p)) s
          LEFT JOIN merges m ON m.l = s.t AND m.r = s.nx))))
  WHERE swallowed IS NULL)
SELECT w, t FROM step WHERE done ORDER BY w, p
"""
#: Bytes as the Latin-1 letters of the same numbers, since strings can be put together in order.
DECODE = "SELECT w, string_agg(letters, '' ORDER BY p) AS letters FROM runs JOIN vocabulary USING (t) GROUP BY w"
#: Stands for an unassigned character while the pattern is matched: a sign that is no letter.
UNASSIGNED = "\ufffc"
_codecs: dict = {}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class _Remembered:
    """Results of distinct keys, found many at a time; what two generations did not ask for is forgotten."""

    def __init__(self, find: Callable[[list], Iterable], keep: int):
        self._find, self._keep, self.now, self._before = find, keep, {}, {}

    def ask(self, keys: set) -> dict:
        """Results of all ``keys``; valid until the next call."""
        if len(self.now) > self._keep:
            self._before, self.now = self.now, {}
        missing = []
        for key in keys:
            if key not in self.now:
                if key in self._before:
                    self.now[key] = self._before[key]
                else:
                    missing.append(key)
        self.now.update(zip(missing, self._find(missing), strict=True))
        return self.now

    def drop_long(self, keys: Iterable) -> None:
        for key in keys:
            if len(key) > LONGEST_KEPT:
                self.now.pop(key, None)


class Codec:
    """Encodes and decodes with the ranks of one file; a match of ``pattern`` is a word, encoded for itself."""

    def __init__(self, path: str, pattern: str, keep: int = KEEP):
        import duckdb
        import regex

        self._ranks = read_ranks(path)
        tokens = {rank: token for token, rank in self._ranks.items()}
        pairs = [
            (self._ranks[token[:i]], self._ranks[token[i:]], rank)
            for token, rank in self._ranks.items()
            for i in range(1, len(token))
            if token[:i] in self._ranks and token[i:] in self._ranks
        ]
        least: dict[int, int] = {}
        for left, right, rank in pairs:
            for part in (left, right):
                least[part] = min(least.get(part, rank), rank)
        left, right, rank = np.array(pairs, np.int32).reshape(-1, 3).T
        safe = np.array([least.get(r, r) >= r for r in rank.tolist()], bool)
        self._db = duckdb.connect(config={"threads": 1, "memory_limit": "600MB", "temp_directory": ""})
        self._load("merges", l=left, r=right, z=rank, safe=safe)
        self._load("vocabulary", t=np.array(list(tokens), np.int32), letters=[t.decode("latin-1") for t in tokens.values()])
        self._byte = np.array([self._ranks.get(bytes([b]), -1) for b in range(256)], np.int32)
        self._matches = regex.compile(pattern).finditer
        self._odd_space, self._cut = re.compile(r"(?<!\S) | (?!\S)").search, re.compile(r"(?<=\S) (?=\S)").split
        self._words, self._chunks = _Remembered(self._encode_words, keep), _Remembered(self._encode_chunks, keep)

    def _load(self, name: str, **columns) -> None:
        self._db.register("given", pa.table(columns))
        self._db.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM given")
        self._db.unregister("given")

    def _contract(self, words: list[bytes], query: str) -> list[bytes]:
        """Ids of distinct words, from rows (word, place, token of one byte)."""
        lengths = np.array([len(w) for w in words])
        first = np.cumsum(lengths) - lengths
        place = np.arange(lengths.sum()) - np.repeat(first, lengths)
        tokens = self._byte[np.frombuffer(b"".join(words), np.uint8)]
        self._load("start", w=np.repeat(np.arange(len(words), dtype=np.int32), lengths), p=place.astype(np.int32), t=tokens)
        done = self._db.sql(query).to_arrow_table()
        ids, word = done.column("t").to_numpy().astype("<u4").tobytes(), done.column("w").to_numpy()
        ends = 4 * np.searchsorted(word, np.arange(len(words) + 1))
        return [ids[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]

    def _encode_words(self, words: list[str]) -> list[bytes]:
        raw = [w.encode() for w in words]
        found = {w: self._ranks[w].to_bytes(4, "little") for w in raw if w in self._ranks}
        for query, some in (
            (CONTRACT, [w for w in raw if w not in found and len(w) <= LONG]),
            (CONTRACT_LONG, [w for w in raw if w not in found and len(w) > LONG]),
        ):
            if some:
                found.update(zip(some, self._contract(some, query), strict=True))
        return [found[w] for w in raw]

    def _match(self, text: str) -> list[str]:
        """Matches of the pattern; characters that Unicode has not assigned are neither letters nor numbers."""
        known = text
        if not text.isascii():
            known = "".join([UNASSIGNED if unicodedata.category(c) == "Cn" else c for c in text])
        return [text[m.start() : m.end()] for m in self._matches(known)]

    def _encode_chunks(self, keys: list[str]) -> list[bytes]:
        """A key is what stands behind the space that begins a chunk, or a newline and the head of a text."""
        parts = []
        for key in keys:
            if key.isalpha():
                parts.append((" " + key,))
            elif key[:-1].isalpha() and key[-1] in ".,":
                parts.append((" " + key[:-1], key[-1]))
            else:
                parts.append(self._match(key[1:] if key[0] == "\n" else " " + key))
        words = set().union(*parts)
        known = self._words.ask(words)
        ids = [b"".join([known[w] for w in part]) for part in parts]
        self._words.drop_long(words)
        return ids

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids, little-endian unsigned 32-bit. Texts are cut before single spaces between visible characters: no match
        reaches over such a place, nor depends on what lies beyond it."""
        cut = [(self._cut(text) if self._odd_space(text) else text.split(" ")) for text in texts]
        for parts in cut:
            parts[0] = "\n" + parts[0]
        distinct = set().union(*cut)
        known = self._chunks.ask(distinct)
        ids = [b"".join(map(known.__getitem__, parts)) for parts in cut]
        self._chunks.drop_long(distinct)
        return ids

    def decode(self, many: list[bytes]) -> list[bytes]:
        """Bytes of lists of ids: token rows join the vocabulary and are put together in order."""
        lengths = np.array([len(ids) // 4 for ids in many], np.int64)
        if not lengths.sum():
            return [b""] * len(many)
        tokens = np.frombuffer(b"".join(many), "<u4").astype(np.int32)
        self._load("runs", w=np.repeat(np.arange(len(many), dtype=np.int32), lengths), p=np.arange(len(tokens), dtype=np.int64), t=tokens)
        found = self._db.sql(DECODE).to_arrow_table()
        whole = dict(zip(found.column("w").to_pylist(), found.column("letters").to_pylist(), strict=True))
        return [whole.get(w, "").encode("latin-1") for w in range(len(many))]


def _codec(path: str | None) -> Codec:
    """One for each worker and file."""
    if path not in _codecs:
        import public_tokenizers

        _codecs[path] = Codec(path or public_tokenizers.path(RANKS_FILE), public_tokenizers.PATTERN)
    return _codecs[path]


def _by_slices(work: Callable[[Codec, list], list[list]], ranks: str | None, kinds: list[tuple[str, pa.DataType]], empty):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks)
        for batch in batches:
            values = [v if v is not None else empty for v in batch.column(1).to_pylist()]
            for a, b in slices(values, AT_ONCE):
                columns = [pa.array(c, k) for c, (_, k) in zip(work(codec, values[a:b]), kinds, strict=True)]
                yield pa.record_batch([batch.column(0).slice(a, b - a), *columns], ["doc_id", *[name for name, _ in kinds]])

    return run


def _texts(docs: DataFrame) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def encode(docs: DataFrame, ranks: str | None = None) -> DataFrame:
    """``doc_id, ids`` for every row of ``docs``: the ids of the whole text, binary, little-endian unsigned 32-bit.

    Null and empty texts have no ids; repeated rows and null ids stay as they are; other columns are not read. ``ranks``
    is the path of the rank file on the executors. Rows never leave their partition.
    """
    return _texts(docs).mapInArrow(_by_slices(lambda c, texts: [c.encode(texts)], ranks, [("ids", pa.binary())], ""), "doc_id long, ids binary")


def decode(encoded: DataFrame, ranks: str | None = None) -> DataFrame:
    """``doc_id, bytes`` for every row of ``encoded(doc_id, ids)``; null ids count as none."""
    small_batches(encoded.sparkSession)
    work = _by_slices(lambda c, ids: [c.decode(ids)], ranks, [("bytes", pa.binary())], b"")
    return encoded.select("doc_id", "ids").mapInArrow(work, "doc_id long, bytes binary")


def round_trip(docs: DataFrame, ranks: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: encodes every text, then decodes the ids again."""

    def work(codec: Codec, texts: list[str]) -> list[list]:
        ids = codec.encode(texts)
        decoded = codec.decode(ids)
        return [[len(i) // 4 for i in ids], [hashlib.sha256(i).hexdigest() for i in ids], [hashlib.sha256(d).hexdigest() for d in decoded]]

    kinds = [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    return _texts(docs).mapInArrow(_by_slices(work, ranks, kinds, ""), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
