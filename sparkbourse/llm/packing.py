"""Packing of token sequences by the sum-of-squares rule."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkbourse.llm.common import small_batches
from sparkbourse.session import stage

TOKENIZER_FILE = "word_bpe_49k.json"
CAPACITY = 2048
#: Pieces that are packed together; more shards cost a part of a sequence each.
SHARD_PIECES = 32_768
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_encoders: dict = {}


def _encoder(path: str | None):
    """One for each worker and file; what it remembers helps later tasks too."""
    if path not in _encoders:
        from sparkbourse.llm.wordtokens import WordTokens

        if path is None:
            import public_tokenizers

            _encoders[path] = WordTokens(public_tokenizers.path(TOKENIZER_FILE))
        else:
            _encoders[path] = WordTokens(path)
    return _encoders[path]


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """A row for each piece of each document: its ids, ``end_id`` behind them, cut after every ``capacity`` tokens.

    ``tokenizer`` is the path of the tokenizer's file on the executors. A null text counts as empty and gives one piece
    with ``end_id`` alone. Whole texts are tokenised, however long. With ``with_ids`` the ids come along as binary,
    little-endian unsigned 32-bit. Columns of ``docs`` but ``doc_id`` and ``text`` are not read.
    """
    small_batches(docs.sparkSession)
    end = end_id.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        for batch in batches:
            rows = [[] for _ in range(6)]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encoder.encode(text.as_py() or "") + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    for column, value in zip(rows, (doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part), part), strict=True):
                        column.append(value)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            n = 5 + with_ids
            yield pa.record_batch([pa.array(r, k) for r, k in zip(rows[:n], kinds[:n], strict=True)], names[:n])

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return read.mapInArrow(cut, PIECES + ", ids binary" * with_ids)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset for each length, in the given order; lengths are from 1 to ``capacity``.

    ``open_at[g]`` counts the open sequences with room for g more tokens. Each length goes where the sum of the squares
    of these counts becomes smallest, a fresh sequence included; among equal ones, where the least room is left.
    """
    open_at = np.zeros(capacity + 1, np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence, offset, made = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    never = np.iinfo(np.int64).max // 2
    for i, length in enumerate(lengths.tolist()):
        gains = 2 * open_at[: capacity - length + 1] + 1  # one more with so much room left
        gains[0] = 0  # a full sequence isn't open
        losses = np.where(open_at[length:] > 0, 1 - 2 * open_at[length:], never)
        losses[-1] = 0  # a fresh one was not open
        left = int(np.argmin(gains + losses))
        room = left + length
        if room == capacity:
            at, made = made, made + 1
        else:
            at = by_room[room].pop()
            open_at[room] -= 1
        if left:
            open_at[left] += 1
            by_room[left].append(at)
        sequence[i], offset[i] = at, capacity - room
    return sequence, offset


def _pack_shard(capacity: int):
    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True], kind="stable")
        sequence, offset = sum_of_squares(rows["length"].to_numpy(), capacity)
        return rows.assign(sequence_id=rows["shard"] * (1 << 40) + sequence, offset=offset).drop(columns="shard")

    return pack


def shard_of(row_number: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(row_number), F.lit(shards)).cast("long")


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Place all pieces of all documents in sequences of at most ``capacity`` tokens.

    Pieces are written once, dealt evenly over shards of about ``shard_pieces`` and packed shard by shard, longest first.
    Which shard a piece is in follows from its row in the written table, so that copies spread and a repeated task does
    the same. ``sequence_id`` is unique over shards; offsets in a sequence are gapless from 0. Every row of ``docs``
    counts, also one that repeats another. No documents give no rows.
    """
    pieces = stage(token_pieces(docs, capacity, tokenizer), "pieces")
    shards = max(1, -(-pieces.count() // shard_pieces))
    dealt = pieces.withColumn("shard", shard_of(F.monotonically_increasing_id(), shards))
    return dealt.groupBy("shard").applyInPandas(_pack_shard(capacity), PIECES + ", sequence_id long, offset long")


def sequences(docs: DataFrame, placed: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """The packed sequences themselves: ``sequence_id``, ``ids`` (binary) and ``n_tokens``, at most ``capacity``.

    Joins what ``pack`` placed to the ids of the same documents; equal pieces of repeated rows have equal ids.
    """
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    ids = token_pieces(docs, capacity, tokenizer, with_ids=True).dropDuplicates(key)
    same = [placed[k].eqNullSafe(ids[k]) for k in key]
    parts = placed.join(ids, same).select("sequence_id", "offset", placed["length"], "ids")
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    whole = F.aggregate(ordered, F.lit(b""), lambda done, part: F.concat(done, part["ids"]))
    return parts.groupBy("sequence_id").agg(whole.alias("ids"), F.sum("length").alias("n_tokens"))
