"""Chat formatting with a grammar that reads its own output back."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkbourse.llm.common import small_batches

#: What stands before and after a turn's text, by role. Any other role is named in its opening mark.
MARKS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
OTHER = ("<role=", "</role>")
LEARNED = "assistant"
#: A mark, or one that already has backslashes behind its first character.
CONFLICT = re.compile(r"(?:<(\\*)(?=<SYS>>|</SYS>>|s>|/s>|role=|/role>)|\[(\\*)(?=INST\]|/INST\]))")


def escape(text: str) -> str:
    """One backslash more behind the first character of every mark."""
    return CONFLICT.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    """One backslash less behind the first character of marks that have any."""
    return CONFLICT.sub(lambda m: m[0][:-1] if len(m[0]) > 1 else m[0], text)


def wrap(role: str, body: str) -> str:
    if role in MARKS:
        return MARKS[role][0] + body + MARKS[role][1]
    return f"{OTHER[0]}{quote(role, safe='')}>{body}{OTHER[1]}"


def parse(text: str) -> Iterator[tuple[str, str, int, int]]:
    """Role, text, and where the escaped text begins and ends, of every turn; fails on anything else."""
    at = 0
    while at < len(text):
        for role, (opening, closing) in MARKS.items():
            if text.startswith(opening, at):
                first = at + len(opening)
                break
        else:
            if not text.startswith(OTHER[0], at):
                raise ValueError(f"no turn begins at {at}")
            closing, named = OTHER[1], text.index(">", at)
            role, first = unquote(text[at + len(OTHER[0]) : named]), named + 1
        last = text.index(closing, first)
        yield role, unescape(text[first:last]), first, last
        at = last + len(closing)


def render(role: str | None, text: str | None) -> str:
    """A turn as the grammar reads it back: a text that holds any mark is escaped, and again until the same turn comes back."""
    role, text = role or "", text or ""
    body = escape(text)
    for _ in range(3):
        rendered = wrap(role, body)
        try:
            turns = [turn[:2] for turn in parse(rendered)]
        except ValueError:
            turns = []
        if turns == [(role, text)]:
            return rendered
        body = escape(body)
    raise ValueError("a turn could not be escaped")


def _render_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        turns = [render(r, t) for r, t in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True)]
        spans = [next(parse(t)) for t in turns]
        learned = [(first, last) if role == LEARNED else (None, None) for role, _, first, last in spans]
        columns = [batch.column("conv_id"), batch.column("turn"), pa.array(turns, pa.string())]
        columns += [pa.array([x[i] for x in learned], pa.int64()) for i in (0, 1)]
        yield pa.record_batch(columns, ["conv_id", "turn", "formatted", "loss_start", "loss_end"])


def format_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, formatted, loss_start, loss_end`` for every row; a conversation's text is its turns' in order.

    The loss mask covers an assistant's text as it is escaped, in code points of the turn, end exclusive; other roles
    have none. Null text and null role count as empty. Rows never leave their partition; other columns are not read.
    """
    small_batches(conversations.sparkSession)
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_render_rows, "conv_id long, turn long, formatted string, loss_start long, loss_end long")


class _Reading:
    """One conversation, read turn by turn."""

    def __init__(self, conv_id):
        self.conv_id, self.turns, self.loss, self.n, self.loss_chars, self.chars = conv_id, hashlib.sha256(), hashlib.sha256(), 0, 0, 0

    def add(self, formatted: str, loss_start: int | None, loss_end: int | None) -> None:
        for role, text, _, _ in parse(formatted):
            self.n += 1
            self.turns.update(f"{role}\n{text}\n".encode())
        if loss_start is not None:
            learned = unescape(formatted[loss_start:loss_end])
            self.loss.update(learned.encode())
            self.loss_chars += len(learned)
        self.chars += len(formatted)

    def row(self) -> tuple:
        return self.conv_id, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    reading, done = None, []
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("conv_id", "formatted", "loss_start", "loss_end")]
        for conv_id, formatted, loss_start, loss_end in zip(*columns, strict=True):
            if reading is None or reading.conv_id != conv_id:
                if reading is not None:
                    done.append(reading.row())
                reading = _Reading(conv_id)
            reading.add(formatted, loss_start, loss_end)
        if len(done) >= 1000:
            yield out(done)
            done = []
    if reading is not None:
        yield out([*done, reading.row()])


def digests(formatted: DataFrame) -> DataFrame:
    """What can be read back from ``format_turns``, a row for each conversation: counts and digests, turns in order.

    Rows of one turn number are in the order of their formatted text; null numbers come first, and null conversation ids
    are one conversation. SHA-256 takes one byte after the other, so a conversation is read by one task; its rows come
    sorted and streamed, and the task holds one batch and the state of the hashes, however long it is.
    """
    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "formatted")
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return ordered.mapInArrow(_read_back, schema)


def sql(more: list[tuple[int, int, str, str]]) -> str:
    """The rows of ``digests`` for a table with the three known roles and one row per turn, as DuckDB SQL; ``more`` rows
    are added to it. Every mark in a text, escaped before or not, gets one backslash."""
    added = " ".join(f"UNION ALL SELECT {c}, {t}, '{r}', '{x}'" for c, t, r, x in more)
    marks = "<{n}(?:<SYS>>|</SYS>>|s>|/s>|role=|/role>)|\\[{n}(?:INST\\]|/INST\\])"
    around = " ".join(f"WHEN '{role}' THEN {len(a) + len(b)}" for role, (a, b) in MARKS.items())
    return f"""
WITH rows AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations {added}),
turns AS (
  SELECT *, length(text) + CASE role {around} END + len(regexp_extract_all(text, '{marks.format(n="[\\\\]*")}')) AS chars
  FROM rows)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = '{LEARNED}'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = '{LEARNED}'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""
