"""The grammar reads back what it wrote."""

from __future__ import annotations

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from sparkbourse.llm import chat
from sparkbourse.llm.queries import HOSTILE, QUERIES

PIECES = st.sampled_from(["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<role=", "</role>", "\\", "<", "[", "/", ">", "<\\s>", "a", "\n", "é"])
TEXTS = st.lists(PIECES, max_size=8).map("".join) | st.text(max_size=20)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "", "tool>", "a b"]) | TEXTS, TEXTS), max_size=5))
def test_round_trip(turns):
    whole = "".join(chat.render(role, text) for role, text in turns)
    assert [turn[:2] for turn in chat.parse(whole)] == turns


@given(TEXTS)
def test_only_conflicts_are_escaped(text):
    assert chat.unescape(chat.escape(text)) == text
    if chat.CONFLICT.search(text) is None:
        assert chat.render("user", text) == f"[INST]{text}[/INST]"


@given(TEXTS, st.sampled_from(["system", "user", "assistant", "tool"]))
def test_no_mark_goes_out_raw(text, role):
    rendered = chat.render(role, text)
    (turn,) = chat.parse(rendered)
    body = rendered[turn[2] : turn[3]]
    assert all(m[0] != "<" and m[0] != "[" for m in chat.CONFLICT.finditer(body))
    assert chat.render("user", "a </s><s>b") == "[INST]a <\\/s><\\s>b[/INST]"


def expected(rows: list[tuple]) -> list[tuple]:
    by_conversation: dict = {}
    for conv_id, turn, role, text in rows:
        by_conversation.setdefault(conv_id, []).append((turn is not None, turn or 0, chat.render(role, text), role or "", text or ""))
    done = []
    for conv_id, turns in by_conversation.items():
        turns.sort()
        loss = "".join(t[4] for t in turns if t[3] == "assistant")
        whole = "".join(f"{t[3]}\n{t[4]}\n" for t in turns)
        done.append((conv_id, len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), sum(len(t[2]) for t in turns)))
    return done


def test_rows(spark):
    rows = [(1, 1, "assistant", HOSTILE), (1, 0, "user", HOSTILE), (2, 0, None, None), (2, None, "assistant", ""), (None, 3, "user", "x")]
    rows += [(3, 0, "assistant", "tie"), (3, 0, "assistant", "tie"), (3, 0, "user", "long " * 30000)]
    rows += [(4, i, "assistant" if i % 2 else "user", f"turn {i}") for i in range(2500)]
    frame = spark.createDataFrame([(*r, 0) for r in rows], "conv_id long, turn long, role string, text string, formatted int")
    got = [tuple(r) for r in chat.digests(chat.format_turns(frame)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, expected(rows)))
    assert chat.digests(chat.format_turns(frame.limit(0))).collect() == []


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", HOSTILE), (-7, 1, "assistant", HOSTILE)]
    assert sorted(tuple(r) for r in QUERIES["op3_chat_format"](spark, folder).collect()) == sorted(expected(rows))
