import base64
import random
import re
from collections import Counter

import pytest
import zstandard

from sparkbourse.llm import quality

SCHEMA = "doc_id long, text string, n_words string, RATIO double"


def plain(text, bands=quality.BANDS, chunk=quality.CHUNK):
    """What a row should be, by loops over words, lines and chunks."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    marked = {i + j for i in range(len(words) - 2) if runs[tuple(words[i : i + 3])] > 1 for j in range(3)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    data = text.encode()

    def fits(part):
        band = [b for b in bands if len(part) < b.below][0]
        return band.least <= len(zstandard.compress(part, 3)) / len(part) <= band.largest

    parts = [data[i : i + chunk] for i in range(0, len(data), chunk)]
    bad = sum(len(p) for p in parts if not fits(p))
    failed = len(words) < 50 or 100 * len(marked) > 50 * len(words)
    good = not data or (fits(data) and bad <= 0.3 * len(data))
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, repeated, len(marked), failed, not failed and good


def prose(rng, words):
    syllables = ["ka", "lo", "mi", "ren", "tas", "u", "vel", "o", "dür", "né", "shi", "ba", "gor", "ent"]
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(words))


def texts():
    rng = random.Random(3)
    out = [None, "", " \n\t ", "a", "a b", "x y   z", "é" * 300, "\x1c a \x1f b"]
    out += [prose(rng, n) for n in (49, 50, 80, 200, 600, 3000)]
    out += ["same again " * 100, prose(rng, 60) + "\n" + "one two three four " * 40, "\n".join(["line a", "line b", "line a", "", "", " ", "line a"] * 9)]
    out += [base64.b64encode(rng.randbytes(40 * k)).decode().replace("A", " ") for k in (5, 50, 500)]
    out += [prose(rng, 2000) + "\n" + base64.b64encode(rng.randbytes(9000)).decode(), "#| a <b> & $5 100% *" * 3 + prose(rng, 70)]
    out += ["一二三四五六七八九十" * 20, "".join(rng.choice("abc \n") for _ in range(2000))]
    return out


def judged(spark, texts, **options):
    docs = spark.createDataFrame([(i, t, "x", 1.0) for i, t in enumerate(texts)], SCHEMA)
    rows = quality.judge(docs.repartition(3), **options).collect()
    return {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in rows}


def test_equal_to_plain_loops(spark):
    given = texts()
    got = judged(spark, given)
    assert got == {i: plain(t) for i, t in enumerate(given)}
    assert {row[-1] for row in got.values()} == {True, False}


def test_repeated_rows_null_ids_and_no_rows(spark):
    text = prose(random.Random(1), 100)
    rows = quality.judge(spark.createDataFrame([(7, text), (7, text), (None, text), (None, None)], "doc_id long, text string")).collect()
    assert sorted((r.doc_id is None, r.kept) for r in rows) == [(False, True), (False, True), (True, False), (True, True)]
    empty = quality.judge(spark.createDataFrame([], "doc_id long, text string"))
    assert empty.count() == 0 and "kept" in empty.columns


def test_bands_decide_where_base_rules_pass(spark):
    rng = random.Random(5)
    words = [prose(rng, 1) + str(i) for i in range(4000)]
    junk = base64.b64encode(rng.randbytes(30000)).decode()
    blob = " ".join(junk[i : i + 60] for i in range(0, len(junk), 60))
    # The same words over and over in another order: few three-word runs come back, but the text says little.
    few = rng.sample(words, 12)
    droning = " ".join(rng.choice(few) + " " + rng.choice(words) * 2 for _ in range(1500))
    mixed = prose(rng, 3000) + " " + blob
    rows = quality.judge(spark.createDataFrame(list(enumerate([prose(rng, 3000), blob, mixed, droning])), "doc_id long, text string"))
    found = {r.doc_id: r for r in rows.collect()}
    assert [found[i].base_failed for i in range(3)] == [False] * 3
    assert [found[i].kept for i in range(3)] == [True, False, False]
    assert found[2].in_band and found[2].bad_chunk_bytes > 0.3 * found[2].n_bytes  # only its chunks tell


@pytest.mark.parametrize("words", [400_000])
def test_very_long_text(spark, words):
    text = prose(random.Random(2), words)
    assert judged(spark, [text])[0] == plain(text)


def test_repeated_runs_are_exact():
    rng = random.Random(9)
    for n in range(0, 40):
        words = [rng.randint(0, 3) for _ in range(n)]
        runs = Counter(tuple(words[i : i + 3]) for i in range(n - 2))
        marked = {i + j for i in range(n - 2) if runs[tuple(words[i : i + 3])] > 1 for j in range(3)}
        assert quality.repeated_words(__import__("numpy").array(words, "int64")) == len(marked)
