"""Classes against all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from sparkbourse.llm import near_dedup
from sparkbourse.llm.shingles import distinct, shingle_hashes, word_hashes


def shingles(text: str | None) -> set:
    words = re.findall(r"[^\W_]+", (text or "").lower())
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(texts: list[str | None]) -> list[int]:
    """For each text the first of its class."""
    sets, root = [shingles(t) for t in texts], list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a == sets[j] or len(a & sets[j]) >= 0.8 * len(a | sets[j]):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return [find(i) for i in range(len(texts))]


def made(n: int, rng: random.Random) -> list[str | None]:
    words = [f"w{i}" for i in range(400)]
    texts: list[str | None] = [" ".join(rng.choices(words, k=rng.randint(1, 90))) for _ in range(n)]
    for _ in range(n):
        copy = rng.choice(texts[:n]).split()
        copy[rng.randrange(len(copy))] = "changed"
        texts.append(" ".join(copy))
    return [*texts, None, "", " .. ", "One, two", "one two!", texts[0], texts[0]]


def test_estimate_is_the_probability_jaccard():
    rng = np.random.default_rng(1)
    a, b = np.arange(1, 301, dtype=np.uint64), np.arange(51, 351, dtype=np.uint64)
    wa, wb = rng.uniform(0.5, 4, 300), rng.uniform(0.5, 4, 300)
    weight = {int(h): [w, 0.0] for h, w in zip(a, wa, strict=True)}
    for h, w in zip(b, wb, strict=True):
        weight.setdefault(int(h), [0.0, 0.0])[1] = w
    pairs = np.array([v for v in weight.values()])
    shared = pairs[(pairs > 0).all(axis=1)]
    true = sum(1 / np.maximum(pairs[:, 0] / x, pairs[:, 1] / y).sum() for x, y in shared)
    text = np.repeat([0, 1], 300)
    won = near_dedup.prob_min_hash(np.append(a, b), text, np.append(wa, wb), 2, 20000)
    assert abs((won[0] == won[1]).mean() - true) < 0.02


def test_shingles_of_batches():
    texts = ["a b c d e f", "A, b; c!", "", None, "x " * 50]
    found, at = word_hashes(pa.array(texts, pa.string()))
    _, text, counts = distinct(*shingle_hashes(found, at, 5))
    assert np.bincount(text, minlength=5).tolist() == [2, 1, 0, 0, 1] and counts.max() == 46


@pytest.mark.parametrize("seed", [1, 2])
def test_classes(spark, seed):
    texts = made(60, random.Random(seed))
    frame = spark.createDataFrame([(i, t, "k", 1) for i, t in enumerate(texts)], "doc_id long, text string, t string, kept int")
    rows = {r.doc_id: r for r in near_dedup.classes(frame).collect()}
    want = brute(texts)
    assert [rows[i].class_id for i in range(len(texts))] == want
    assert all(rows[i].class_size == want.count(want[i]) for i in rows)
    kept = near_dedup.keep_one(frame)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want))


def test_odd_rows(spark):
    long = " ".join(str(i * i) for i in range(30000))
    rows = [(1, long), (2, long + " more"), (None, "no id at all here now"), (None, "no id at all here now"), (4, "same row twice"), (4, "same row twice"), (4, "other text")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.class_id or 0, r.class_size) for r in near_dedup.classes(frame).collect())
    assert got == [(0, 0, 2), (0, 0, 2), (1, 1, 2), (2, 1, 2), (4, 4, 1), (4, 4, 2), (4, 4, 2)]
    assert near_dedup.keep_one(frame).count() == 4
    assert near_dedup.classes(frame.limit(0)).collect() == [] and near_dedup.keep_one(frame.limit(0)).collect() == []


def test_large_group_of_near_copies(spark):
    rng = random.Random(3)
    base = [f"b{i}" for i in range(120)]
    texts = []
    for _ in range(600):
        copy = list(base)
        copy[rng.randrange(120)] = f"c{rng.randrange(10**6)}"
        texts.append(" ".join(copy))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.class_id for r in near_dedup.classes(frame).collect()} == {0}


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 200), (200, 150)], "a long, b long")
    roots = {r.id: r.root for r in near_dedup.components(links).collect()}
    assert set(roots.values()) == {0, 100} and sum(v == 0 for v in roots.values()) == 41


def test_query_equals_all_pairs(spark):
    from sparkbourse.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    docs = sorted(tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect())
    got = {r.doc_id: r.class_id for r in QUERIES["op4_near_duplicates"](spark, folder).collect()}
    assert got == {doc_id: docs[first][0] for (doc_id, _), first in zip(docs, brute([t for _, t in docs]), strict=True)}


def test_copies_that_repeat_a_passage(spark):
    rng, texts = random.Random(5), []
    for i in range(12):
        words = [f"r{i}x{j}" for j in range(200)]
        passage = words[:40]
        edited = list(words)
        edited[rng.randrange(100, 150)] = "changed"
        texts += [" ".join(words), " ".join(passage * 1000 + edited)]
    assert brute(texts) == [i - i % 2 for i in range(24)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in near_dedup.classes(frame).collect()} == dict(enumerate(brute(texts)))


def test_ids_outlive_other_file_splits(spark, monkeypatch):
    """Files are split by the cores there are, which change when an executor is lost."""
    confs = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before, calls, plain = [spark.conf.get(c) for c in confs], [], near_dedup.stage

    def staged(df, label):
        done = plain(df, label)
        calls.append(label)
        for conf, value in zip(confs, (["128MB", "0"], ["300", "300"])[len(calls) % 2], strict=True):
            spark.conf.set(conf, value)
        return done

    monkeypatch.setattr(near_dedup, "stage", staged)
    texts = made(60, random.Random(7))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    try:
        got = {r.doc_id: r.class_id for r in near_dedup.classes(frame).collect()}
    finally:
        for conf, value in zip(confs, before, strict=True):
            spark.conf.set(conf, value)
    assert got == dict(enumerate(brute(texts)))


def crowd(rng: random.Random) -> list[str]:
    """Texts with a passage in common that are not quite near, but for some pairs."""
    passage, texts = [f"p{i}" for i in range(104)], []
    for i in range(300):
        own = [f"o{i}x{j}" for j in range(14)]
        texts.append(" ".join(passage + own))
        if i < 40:
            texts.append(" ".join(passage + own[:5] + [f"q{i}x{j}" for j in range(9)]))
    rng.shuffle(texts)
    return texts


def test_pairs_in_a_crowd_with_a_common_passage(spark):
    texts = crowd(random.Random(8))
    want = brute(texts)
    assert len(set(want)) == 300
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in near_dedup.classes(frame).collect()} == dict(enumerate(want))


def test_links_through_one_member_of_a_large_class(spark):
    rng, base, texts = random.Random(9), [f"b{i}" for i in range(120)], []
    for i in range(500):
        member = list(base)
        member[i % 118] = f"m{i}"
        texts.append(" ".join(member))
        if i < 80:
            # An end hangs on this one member only: it is too far from all others.
            at = (i + 40) % 110
            member[at : at + 8] = [f"f{i}x{j}" for j in range(8)]
            texts.append(" ".join(member))
    rng.shuffle(texts)
    want = brute(texts)
    assert len(set(want)) < 10
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in near_dedup.classes(frame).collect()} == dict(enumerate(want))


def test_pairs_of_a_crowd_grow_with_the_texts(spark, monkeypatch):
    """A common passage just too short to make texts similar: few pairs are candidates, and no similar one is missed."""
    made_pairs, plain = {}, near_dedup.stage

    def staged(df, label):
        done = plain(df, label)
        if label == "meeting":
            made_pairs[len(texts)] = done.count()
        return done

    monkeypatch.setattr(near_dedup, "stage", staged)
    for n in (100, 400):
        passage, texts = [f"p{i}" for i in range(104)], []
        for i in range(n):
            own = [f"o{i}x{j}" for j in range(13)]
            texts.append(" ".join(passage + own))
            if i < 20:
                texts.append(" ".join(passage + own[:5] + [f"q{i}x{j}" for j in range(8)]))
        want = brute(texts)
        assert len(set(want)) == n
        frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        assert {r.doc_id: r.class_id for r in near_dedup.classes(frame).collect()} == dict(enumerate(want))
    assert all(pairs <= 10 * texts for texts, pairs in made_pairs.items()) and len(made_pairs) == 2


def test_bounds_of_pairs_lose_no_similar_one(spark):
    """Of texts in which anything may be common, the join by shingles finds all pairs that all pairs give."""
    rng, texts = random.Random(11), []
    base = [f"b{i}" for i in range(150)]
    for i in range(120):
        copy = base[: rng.randint(100, 150)]
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(len(copy))] = f"c{rng.randrange(40)}"
        texts.append(" ".join(copy))
    texts += ["a b c d", "a b c", "lone words here and there again"]
    sets = [shingles(t) for t in texts]
    want = {(i, j) for j in range(len(texts)) for i in range(j) if sets[i] != sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    frame = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    roots = frame.select("id", frame.id.alias("root"))
    met = {(r.a, r.b): r.estimate for r in near_dedup._meeting(near_dedup._prefixes(frame, 5, 0.8), roots, 0.8).collect()}
    assert want and want <= set(met)
    assert all(e >= len(sets[a] & sets[b]) / len(sets[a] | sets[b]) - 1e-9 for (a, b), e in met.items())
