"""Near duplicates: ProbMinHash signatures of word shingles, bands, exact verification, components."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkbourse.llm.common import small_batches
from sparkbourse.llm.shingles import distinct, mix, shingle_hashes, slices, word_hashes
from sparkbourse.session import release, stage

WORDS, SIMILARITY = 5, 0.8
#: 24 bands of 4 of 96 components: two texts of similarity 0.8 share no band with probability 0.59^24, under 4 in a million.
BANDS, ROWS = 24, 4
#: All members of a bucket of at most so many are compared with each other from the start.
SMALL = 8
#: In a larger one they are first compared with so many others of it, picked by as many hashes: enough for the copies of one text.
LEADERS = 1
#: The estimate from 96 components must reach this before texts are fetched: five standard errors below the threshold.
ESTIMATE = 0.6
#: Rounds of picks by shingle, which join most of what belongs together; what they leave open is then decided exactly.
ROUNDS = 2
#: Sizes of sets are dealt to bins whose upper end is so many times the lower one.
BIN = 1.05
#: Shingles of a text leave their marks in so many bits. A mark that only one of two texts has is a shingle that only it has.
BITS = 1024
#: Texts of a shingle's largest class that its other texts meet in each round of picks by shingle.
PICKS = 4
#: Against rounding in bounds on sizes: far less than one shingle, so that only a superfluous pair can slip through.
SLACK = 1e-6
SIGNED = "doc_id long, t long, key binary, bands array<long>, planes array<long>"


def prob_min_hash(hashes: np.ndarray, text: np.ndarray, weights: np.ndarray, texts: int, parts: int, seed: int = 1) -> np.ndarray:
    """The winning shingle of each component of each text, as a ``texts`` x ``parts`` array; 0 where a text has none.

    Each shingle is a Poisson process with its weight as rate; every arrival goes to a random component, and the earliest
    arrival wins it. A shingle's process ends as soon as its time passes the latest win of its text, since nothing can
    change then. Two texts share a component with the probability Jaccard similarity of their weights.
    """
    best, winner = np.full(texts * parts, np.inf), np.zeros(texts * parts, np.uint64)
    state = mix(hashes + np.uint64(seed) * np.uint64(0xD1342543DE82EF95))
    when, rate, live = np.zeros(len(hashes)), 1.0 / weights, np.arange(len(hashes))
    step = np.uint64(0x9E3779B97F4A7C15)
    while len(live):
        state = state + step
        draw = mix(state)
        when = when - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) * rate
        place = text[live] * parts + (mix(draw ^ step) % np.uint64(parts)).astype(np.int64)
        np.minimum.at(best, place, when)
        won = best[place] == when
        winner[place[won]] = hashes[live[won]]
        latest = best.reshape(texts, parts).max(axis=1)
        going = when < latest[text[live]]
        live, state, when, rate = live[going], state[going], when[going], rate[going]
    return winner.reshape(texts, parts)


def _sign(words: int, bands: int, rows: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start, end in slices(whole.column("text")):
                batch = whole.slice(start, end - start)
                found, at_word = word_hashes(batch.column("text"))
                hashes, text = shingle_hashes(found, at_word, words)
                # Equal weights: then components agree with the Jaccard similarity of the sets, which decides in the end.
                hashes, text, _ = distinct(hashes, text)
                n = batch.num_rows
                winners = prob_min_hash(hashes, text, np.ones(len(hashes)), n, bands * rows)
                band = np.zeros((n, bands), np.uint64)
                for j in range(rows):
                    band = mix(band * np.uint64(31) + winners[:, j::rows][:, :bands])
                keys = [hashlib.blake2b(found[a:b].tobytes(), digest_size=16).digest() for a, b in zip(at_word[:-1], at_word[1:], strict=True)]
                some = np.diff(at_word) > 0
                lists = [list(row) if s else [] for row, s in zip(band.view(np.int64), some, strict=True)]
                planes = _as_planes((winners & np.uint64(255)).astype(np.uint8))
                columns = [batch.column("doc_id"), batch.column("t"), pa.array(keys, pa.binary()), pa.array(lists, pa.list_(pa.int64())), planes]
                yield pa.record_batch(columns, ["doc_id", "t", "key", "bands", "planes"])

    return sign


def _jaccard(words: int):
    def jaccard(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for sides in batches:
            texts = [pa.array(side, pa.large_string()) for side in sides]
            done = np.ones(len(texts[0]))
            for start, end in slices(pc.binary_join_element_wise(*texts, pa.scalar("", pa.large_string()))):
                sets = []
                for side in texts:
                    hashes, text = shingle_hashes(*word_hashes(side[start:end]), words)
                    sets.append(distinct(hashes, text)[:2])
                _, text, counts = distinct(*map(np.append, *sets))
                union = np.bincount(text, minlength=end - start)
                shared = np.bincount(text, weights=counts - 1, minlength=end - start)
                done[start:end] = np.where(union > 0, shared / np.maximum(union, 1), 1.0)
            yield pd.Series(done)

    return F.pandas_udf(jaccard, T.DoubleType(), F.PandasUDFType.SCALAR_ITER)


def text_key() -> Column:
    """With the id, which row of a table a signature belongs to."""
    return F.xxhash64(F.col("text")).alias("t")


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``(id, root)`` for every id in ``links(a, b)``: the smallest id that links lead to, step by step.

    Every step takes the least root of an id's neighbours and then that root's own, and writes the result; the number of
    steps grows with the logarithm of the longest chain. Links from hubs of many are summed up before the shuffle.
    """
    both = stage(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    roots = stage(both.groupBy(F.col("a").alias("id")).agg(F.least(F.col("a"), F.min("b")).alias("root")), "roots")
    for _ in range(rounds):
        near = both.join(roots.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("root").alias("near"))
        lower = roots.join(near, "id").select("id", F.least("root", "near").alias("to"), F.col("root").alias("was"))
        far = roots.select(F.col("id").alias("to"), F.col("root").alias("beyond"))
        step = stage(lower.join(far, "to").select("id", F.least("to", "beyond").alias("root"), "was"), "roots")
        release(roots)
        roots = step
        if step.filter("root <> was").isEmpty():
            break
    else:
        raise RuntimeError("links did not settle")
    release(both)
    return roots.select("id", "root")


def _picked(members: DataFrame, leaders: int, parts: int) -> DataFrame:
    """``a, b, estimate`` of members of a bucket and its leaders, where the estimate is high enough.

    Signatures travel with the members and the leaders, so the join itself drops what is no candidate; a bucket's rows are
    never together.
    """
    order = [F.struct(F.xxhash64("id", F.lit(j)).alias("o"), "id", "planes") for j in range(leaders)]
    picks = members.groupBy("band", "bucket").agg(*[F.min(o).alias(f"l{j}") for j, o in enumerate(order)])
    ls = F.array_distinct(F.array(*[F.struct(f"l{j}.id", f"l{j}.planes") for j in range(leaders)]))
    picks = picks.select(F.col("band").alias("b2"), F.col("bucket").alias("k2"), F.explode(ls).alias("l"))
    picks = stage(picks.select("b2", "k2", F.col("l.id").alias("id2"), F.col("l.planes").alias("planes2")), "leaders")  # dealt again by the join
    differ = _differing_parts("planes", "planes2", parts)
    pairs = members.join(picks, F.expr(f"band = b2 AND bucket = k2 AND id <> id2 AND {differ} <= {_most_differing(parts)}"))
    return pairs.select(F.least("id", "id2").alias("a"), F.greatest("id", "id2").alias("b"), (F.lit(1.0) - F.expr(differ) / parts).alias("estimate")).distinct()


def _all_pairs(members: DataFrame) -> DataFrame:
    """Each pair of members of each bucket once; for small buckets."""
    lists = members.groupBy("band", "bucket").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    pairs = F.expr("flatten(transform(ids, (x, i) -> transform(slice(ids, i + 2, size(ids)), y -> named_struct('a', x, 'b', y))))")
    return lists.select(F.explode(pairs).alias("p")).select("p.a", "p.b").distinct()


def _as_planes(values: np.ndarray) -> pa.Array:
    """The 8 bits of each of a row's numbers, plane by plane, each plane as words of 64 numbers."""
    width = -(-values.shape[1] // 64) * 8
    words = np.zeros((len(values), 8, width), np.uint8)
    for p in range(8):
        packed = np.packbits(values >> p & 1, axis=1, bitorder="little")
        words[:, p, : packed.shape[1]] = packed
    flat = pa.array(words.reshape(len(values), 8 * width).view(np.int64).ravel())
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1) * width, pa.int32()), flat)


def _sets(words: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start, end in slices(whole.column("text")):
                batch = whole.slice(start, end - start)
                hashes, text, _ = distinct(*shingle_hashes(*word_hashes(batch.column("text")), words))
                ends = np.searchsorted(text, np.arange(batch.num_rows + 1))
                shingles = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(hashes.view(np.int64)))
                marks = np.zeros((batch.num_rows, BITS), np.uint8)
                marks[text, (mix(hashes) % np.uint64(BITS)).astype(np.int64)] = 1
                bits = pa.FixedSizeListArray.from_arrays(pa.array(np.packbits(marks, axis=1).view(np.int64).ravel()), BITS // 64).cast(pa.list_(pa.int64()))
                yield pa.record_batch([batch.column("id"), pa.array(np.diff(ends)), shingles, bits], ["id", "n", "shingles", "bits"])

    return sets


def _differing_parts(left: str, right: str, parts: int) -> str:
    """SQL for the number of components in which two signatures differ, from their planes."""
    words = -(-parts // 64)
    return " + ".join("bit_count(" + " | ".join(f"({left}[{p * words + w}] ^ {right}[{p * words + w}])" for p in range(8)) + ")" for w in range(words))


def _most_differing(parts: int) -> int:
    """Components in which the signatures of candidates may differ."""
    return int(parts * (1 - ESTIMATE) + 1e-9)


def _open_texts(large: DataFrame, roots: DataFrame, texts: DataFrame) -> DataFrame:
    """``id, text`` of the members of buckets that hold several roots; the others are done."""
    placed = large.join(roots, "id")
    ends = placed.groupBy("band", "bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    mixed = stage(ends.filter("low <> high").select(F.col("band").alias("b2"), F.col("bucket").alias("k2")), "mixed")  # dealt again by the join
    ids = placed.join(mixed, (F.col("band") == F.col("b2")) & (F.col("bucket") == F.col("k2"))).select("id").distinct()
    return texts.join(ids, "id")


def _prefixes(texts: DataFrame, words: int, similarity: float) -> DataFrame:
    """``id, n, bits, s, low, high``: of ``texts(id, text)`` the shingles that may be the first common one of two similar
    texts, with the least and the most shingles that the other text may have.

    All shingles are in one order, rare ones first. Two texts of n and m shingles are similar if they share at least
    similarity / (1 + similarity) * (n + m). From their first common shingle on, at place p of one (from 0), they share at
    most n - p, which bounds m from above; m is never less than similarity * n. Shingles of one text only can't be common:
    they are counted, as the first ones, but neither sorted nor written.
    """
    sets = stage(texts.mapInArrow(_sets(words), "id long, n long, shingles array<long>, bits array<long>"), "sets")
    rows = sets.select("id", F.explode("shingles").alias("s"))
    often = stage(rows.groupBy("s").agg(F.count("*").alias("f")).filter("f > 1"), "often")  # dealt again by the join
    common = rows.join(often, "s").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("f", "s"))).alias("common"))
    sized = common.join(sets.select("id", "n", "bits"), "id").withColumn("rare", F.col("n") - F.size("common"))
    places = F.floor(F.col("n") * (1 - similarity) + SLACK) + 1 - F.col("rare")
    first = sized.select("id", "n", "bits", "rare", F.posexplode(F.slice("common", F.lit(1), F.greatest(F.lit(0), places.cast("int")))).alias("p", "c"))
    high = (F.col("n") - F.col("rare") - F.col("p")) * ((1 + similarity) / similarity) - F.col("n") + SLACK
    prefixes = stage(first.select("id", "n", "bits", "c.s", (F.col("n") * similarity - SLACK).alias("low"), high.alias("high")), "prefixes")
    release(sets, often)
    return prefixes


def _majors(placed: DataFrame, round_no: int = 0) -> DataFrame:
    """``s, major, picks``: for each shingle of several roots the root that most of its texts have, and some of that root's texts."""
    picks = [F.min(F.struct(F.xxhash64("id", "s", F.lit(round_no * PICKS + j)).alias("o"), "id", "n", "bits", "low", "high")) for j in range(PICKS)]
    of_root = placed.groupBy("s", "root").agg(F.count("*").alias("rows"), F.array(*picks).alias("picks"))
    top = of_root.groupBy("s").agg(F.max_by(F.struct("root", "picks"), F.struct("rows", "root")).alias("top"), F.count("*").alias("roots"))
    return stage(top.filter("roots > 1").select("s", F.col("top.root").alias("major"), "top.picks"), "majors")  # dealt again by joins


def _most_shared(similarity: float) -> tuple[str, str]:
    """SQL on rows of two texts that share a shingle: whether they may be similar, and how similar at most.

    Exact bounds: the sizes that the shingle's place allows, and what of each text the other has no mark of.
    """
    only = lambda x, y: f"aggregate(zip_with({x}, {y}, (x, y) -> bit_count(x & ~y)), 0, (total, x) -> total + x)"
    shared = f"least(n - {only('bits', 'bits2')}, n2 - {only('bits2', 'bits')})"
    enough = f"{shared} * {1 + similarity} + {SLACK} >= {similarity} * (n + n2)"
    return f"n BETWEEN low2 AND high2 AND n2 BETWEEN low AND high AND {enough}", f"{shared} / (n + n2 - {shared})"


def _with_major(prefixes: DataFrame, roots: DataFrame, similarity: float, round_no: int) -> DataFrame:
    """``a, b, estimate``: each text with a few of the largest root for each of its shingles, if they may be similar.

    As the picks differ from shingle to shingle, a text has many chances to meet one of its class that it is similar to,
    at no more pairs than a few for each of its shingles.
    """
    placed = prefixes.join(roots, "id")
    picks = _majors(placed, round_no).select(F.col("s").alias("s2"), "major", F.explode(F.array_distinct("picks")).alias("l"))
    picks = picks.select("s2", "major", *[F.col(f"l.{c}").alias(f"{c}2") for c in ("id", "n", "bits", "low", "high")])
    may, most = _most_shared(similarity)
    met = placed.join(picks, F.expr(f"s = s2 AND root <> major AND {may}"))
    return met.select(F.least("id", "id2").alias("a"), F.greatest("id", "id2").alias("b"), F.expr(most).alias("estimate")).distinct()


def _size_bin(size: Column) -> Column:
    return F.floor(F.log(size) / float(np.log(BIN))).cast("int")


def _meeting(prefixes: DataFrame, roots: DataFrame, similarity: float) -> DataFrame:
    """``a, b, estimate`` of pairs of different roots, among them all similar ones of the texts that ``prefixes`` are of.

    Texts are joined by the shingles that may be their first common one, and by size, as far as the places of the shingle
    and the marks of both leave room for enough common ones. No similar pair fails that, so none is lost. Texts with a
    common passage meet by their own shingles first, and by those of the passage only if it is large enough to make them
    similar: what is just under the threshold makes no pair. Of the texts that a shingle brings together, those of the
    root that has most of them do not meet each other. These are plain joins of written tables, whose large partitions
    Spark splits.
    """
    placed = prefixes.join(roots, "id")
    entries = stage(placed.join(_majors(placed).drop("picks"), "s"), "entries")
    left = entries.withColumn("bin", _size_bin(F.col("n")))
    right = entries.filter("root <> major").withColumn("bin", F.explode(F.sequence(_size_bin(F.col("low")), _size_bin(F.col("high")))))
    right = right.select(*[F.col(c).alias(f"{c}2") for c in ("s", "bin", "id", "root", "n", "bits", "low", "high")])
    may, most = _most_shared(similarity)
    met = left.join(right, F.expr(f"s = s2 AND bin = bin2 AND root <> root2 AND (root = major OR id < id2) AND {may}"))
    pairs = stage(met.select(F.least("id", "id2").alias("a"), F.greatest("id", "id2").alias("b"), F.expr(most).alias("estimate")).distinct(), "meeting")
    release(entries)
    return pairs


def _texts(needed: DataFrame, firsts: DataFrame, docs: DataFrame) -> DataFrame:
    """``id, text`` of all ids in ``needed(id)``, written once."""
    places = firsts.join(needed, "id").select("id", F.col("doc_id").alias("k"), F.col("t").alias("u"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(), F.col("text").cast("string").alias("text"))
    texts = rows.join(places, F.col("doc_id").eqNullSafe(F.col("k")) & F.col("t").eqNullSafe(F.col("u"))).select("id", "text")
    return stage(texts.dropDuplicates(["id"]), "texts")


def _verified(pairs: DataFrame, texts: DataFrame, words: int, similarity: float) -> DataFrame:
    """Those of ``pairs(a, b)`` whose texts have the similarity. A leader may be in very many pairs: these are plain
    joins, whose large partitions Spark splits."""
    left, right = texts.withColumnsRenamed({"id": "a", "text": "ta"}), texts.withColumnsRenamed({"id": "b", "text": "tb"})
    compared = pairs.join(left, "a").join(right, "b").select("a", "b", _jaccard(words)("ta", "tb").alias("similarity"))
    return stage(compared.filter(F.col("similarity") >= similarity).select("a", "b"), "verified")


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Those of ``pairs(a, b, ..)`` whose roots differ, with both roots as ``ra`` and ``rb``."""
    ends = pairs.join(roots.withColumnsRenamed({"id": "a", "root": "ra"}), "a").join(roots.withColumnsRenamed({"id": "b", "root": "rb"}), "b")
    return ends.filter("ra <> rb")


def _settled(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Roots of whole classes. Every id hangs on its root so far, so only links between different roots are followed."""
    between = stage(_apart(links, roots).select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "between")
    if between.isEmpty():
        return roots
    last = components(between).select(F.col("id").alias("root"), F.col("root").alias("to"))
    release(between)
    return stage(roots.join(last, "root", "left").select("id", F.coalesce("to", "root").alias("root")), "near-roots")


def _likeliest(pairs: DataFrame) -> DataFrame:
    """Of ``pairs(a, b, estimate)`` those that are the best one of either text."""
    both = pairs.select("a", "b", "estimate").union(pairs.select("b", "a", "estimate"))
    best = both.groupBy("a").agg(F.max_by("b", F.struct("estimate", "b")).alias("b"))
    return best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def classes(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, leaders: int = LEADERS) -> DataFrame:
    """``doc_id, t, class_id, class_size``: a row for every row of ``docs``, with the smallest id of its class.

    A class is a connected set of texts that pairwise links of at least ``similarity`` hold together (Jaccard of sets of
    ``words`` lower-case words in a row; a text of fewer words has all of them as its one shingle). Texts with the same
    words are one text from the start, so copies cost nothing; so are all texts without words, null ones too. ``t`` is
    the hash of the text. Null ids are allowed; a class without any id has a null class id. No rows give no rows.

    Texts that share a band are candidates, all of them. The members of a small bucket are all compared. In a larger one
    they first meet a leader, and every text is compared with its likeliest partner. The members of all buckets that then
    still hold several classes are joined by rare shingles, first with picks in rounds, then with all of other classes,
    which finds all similar pairs. What rounds left over is compared too: they only save work, and decide no pair but
    those they compare.
    """
    spark = docs.sparkSession
    small_batches(spark)
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(), F.col("text").cast("string").alias("text"))
    signed = stage(read.mapInArrow(_sign(words, bands, rows), SIGNED), "signed")
    firsts = signed.groupBy("key").agg(F.min(F.struct("doc_id", "t", "bands", "planes")).alias("f")).select("key", "f.*")
    firsts = stage(firsts.withColumn("id", F.monotonically_increasing_id()), "firsts")  # written with the id: splits may change later
    member = firsts.select("id", F.posexplode("bands").alias("band", "bucket"))
    sizes = member.groupBy("band", "bucket").agg(F.count("*").alias("size")).filter("size > 1").select(F.col("band").alias("b2"), F.col("bucket").alias("k2"), "size")
    members = stage(member.join(sizes, (F.col("band") == F.col("b2")) & (F.col("bucket") == F.col("k2"))).select("id", "band", "bucket", "size"), "members")
    large = members.filter(F.col("size") > SMALL).drop("size")
    planes = firsts.select("id", "planes")
    signed_large = stage(large.join(planes, "id"), "large")
    alone = members.select("id").distinct().select("id", F.col("id").alias("root"))
    texts = _texts(alone.select("id"), firsts, docs)
    tried = []

    def untried(pairs: DataFrame) -> DataFrame:
        return pairs.join(reduce(DataFrame.union, tried), ["a", "b"], "left_anti")

    def guessed(pairs: DataFrame) -> DataFrame:
        """Pairs with their estimate, as far as it is high enough."""
        both = pairs.join(planes.withColumnsRenamed({"id": "a", "planes": "pa"}), "a").join(planes.withColumnsRenamed({"id": "b", "planes": "pb"}), "b")
        told = both.select("a", "b", F.expr(_differing_parts("pa", "pb", bands * rows)).alias("differ")).filter(F.col("differ") <= _most_differing(bands * rows))
        return told.select("a", "b", (F.lit(1.0) - F.col("differ") / (bands * rows)).alias("estimate"))

    def compare(pairs: DataFrame) -> DataFrame:
        """The links among ``pairs(a, b)``, by their texts."""
        pairs = stage(pairs, "tried")
        tried.append(pairs)
        return _verified(pairs, texts, words, similarity)

    todo = _picked(signed_large, leaders, bands * rows).union(guessed(_all_pairs(members.filter(F.col("size") <= SMALL))))
    first = stage(todo.distinct(), "pairs")
    roots = _settled(stage(alone, "near-roots"), compare(_likeliest(first)))
    left_over = untried(first)
    prefixes = _prefixes(_open_texts(large, roots, texts), words, similarity)
    for round_no in range(ROUNDS):
        found = compare(_likeliest(untried(_with_major(prefixes, roots, similarity, round_no))))
        if found.isEmpty():
            break
        roots = _settled(roots, found)
    open_pairs = untried(_meeting(prefixes, roots, similarity))
    release(signed_large)
    todo = stage(open_pairs.union(_apart(left_over, roots).select("a", "b", "estimate")).distinct(), "pairs")
    if not todo.isEmpty():
        # The likeliest partner of each text first: what then hangs together needs no comparison any more.
        roots = _settled(roots, compare(_likeliest(todo)))
        roots = _settled(roots, compare(_apart(untried(todo), roots).select("a", "b")))
    release(texts, first, todo, members, prefixes)
    with_id = signed.select("doc_id", "t", "key").join(firsts.select("key", "id"), "key")
    with_root = stage(with_id.join(roots, "id", "left").select("doc_id", "t", F.coalesce("root", "id").alias("root")), "rooted")
    named = with_root.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"), F.min(F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("o"), "doc_id", "t")).alias("kept"))
    named = stage(named, "classes")  # dealt again by the join, which can so split a large class
    return with_root.join(named, "root").select("doc_id", "t", "class_id", "class_size", (F.struct("doc_id", "t").eqNullSafe(F.struct("kept.doc_id", "kept.t"))).alias("kept"))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, all columns, of which each class keeps the one with its smallest id; repeated rows once."""
    keepers = classes(docs, **options).filter("kept").select(F.col("doc_id").alias("k"), F.col("t").alias("u")).distinct()
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text_key())
    kept = rows.join(keepers, F.col("doc_id").eqNullSafe(F.col("k")) & F.col("t").eqNullSafe(F.col("u")))
    return kept.dropDuplicates(["doc_id", "t"]).select("row.*")
