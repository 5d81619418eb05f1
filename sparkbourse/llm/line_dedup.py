"""Removal of multi-line passages that occur anywhere else before: content-defined chunks of lines, compared byte by byte.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkbourse.llm.common import free_name
from sparkbourse.session import release, stage

#: A chunk ends behind a line where the rolling hash of this and the line before is divisible by this: so many lines on average.
MEAN_LINES = 3
#: Chunks of fewer lines are never removed.
LEAST_LINES = 2
#: Weight of the line before in the rolling hash.
ROLL = 31


def chunks_of(text: str, mean_lines: int = MEAN_LINES) -> Column:
    """Array of ``struct(idx, n_lines, body)`` whose bodies, joined by newlines, are the text of that column.

    A line's hash is the number in the first 8 hex digits of its MD5. One-element arrays give a name to a value that a
    lambda uses many times, so that it is computed once.
    """
    return F.expr(f"""
        transform(array(split({text}, '\\n', -1)), lines ->
          transform(array(transform(lines, line -> cast(conv(substring(md5(line), 1, 8), 16, 10) as bigint))), hashes ->
            transform(array(filter(transform(hashes, (h, i) ->
                if(i = size(hashes) - 1 or (i > 0 and (hashes[i - 1] * {ROLL} + h) % {mean_lines} = 0), i, null)), i -> i is not null)), ends ->
              transform(ends, (last, k) -> transform(array(if(k = 0, 0, ends[k - 1] + 1)), first -> named_struct(
                'idx', k, 'n_lines', last - first + 1,
                'body', array_join(slice(lines, first + 1, last - first + 1), '\\n')))[0]))[0])[0])[0]""")


def remove_repeats(docs: DataFrame, mean_lines: int = MEAN_LINES, least_lines: int = LEAST_LINES, hash_values: int | None = None) -> DataFrame:
    """``docs`` with every repeated multi-line chunk cut from ``text`` but where it occurs first.

    First is the smallest (``doc_id``, hash of the text, place in the text). All columns stay; three are added:
    ``chunks_removed``, ``lines_removed`` and ``chars_removed`` (of the removed chunks, newlines between chunks not
    counted); columns of ``docs`` with such names are kept and the new ones get underscores in front. No row goes: a
    document all of whose chunks are repeats gets an empty text. A null text stays null. Rows that repeat both id and
    text count as one document, so they stay alike. A null id sorts first. Chunks without any visible character stay.
    ``hash_values`` makes hashes collide in tests; equal hashes never suffice for removal.
    """
    hashed = F.xxhash64("c.body") if hash_values is None else F.pmod(F.xxhash64("c.body"), F.lit(hash_values))
    keys, chunks = [F.col("doc_id").alias("k"), F.xxhash64("text").alias("t")], chunks_of("text", mean_lines).alias("chunks")
    place = F.struct("k", "t", F.col("c.idx").alias("idx"))
    countable = (F.col("c.n_lines") >= least_lines) & F.col("c.body").rlike("\\S")

    # Groups of equal hashes, reduced before the shuffle; only those with several places go on.
    # Both are written: a join of two tables that only then are dealt by hash can split a hash that very many places have.
    found = docs.select(*keys, F.explode(chunks).alias("c")).filter(countable).select(place.alias("place"), hashed.alias("hash"))
    found = stage(found, "places")
    groups = found.groupBy("hash").agg(F.min("place").alias("first"), F.max("place").alias("last"))
    repeated = stage(groups.filter(~F.col("first").eqNullSafe(F.col("last"))).select(F.col("hash").alias("h"), "first"), "repeated")
    mark = F.struct(F.col("place.idx").alias("idx"), "hash", (~F.col("place").eqNullSafe(F.col("first"))).alias("later"))
    marked = found.join(repeated, F.col("hash") == F.col("h")).select("place.k", "place.t", mark.alias("m"))
    per_doc = marked.groupBy(F.col("k").alias("k2"), F.col("t").alias("t2")).agg(F.collect_set("m").alias("marks"))

    # The text travels as its chunks; all other columns in one, so that no name clashes.
    rest = F.struct(*[c for c in docs.columns if c != "text"]).alias("rest")
    rows = docs.select(*keys, rest, chunks)
    rows = rows.join(per_doc, F.col("k").eqNullSafe(F.col("k2")) & F.col("t").eqNullSafe(F.col("t2")), "left").drop("k2", "t2")
    rows = stage(rows, "chunked")
    release(found, repeated)

    # Byte comparison: group the bodies themselves. Only hashes that several different bodies share need a second look.
    # Marks lead to chunks by their number, never the other way round: a text may have very many of both.
    marked = rows.select("k", "t", "chunks", F.explode("marks").alias("m")).withColumn("c", F.col("chunks")[F.col("m.idx")])
    bodies = marked.select(place.alias("place"), F.col("m.hash").alias("hash"), F.col("c.body").alias("body"))
    distinct = bodies.groupBy("hash", "body").agg(F.min("place").alias("first"))
    shared = distinct.groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("hash").alias("h"))
    clashes = distinct.join(shared, F.col("hash") == F.col("h")).select(F.col("hash").alias("h"), F.col("body").alias("b"), "first")
    clashes = stage(clashes, "clashes")
    decided = bodies.join(clashes, (F.col("hash") == F.col("h")) & (F.col("body") == F.col("b")))
    verdict = F.struct("place.idx", (~F.col("place").eqNullSafe(F.col("first"))).alias("later"))
    verdicts = decided.groupBy(F.col("place.k").alias("k2"), F.col("place.t").alias("t2")).agg(F.collect_set(verdict).alias("verdicts"))
    verdicts = stage(verdicts, "verdicts")
    release(clashes)

    done = rows.join(verdicts, F.col("k").eqNullSafe(F.col("k2")) & F.col("t").eqNullSafe(F.col("t2")), "left")
    by_hash = F.coalesce("marks", F.expr("array()"))
    by_body = F.coalesce("verdicts", F.expr("array()"))
    later = F.transform(F.filter(by_hash, lambda m: m["later"]), lambda m: m["idx"])
    plain = F.array_except(later, F.transform(by_body, lambda v: v["idx"]))
    done = done.withColumn("drop", F.array_sort(F.concat(plain, F.transform(F.filter(by_body, lambda v: v["later"]), lambda v: v["idx"]))))
    # What is kept are the runs of chunks between those that go.
    kept = F.expr("""flatten(transform(concat(drop, array(size(chunks))), (end, i) ->
        slice(chunks, if(i = 0, 0, drop[i - 1] + 1) + 1, end - if(i = 0, 0, drop[i - 1] + 1))))""")
    removed = F.transform("drop", lambda i: F.col("chunks")[i])
    text = F.array_join(F.transform(kept, lambda c: c["body"]), "\n")
    lines = F.aggregate(removed, F.lit(0), lambda n, c: n + c["n_lines"])
    chars = F.aggregate(removed, F.lit(0), lambda n, c: n + F.length(c["body"]))
    return done.select(
        *[text.alias(c) if c == "text" else F.col("rest")[c].alias(c) for c in docs.columns],
        F.size("drop").alias(free_name(docs, "chunks_removed")),
        F.coalesce(lines, F.lit(0)).alias(free_name(docs, "lines_removed")),
        F.coalesce(chars, F.lit(0)).alias(free_name(docs, "chars_removed")),
    )


#: The same for a table with unique ids, as DuckDB SQL.
SQL = f"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(parts, 1) AS i, unnest(parts) AS line, len(parts) AS n
  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)),
hashed AS (SELECT *, CAST('0x' || substr(md5(line), 1, 8) AS BIGINT) AS h FROM lines),
ends AS (
  SELECT *, i = n OR coalesce((lag(h) OVER w * {ROLL} + h) % {MEAN_LINES} = 0, false) AS last
  FROM hashed WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
numbered AS (
  SELECT *, coalesce(sum(CAST(last AS INT)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS idx
  FROM ends),
chunks AS (
  SELECT doc_id, idx, count(*) AS n_lines, string_agg(line, chr(10) ORDER BY i) AS body FROM numbered GROUP BY doc_id, idx),
ranked AS (
  SELECT *, n_lines >= {LEAST_LINES} AND regexp_matches(body, '\\S')
            AND row_number() OVER (PARTITION BY body ORDER BY doc_id, idx) > 1 AS later FROM chunks),
cut AS (
  SELECT doc_id, coalesce(string_agg(body, chr(10) ORDER BY idx) FILTER (NOT later), '') AS text,
         count(*) FILTER (later) AS chunks_removed, coalesce(sum(n_lines) FILTER (later), 0) AS lines_removed,
         coalesce(sum(length(body)) FILTER (later), 0) AS chars_removed
  FROM ranked GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE c.text END AS text,
       CAST(coalesce(chunks_removed, 0) AS INT) AS chunks_removed, CAST(coalesce(lines_removed, 0) AS INT) AS lines_removed,
       CAST(coalesce(chars_removed, 0) AS INT) AS chars_removed
FROM documents d LEFT JOIN cut c USING (doc_id)
"""
