"""Secrets in texts, by an incremental ledger of content-addressed blobs. DataFrame functions only."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkbourse.session import scratch_dir


@dataclass(frozen=True)
class Rule:
    """A kind of secret. Matches are leftmost and do not overlap; one counts if its ``group`` has ``least`` characters.

    ``hint`` is a string that every text with a match holds, in lower case if ``any_case``; it only saves time.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    version: int = 1
    base: bool = False
    hint: str = ""

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


#: The first three are fixed values. Theirs are the base spans, in this order where several start at one place. For
#: runs of one character class a least length in the pattern finds the same matches as dropping short ones afterwards.
RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8, base=True),
    Rule("access", r"AKIA[A-Z0-9]{12,}", base=True, hint="AKIA"),
    Rule("hex", r"[0-9a-f]{32,}", base=True),
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----", hint="PRIVATE KEY"),
    Rule("hub_token", r"gh[pousr]_[A-Za-z0-9]{36,}", hint="_"),
    Rule("chat_token", r"xox[abeoprs]-[A-Za-z0-9-]{10,}", hint="xox"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", hint="eyJ"),
)


def blob_id(text: Column) -> Column:
    """Content address: null text is the empty blob."""
    return F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256)


def _candidates(text: Column, rule: Rule) -> Column:
    """Array of (text before, match, its group) for every match of a rule; cutting and extracting walk alike."""
    pattern = F.lit(rule.pattern)
    cut = F.arrays_zip(
        F.split(text, rule.pattern, -1).alias("before"),
        F.regexp_extract_all(text, pattern, 0).alias("hit"),
        F.regexp_extract_all(text, pattern, rule.group).alias("part"),
    )
    sizes = F.transform(
        cut, lambda c: F.struct(F.length(c["before"]).alias("before"), F.length(c["hit"]).alias("hit"), F.length(c["part"]).alias("part"))
    )
    found = text.contains(rule.hint) & text.rlike(rule.pattern) if rule.hint else text.rlike(rule.pattern)
    return F.when(found, sizes)


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``blob_id, kind, rule, start, end`` (code points, end exclusive) in ``blobs(blob_id, text, todo)``.

    Only rules whose key is in ``todo`` look at a text. Places follow from running sums over a blob's own cuts.
    """
    text = F.col("text")
    per_rule = [
        F.struct(F.lit(r.key).alias("rule"), F.when(F.array_contains("todo", r.key), _candidates(text, r)).alias("cuts")) for r in rules
    ]
    cuts = blobs.select("blob_id", F.explode(F.array(*per_rule)).alias("r")).select("blob_id", "r.rule", F.posexplode("r.cuts").alias("i", "c"))
    before = Window.partitionBy("blob_id", "rule").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    start = F.sum(F.col("c.before") + F.coalesce("c.hit", F.lit(0))).over(before) - F.col("c.hit")
    spans = cuts.select("blob_id", "rule", start.cast("long").alias("start"), F.col("c.hit").alias("hit"), F.col("c.part").alias("part"))
    enough = F.lit(False)
    kind = F.lit(None).cast("string")
    for r in rules:
        enough = enough | ((F.col("rule") == r.key) & (F.col("part") >= r.least))
        kind = F.when(F.col("rule") == r.key, r.kind).otherwise(kind)
    spans = spans.filter(F.col("hit").isNotNull() & enough)
    return spans.select("blob_id", kind.alias("kind"), "rule", "start", (F.col("start") + F.col("hit")).alias("end"))


class Ledger:
    """What was scanned by which rules and what was found, in a folder that all executors reach.

    Every scan writes its findings first and then the list of scanned blobs; findings of a scan without a finished list
    are ignored, so a scan that broke off is simply done again.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder.rstrip("/")

    def _finished(self) -> list[str]:
        """Scans with a finished list; one name for each scan ever made."""
        path = self._spark._jvm.org.apache.hadoop.fs.Path(f"{self._folder}/*/scanned/_SUCCESS")
        found = path.getFileSystem(self._spark._jsc.hadoopConfiguration()).globStatus(path) or []
        return sorted(f.getPath().getParent().getParent().getName() for f in found)

    def _read(self, what: str, schema: str) -> DataFrame:
        paths = [f"{self._folder}/{scan}/{what}" for scan in self._finished()]
        return self._spark.read.schema(schema).parquet(*paths) if paths else self._spark.createDataFrame([], schema)

    def scanned(self) -> DataFrame:
        return self._read("scanned", "blob_id string, rules array<string>")

    def findings(self) -> DataFrame:
        return self._read("findings", "blob_id string, kind string, rule string, start long, end long")

    def scan(self, versions: DataFrame, rules: tuple[Rule, ...] = RULES) -> None:
        """Scan the texts of ``versions(text)`` that some rule version has not seen, each distinct text once."""
        keys = F.array(*[F.lit(r.key) for r in rules])
        text = F.coalesce(F.col("text").cast("string"), F.lit(""))
        blobs = versions.select(blob_id(F.col("text")).alias("blob_id"), text.alias("text")).dropDuplicates(["blob_id"])
        if self._finished():
            seen = self.scanned().groupBy("blob_id").agg(F.flatten(F.collect_list("rules")).alias("seen"))
            todo = F.array_except(keys, F.coalesce("seen", F.array().cast("array<string>")))
            blobs = blobs.join(seen, "blob_id", "left").withColumn("todo", todo).filter(F.size("todo") > 0).drop("seen")
        else:
            blobs = blobs.withColumn("todo", keys)
        at = f"{self._folder}/{uuid.uuid4().hex}"
        # Which blobs were new is settled by one pass: a mark without place stands for a blob that was looked at.
        scan_blobs(blobs, rules).write.parquet(f"{at}/findings")
        ids = versions.select(blob_id(F.col("text")).alias("blob_id")).distinct()
        if self._finished():
            ids = ids.join(seen, "blob_id", "left").withColumn("rules", todo).filter(F.size("rules") > 0).drop("seen")
        else:
            ids = ids.withColumn("rules", keys)
        ids.write.parquet(f"{at}/scanned")


def new_ledger(spark: SparkSession) -> Ledger:
    return Ledger(spark, f"{scratch_dir(spark)}/ledger/{spark.sparkContext.applicationId}-{uuid.uuid4().hex}")


def _order(rules: tuple[Rule, ...]) -> Column:
    """Place of a kind in the list of rules."""
    order = F.lit(len(rules))
    for i, r in reversed(list(enumerate(rules))):
        order = F.when(F.col("kind") == r.kind, i).otherwise(order)
    return order


def find(docs: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """A row for every row of ``docs``: counts by base kind, digest of the base spans, and all spans as text.

    Scans what the ledger lacks, then joins the findings of each blob back to all rows with that text. Rows without any
    finding have zero counts, the digest of an empty string and empty ``spans``. Null text counts as empty, a null id
    stays null; only ``doc_id`` and ``text`` are read.
    """
    ledger.scan(docs, rules)
    current = F.col("rule").isin([r.key for r in rules])
    base = [r.kind for r in rules if r.base]
    found = ledger.findings().filter(current).select("blob_id", "kind", "start", "end", _order(rules).alias("order")).distinct()
    spans = F.array_sort(F.collect_list(F.struct("start", "order", "end", "kind")))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    per_blob = found.groupBy("blob_id").agg(spans.alias("s"), *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in base])
    per_blob = per_blob.select(
        "blob_id", *[f"n_{k}" for k in base], joined("s").alias("spans"), joined(F.filter("s", lambda x: x["kind"].isin(base))).alias("base")
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), blob_id(F.col("text")).alias("blob_id")).join(per_blob, "blob_id", "left")
    return rows.select(
        "doc_id",
        *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )


def redact(docs: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES, mark: str = "[secret]") -> DataFrame:
    """``docs``, all rows and columns, with every span found in ``text`` replaced by ``mark``; overlapping spans once."""
    ledger.scan(docs, rules)
    found = ledger.findings().filter(F.col("rule").isin([r.key for r in rules])).select("blob_id", "start", "end").distinct()
    reached = Window.partitionBy("blob_id").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    found = found.withColumn("done", F.coalesce(F.max("end").over(reached), F.lit(0))).filter(F.col("end") > F.col("done"))
    spans = F.array_sort(F.collect_list(F.struct("start", "end", "done")))
    per_blob = found.groupBy("blob_id").agg(spans.alias("s")).withColumnsRenamed({"blob_id": "blob"})
    rest = F.struct(*[c for c in docs.columns if c != "text"]).alias("rest")
    rows = docs.select(F.col("text"), rest, blob_id(F.col("text")).alias("blob_id"))
    rows = rows.join(per_blob, F.col("blob_id") == F.col("blob"), "left")
    # Between two spans lies the text from the furthest end so far; a span that starts before it adds no second mark.
    between = lambda s: F.when(
        (s["start"] >= s["done"]) | (s["done"] == 0), F.concat(F.substring("text", s["done"] + 1, s["start"] - s["done"]), F.lit(mark))
    ).otherwise("")
    tail = F.substring("text", F.array_max(F.transform("s", lambda s: s["end"])) + 1, F.length("text"))
    text = F.when(F.col("s").isNull(), F.col("text")).otherwise(F.concat(F.array_join(F.transform("s", between), ""), tail))
    return rows.select(*[text.alias(c) if c == "text" else F.col("rest")[c].alias(c) for c in docs.columns])


def _sql(rules: tuple[Rule, ...] = RULES) -> str:
    """The rows of ``find`` as DuckDB SQL, for a table with unique ids."""
    quoted = lambda text: "'" + text.replace("'", "''") + "'"
    cuts = " UNION ALL ".join(
        f"SELECT doc_id, {quoted(r.kind)} AS kind, {i} AS ord, {int(r.base)} = 1 AS base, {r.least} AS least,"
        f" unnest(string_split_regex(t, {quoted(r.pattern)})) AS before, unnest(regexp_extract_all(t, {quoted(r.pattern)}, 0)) AS hit,"
        f" unnest(regexp_extract_all(t, {quoted(r.pattern)}, {r.group})) AS part,"
        f" generate_subscripts(string_split_regex(t, {quoted(r.pattern)}), 1) AS i FROM texts"
        for i, r in enumerate(rules)
    )
    counts = ", ".join(f"CAST(count(*) FILTER (kind = {quoted(r.kind)}) AS BIGINT) AS n_{r.kind}" for r in rules if r.base)
    zeros = ", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in rules if r.base)
    span = "kind || ':' || s || ':' || e, ',' ORDER BY s, ord"
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
cuts AS ({cuts}),
placed AS (
  SELECT *, CAST(sum(length(before) + coalesce(length(hit), 0)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS BIGINT) AS e FROM cuts),
spans AS (SELECT *, e - length(hit) AS s FROM placed WHERE hit IS NOT NULL AND length(part) >= least),
found AS (
  SELECT doc_id, {counts}, string_agg({span}) FILTER (base) AS base, string_agg({span}) AS spans FROM spans GROUP BY doc_id)
SELECT doc_id, {zeros}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN found USING (doc_id)
"""


SQL = _sql()
