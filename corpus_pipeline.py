"""The training-data pipeline: five stages over ``documents``, each working on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkbourse.llm import line_dedup, near_dedup, packing, secrets, toxicity
from sparkbourse.llm.common import table
from sparkbourse.session import release, stage


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows the text."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the lexicon, learned from ``labels``, scores at 0.7 or more."""
    return toxicity.keep_clean(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def cut_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; multi-line chunks that an earlier document has are cut from the later ones."""
    return _counted(line_dedup.remove_repeats(docs).select(*docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each class of near duplicates."""
    return near_dedup.keep_one(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret."""
    return _counted(secrets.redact(docs, secrets.new_ledger(spark)))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens of the kept documents, and their places in sequences."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", cut_repeated_lines),
    ("near_dedup", drop_near_copies),
    ("secret_scans", redact_secrets),
    ("packing", pack_sequences),
]
#: SQL can't express a learned lexicon or similarity classes; tests hold the run against plain loops instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what one returns is written and read again as the next one's documents."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
        release(*before)
        before = [docs]
    return docs
