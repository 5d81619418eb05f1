"""The pipeline's stages against the plain versions of their operators."""

from __future__ import annotations

import corpus_pipeline
import test_llm_line_dedup as lines
import test_llm_near_dedup as near
import test_llm_packing as packs
import test_llm_secrets as secret

from sparkbourse.llm import toxicity
from sparkbourse.session import stage

FOLDER = "/root/testdata/sf0.001"


def redacted(text: str) -> str:
    done, at = "", 0
    for start, _, end, _ in secret.brute(text):
        if start >= at:
            done += text[at:start] + "[secret]"
        at = max(at, end)
    return done + text[at:]


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    lexicon = toxicity.learn(docs, labels)
    plain = [(r.doc_id, r.text) for r in docs.collect() if lexicon.score(r.text or "") < 0.7]
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = stage(step(spark, docs, FOLDER), name)
        assert docs.columns == columns
        if name == "line_dedup":
            cut = lines.brute(plain)
            plain = [(i, cut[i][0]) for i, _ in plain]
        elif name == "near_dedup":
            plain.sort()
            first = near.brute([t for _, t in plain])
            plain = [row for i, row in enumerate(plain) if first[i] == i]
        elif name == "secret_scans":
            plain = [(i, redacted(t)) for i, t in plain]
        rows = docs.collect()
        assert sorted((r.doc_id, r.text) for r in rows) == sorted(plain), name
        assert name == "toxicity" or name == "near_dedup" or all(r.n_chars == len(r.text) for r in rows)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    packs.check(plain, packed, 2048)


def test_run(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "secret_scans", "packing"]
    assert corpus_pipeline.run(spark, FOLDER).count() > 0
