"""The pipeline's stages keep what they should and their decisions take effect."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from aurum.llm.common import materialise
from tests.llm.test_search_ops import PATTERNS, brute_classes, brute_hits, valid
from tests.llm.test_text_ops import _check_packing

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = docs.unionByName(spark.createDataFrame([(10**6, "123 !!", "en", "s", 6), (10**6 + 1, None, "en", "s", 0)], docs.schema))
    out = [("documents", docs)]
    for name, f in corpus_pipeline.STAGES:
        docs = materialise(f(spark, docs, SF), f"test-{name}")
        out.append((name, docs))
    return dict(out)


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_stage_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontaminate", "mask_pii", "pack"]
    for name in ("language_id", "near_dedup", "decontaminate", "mask_pii"):
        assert stages[name].columns == stages["documents"].columns and stages[name].dtypes == stages["documents"].dtypes


def test_language_stage_keeps_clean_documents(stages):
    assert set(texts(stages["documents"])) - set(texts(stages["language_id"])) == {10**6, 10**6 + 1}


def test_near_dedup_keeps_one_of_each_class(stages):
    classes = brute_classes(sorted(texts(stages["language_id"]).items()))
    assert set(texts(stages["near_dedup"])) == set(classes.values())


def test_no_benchmark_window_is_left(spark, stages):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before, after = texts(stages["near_dedup"]), texts(stages["decontaminate"])
    hits = dict(zip(before, brute_hits(before.values(), items)))
    assert any(h[1] for h in hits.values())
    assert all(not h[1] for h in brute_hits(after.values(), items))
    assert all(after[i] == t for i, t in before.items() if not hits[i][1])


def test_no_base_match_is_left(stages):
    before, after = texts(stages["decontaminate"]), texts(stages["mask_pii"])
    assert set(before) == set(after) and any(before[i] != after[i] for i in before)
    for i, t in after.items():
        assert not [m[0] for k, p in PATTERNS.items() for m in re.finditer(p, t) if valid(k, m[0])]
        assert t == before[i] or "[PII]" in t
    assert stages["mask_pii"].where(F.col("n_chars") != F.length("text")).count() == 0


def test_all_tokens_are_packed(stages):
    _check_packing(stages["pack"].collect(), list(texts(stages["mask_pii"]).items()), 2048)


def test_run_equals_the_stages(spark):
    n = corpus_pipeline.run(spark, SF).agg(F.countDistinct("doc_id"), F.sum("length")).first()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, f in corpus_pipeline.STAGES:
        docs = materialise(f(spark, docs, SF), f"test-{name}")
    assert n == docs.agg(F.countDistinct("doc_id"), F.sum("length")).first()


def test_awkward_rows_pass_every_stage(spark, docs, no_docs):
    columns = corpus_pipeline.COLUMNS
    for source in (docs.select(columns).withColumn("lang", F.lit("en")), no_docs.select(columns)):
        for _, f in corpus_pipeline.STAGES:
            assert f(spark, source, SF).count() >= 0
