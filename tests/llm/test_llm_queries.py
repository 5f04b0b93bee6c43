"""Queries against their oracle SQL, and the pipeline against plain versions (sf0.001)."""

import brute
import pytest
from test_dedup import brute_hits, brute_lines

import corpus_pipeline
from pricepanel.llm import queries
from pricepanel.llm.superminhash import SHINGLE
from pricepanel.plans.compare import compare, duck_connect

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_oracle(spark, name):
    res = compare(queries.QUERIES[name](spark, SF), queries.ORACLE[name], duck_connect(SF))
    assert res["ok"], res


def test_near_duplicates_of_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.QUERIES["op3_superminhash"](spark, SF).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == sorted(brute.near_duplicates(rows, 2))


def test_pipeline_keeps_what_plain_versions_keep(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {r.doc_id for r in queries.QUERIES["op5_adaptive_quality"](spark, SF).where("kept").collect()}
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id in kept}
    lines = corpus_pipeline.line_deduplication(spark, corpus_pipeline.quality_rules(spark, docs, SF), SF)
    assert lines.columns == docs.columns
    after = {r.doc_id: r.text for r in lines.collect()}
    import hashlib
    assert sorted((i, hashlib.sha256(t.encode()).hexdigest()) for i, t in after.items()) == brute_lines(sorted(texts.items()))
    heads = {c for _, _, c in brute.near_duplicates(sorted(after.items()), SHINGLE)}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {i for i in heads for w, h, _ in [brute_hits(after[i], items)] if not (h and 20 * h >= w)}
    out = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in out.collect()} == clean and "text" not in out.columns
