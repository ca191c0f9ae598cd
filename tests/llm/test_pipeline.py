"""The pipeline's stages on the smallest tables, and all registered queries."""

import pytest

from llm import decontamination, ngram_join, quality, queries
from tests.llm import brute

corpus_pipeline = pytest.importorskip("corpus_pipeline")
SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination", "packing",
    ]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == columns, name
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
        assert ids <= {r.doc_id for r in before.select("doc_id").collect()}
        if name == "quality_classifier":
            labels = spark.read.parquet(f"{SF}/labels.parquet")
            scored = quality.score_quality(before, labels).filter("predicted = 1")
            assert ids == {r.doc_id for r in scored.collect()}
        if name == "ngram_jaccard_join":
            rows = [(r.doc_id, r.text) for r in before.collect()]
            assert ids == {d for d, n, c in brute.jaccard_join(rows, 5, 80) if c == d}
        if name == "benchmark_decontamination":
            benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
            assert decontamination.find_leaks(docs, benchmark).count() == 0
            leaking = {r.doc_id for r in decontamination.find_leaks(before, benchmark).collect()}
            assert leaking and ids == {r.doc_id for r in before.collect()} - leaking
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == ids


def test_run_is_its_stages(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and "sequence_id" in out.columns


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_reads_all_documents(spark, name):
    out = queries.QUERIES[name](spark, SF)
    if name == "op11_spelling_variants":  # rows are words
        assert out.columns[:2] == ["word", "form"] and out.count() > 0
        return
    assert "doc_id" in out.columns
    if name != "op6_decontamination":
        assert out.select("doc_id").distinct().count() == 200


def test_pipeline_joins_by_five_words_and_four_fifths():
    assert (corpus_pipeline.SHINGLE_WORDS, corpus_pipeline.SIMILAR_PERCENT) == (5, 80)
    assert (ngram_join.WORDS, ngram_join.PERCENT) == (4, 85)
