"""The pipeline on the smallest table and on edge cases."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from statlake.llm import langid, mixing, pii, queries, simhash_trie

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF).cache()
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        if stage is corpus_pipeline.near_duplicates:
            found = simhash_trie.near_duplicates(docs).select("doc_id", "component_id").distinct()
            assert out.count() == found.select("component_id").distinct().count()
        if stage is corpus_pipeline.personal_data:
            assert out.count() == docs.count()
            assert out.filter(F.size(pii.base_spans(F.col("text"))) > 0).isEmpty()
            assert out.filter("n_chars <> length(text)").isEmpty()
        if stage is corpus_pipeline.mixture:
            times = {r["doc_id"]: r["copies"] for r in mixing.mix(docs, carry=["doc_id"]).collect()}
            got = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
            assert got == {k: v for k, v in times.items() if v}
        docs = out
    ids = corpus_pipeline.encode(spark, docs, SF)
    assert ids.count() == docs.count()


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES])
def test_stage_edges(spark, stage):
    schema = "doc_id long, text string, lang string, source string, n_chars long, ids string, spans int, size int, term string"
    rows = [(1, None, None, None, None, None, None, None, None), (None, "a@b.co in some english words here", None, "s", 1, "x", 1, 1, "t"),
            (2, "", "en", None, 0, "", 0, 0, ""), (2, "", "en", None, 0, "", 0, 0, ""), (3, "word " * 3000, "en", "s", 15000, "", 0, 0, "")]
    for data in (rows, []):
        out = stage(spark, spark.createDataFrame(data, schema), SF)
        assert out.count() <= 2 * len(data)


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 100 and out.filter("n_tokens <> size(ids)").isEmpty()


def test_rejected_documents_have_no_main_language(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    gone = docs.join(langid.keep_identified(docs), "doc_id", "left_anti").count()
    assert gone <= 0.05 * docs.count()
