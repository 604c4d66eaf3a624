"""The pipeline on a small corpus: each stage's decision takes effect."""
import json

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from estuary.llm import mixing, quality, simhash, toxicity
from estuary.llm.common import materialize, table

SF = "/root/testdata/sf0.001"


def test_stages_are_the_operators_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "toxicity", "SimHash near-dedup", "mixing sources to target weights",
        "SentencePiece encoding and decoding"]
    assert "pipeline" in entry.queries() and corpus_pipeline.ORACLE_SQL is None


def test_each_stage_against_its_operator(spark):
    docs = table(spark, SF, "documents")
    labels = table(spark, SF, "labels")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = materialize(stage(spark, docs, SF), "test")
        if k < 4:
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
        if k == 0:
            want = quality.classify(docs, quality.fit(docs, labels)).where("predicted = 1")
        elif k == 1:
            want = toxicity.classify(docs, toxicity.fit(docs, labels)).where("predicted = 0")
        elif k == 2:
            want = simhash.near_duplicates(docs).where("doc_id = component_id")
        elif k == 3:
            size = mixing.word_count("text")
            want = mixing.mix(mixing.document_sizes(docs)).groupBy("doc_id").agg(F.sum("taken").alias("n"))
            got = out.groupBy("doc_id").agg(F.sum(size).alias("n"))
            assert ({(r.doc_id, r.n) for r in got.collect() if r.n} == {(r.doc_id, r.n) for r in want.collect() if r.n})
        if k < 3:
            assert 0 < out.count() <= docs.count() and ids(out) == ids(want)
        if k == 4:
            assert ids(out) == ids(docs)
        docs = out


@pytest.mark.parametrize("kind", ["empty", "odd"])
def test_odd_corpora_run_through(spark, docs_of, odd_rows, tmp_path, kind):
    docs_of(odd_rows if kind == "odd" else []).write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, 1 - i % 2, i % 2) for i in range(0, 60, 2)] + [(i, 1, 0) for i in range(1, 60, 2)] if kind == "odd" else []
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert kind == "odd" or rows == []
    json.dumps([r.n_pieces for r in rows])
