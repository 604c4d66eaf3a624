
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from estuary.operators import serving as SV
from estuary.operators import vectors as V
from tests.conftest import SF01


def _emb(spark):
    return spark.read.parquet(f"{SF01}/embeddings.parquet")


def test_quantize_roundtrip_error_half_step(spark):
    e = _emb(spark)
    q = V.quantize_groups(e, "vec_id", "embedding", group=256, bits=8, symmetric=True)
    dq = V.dequantize_groups(q, "vec_id").join(q.select("vec_id", "scale"), "vec_id").join(e, "vec_id")
    packed = e.select("vec_id", V.dequantized(V.quantized(F.col("embedding"), 24, 8, False)).alias("v"))
    long = V.dequantize_groups(V.quantize_groups(e, "vec_id", "embedding", 24, 8, False), "vec_id")
    assert packed.join(long, "vec_id").where("v = values").count() == e.count()
    assert "Exchange" not in packed._jdf.queryExecution().executedPlan().toString()
    worst = dq.select(F.array_max(F.zip_with("values", "embedding", lambda a, b: F.abs(a - b.cast("double")) * F.col("scale"))).alias("w")) \
        .agg(F.max("w")).first()[0]
    assert worst <= 0.5 + 1e-9


def test_pooled_norm_is_one(spark):
    e = _emb(spark).withColumn("mask", F.lit(True))
    p = V.masked_mean_pool(e, "label", "embedding", "mask")
    norms = p.groupBy("label").agg(F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("n")).collect()
    assert all(abs(r.n - 1) < 1e-9 for r in norms)


def test_semantic_search_matches_bruteforce(spark):
    e = _emb(spark)
    rows = e.collect()
    q = spark.createDataFrame([(-1, rows[0].embedding)], "query_id long, qvec array<float>")
    got = [r.vec_id for r in V.semantic_search(e, q, k=3).orderBy("rank").collect()]
    qv = np.array(rows[0].embedding, dtype=float)
    sims = sorted(((float(np.dot(qv, np.array(r.embedding, dtype=float)) /
                         (np.linalg.norm(qv) * np.linalg.norm(np.array(r.embedding, dtype=float)))), r.vec_id) for r in rows),
                  key=lambda x: (-x[0], x[1]))
    assert got == [v for _, v in sims[:3]]


def test_search_holds_one_slice_of_similarities():
    """A full block of rows and queries: the nearest are those of the whole product, which is never held."""
    rng = np.random.default_rng(3)
    rows, asks = (rng.normal(size=(n, 8)) for n in (V.SEARCH_BLOCK, 1000))
    lists = [pa.chunked_array([pa.array([None, *x.tolist()], pa.list_(pa.float64()))]) for x in (rows, asks)]
    tracemalloc.start()
    best, found = V._nearest(*lists, 3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < V.SEARCH_BLOCK * len(asks) * 8  # one product alone would take that
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    sim = unit(asks) @ unit(rows).T
    want = np.argsort(-sim, axis=1, kind="stable")[:, :3]
    assert (best[1:] == want + 1).all() and np.allclose(found[1:], np.take_along_axis(sim, want, 1))
    assert best[0].tolist() == [0, 1, 2] and np.isnan(found[0]).all()


def test_search_with_null_zero_and_empty_sides(spark):
    e = spark.createDataFrame([(1, None), (2, [0.0, 0.0]), (3, [1.0, None]), (4, [1.0, 0.0])], "vec_id long, embedding array<float>")
    q = spark.createDataFrame([(7, None), (8, [2.0, 0.0])], "query_id long, qvec array<float>")
    got = sorted(tuple(r) for r in V.semantic_search(e, q, k=4).select("query_id", "rank", "vec_id", "similarity").collect())
    assert got == [(7, 1, 1, None), (7, 2, 2, None), (7, 3, 3, None), (7, 4, 4, None),
                   (8, 1, 4, 1.0), (8, 2, 1, None), (8, 3, 2, None), (8, 4, 3, None)]


def test_deltas_reassemble_last_text(spark):
    chunks = spark.createDataFrame([(1, 1, "he", None), (1, 2, "hell�", None), (1, 3, "hello", None), (1, 4, "hello", "stop")],
                                   "stream_id long, seq int, text string, finish_reason string")
    d = SV.cumulative_to_delta(chunks)
    c = SV.delta_to_cumulative(d)
    last = c.orderBy(F.col("out_order").desc()).first()
    assert last.text == "hello" and last.finish_reason == "stop"
    assert [r.delta for r in d.orderBy("out_order").collect()] == ["he", "ll", "o", None]


def test_one_model_pair_sample(spark):
    b = spark.range(5).withColumnRenamed("id", "battle_id")
    m = spark.createDataFrame([("only",)], "model string")
    rows = SV.weighted_pair_sample(b, m).collect()
    assert all(r.model_left == r.model_right == "only" for r in rows)
    m2 = spark.createDataFrame([("x",), ("y",), ("z",)], "model string")
    rows = SV.weighted_pair_sample(spark.range(200).withColumnRenamed("id", "battle_id"), m2).collect()
    assert all(r.model_left != r.model_right for r in rows)


def test_first_match_rule(spark):
    names = ["vicuna-13b", "fastchat-t5-3b", "gpt-4", "Alpaca-7B", "oasst-sft-1-pythia-12b", "bard", "claude-x", "mpt-7b"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r.a for r in df.select(SV.first_match_rule(F.col("n")).alias("a")).collect()]
    assert got == ["vicuna", "t5", "chatgpt", "alpaca", "oasst_pythia", "bard", "base", "mpt"]


def test_validate_first_failing_rule(spark):
    df = spark.createDataFrame([(1, 0, 0, -1.0, 2.0), (2, 5, 1, 3.0, 2.0), (3, 5, 1, 1.0, 1.5), (4, None, None, None, None)],
                               "request_id long, max_tokens int, n int, temperature double, top_p double")
    got = {r.request_id: r.error_message for r in SV.validate_requests(df).collect()}
    assert got[1] == "0 is less than the minimum of 1 - 'max_tokens'"
    assert got[2] == "3.0 is greater than the maximum of 2 - 'temperature'"
    assert got[3] == "1.5 is greater than the maximum of 1 - 'temperature'"
    assert got[4] is None


def test_asymmetric_quantize_roundtrip(spark):
    e = _emb(spark)
    q = V.quantize_groups(e, "vec_id", "embedding", group=16, bits=8, symmetric=False)
    sc = q.groupBy("vec_id").agg(F.min("scale").alias("smin"))
    dq = V.dequantize_groups(q, "vec_id").join(sc, "vec_id").join(e, "vec_id")
    errs = dq.select(F.array_max(F.zip_with("values", "embedding", lambda a, b: F.abs(a - b.cast("double")))).alias("err"),
                     "smin").collect()
    assert all(r.err * r.smin <= 0.5 + 1e-9 for r in errs)
