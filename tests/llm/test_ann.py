"""Nearest neighbours against brute force: recall, exact scores, ties, odd vectors."""
import numpy as np
from pyspark.sql import functions as F

from estuary.llm import ann


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, score string, bucket string, t string")


def brute(x, ids, queries, k):
    out = {}
    for q in queries:
        s = (x * x[ids.index(q)]).sum(1)
        order = sorted((i for i in range(len(ids)) if ids[i] != q), key=lambda i: (-s[i], ids[i]))[:k]
        out[q] = [(ids[i], s[i]) for i in order]
    return out


def test_recall_and_exact_scores(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(30, 16))
    x = (centres[rng.integers(0, 30, 3000)] + 0.4 * rng.normal(size=(3000, 16))).astype(np.float32)
    x[::3] = x[0]  # a third of all vectors are equal
    df = frame(spark, [(i, v.tolist(), "a", "b", "c") for i, v in enumerate(x)])
    found = ann.search(df, F.col("vec_id") % 20 == 0).collect()
    truth = brute(x.astype(float), list(range(3000)), range(0, 3000, 20), 20)
    hits = 0
    by_query = {}
    for r in found:
        by_query.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    for q, want in truth.items():
        got = sorted(by_query[q])
        assert [g[0] for g in got] == list(range(1, 21))
        assert [(-s, v) for _, v, s in got] == sorted((-s, v) for _, v, s in got)
        for _, v, s in got:
            assert v != q and abs(s - float(x[q].astype(float) @ x[v].astype(float))) < 1e-9
        hits += len({v for v, _ in want} & {v for _, v, _ in got})
    assert hits / (20 * len(truth)) >= 0.9


def test_few_odd_and_repeated_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 2.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]),
            (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0]), (None, [1.0, 1.0]), (8, [-1.0, 0.0]), (9, []), (40, None)]
    out = ann.search(frame(spark, [(i, v, "a", "b", "c") for i, v in rows]), F.col("vec_id") % 20 == 0).collect()
    got = {}
    for r in sorted(out, key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got == {0: [(1, 1.0), (20, 0.0), (8, -1.0)], 20: [(1, 2.0), (0, 0.0), (8, 0.0)]}


def test_empty_and_single(spark):
    assert ann.search(frame(spark, []), F.col("vec_id") % 20 == 0).collect() == []
    assert ann.search(frame(spark, [(0, [1.0], "a", "b", "c")]), F.col("vec_id") % 20 == 0).collect() == []


def test_probes_come_in_order_of_success():
    """The beam over directions gives the best products, best first."""
    rng = np.random.default_rng(0)
    index = ann.Index(rng.standard_normal((1, 3, 5)), rng.uniform(0, 1, (1, 3)), 0.5, 1.0, np.empty(0, int),
                      np.empty((0, 4)))
    x = rng.normal(size=(4, 4))
    t, row, keys = next(index.probes(x))
    u = index.project(x, True)[0]
    draws = 0.5 * u[:, None, :] + np.sqrt(0.75) * rng.standard_normal((4, 40_000, 3))
    for i in range(4):
        key = np.zeros(40_000, np.int64)
        for j in range(3):
            key = ann._mix_key(key) + index.bins(draws[i, :, j], np.s_[0, j])
        share = {k: c / 40_000 for k, c in zip(*np.unique(key, return_counts=True))}
        mine = [share.get(k, 0.0) for k in keys[row == i]]
        assert abs(sum(mine) - ann.SUCCESS) < 0.1 and all(a >= b - 0.02 for a, b in zip(mine, mine[1:]))


def test_copies_do_not_cost_others_recall(spark):
    """A tenth of the rows are copies; queries outside them still find their neighbours."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(20_000, 32)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[rng.permutation(20_000)[:2000]] = x[1]
    queries = [i for i in range(0, 20_000, 100) if not np.array_equal(x[i], x[1])]
    df = frame(spark, [(i, v.tolist(), "a", "b", "c") for i, v in enumerate(x)])
    got = {}
    for r in ann.search(df, F.col("vec_id").isin(queries)).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    s = x[queries].astype(float) @ x.astype(float).T
    s[np.arange(len(queries)), queries] = -np.inf
    truth = np.argsort(-s, axis=1, kind="stable")[:, :20]
    assert np.mean([len(got[q] & set(t)) / 20 for q, t in zip(queries, truth.tolist())]) >= 0.88


def test_a_cut_query_has_no_probes():
    """The buckets of a query hold the wanted mass in every table, or it has none and meets every row."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(6, 5))
    wide = ann.Index(rng.standard_normal((2, 9, 6)), rng.uniform(0, 1, (2, 9)), 0.0, 1.0, np.empty(0, int), np.empty((0, 5)))
    cosines = np.array([0.2, 0.98, 0.2, 0.98, 0.2, 0.98])
    rows = [set(row.tolist()) for _, row, _ in wide.probes(x, cosines)]
    assert rows == [{1, 3, 5}, {1, 3, 5}]


def test_recall_where_probes_do_not_suffice(spark, monkeypatch):
    """Directions as for a hundred million rows: queries that need too many buckets are not left with some."""
    monkeypatch.setattr(ann, "BUCKET_ROWS", 0.3)
    rng = np.random.default_rng(6)
    x = rng.normal(size=(20_000, 32)).astype(np.float32)
    queries = list(range(0, 20_000, 500))
    df = frame(spark, [(i, v.tolist(), "a", "b", "c") for i, v in enumerate(x)])
    got = {}
    for r in ann.search(df, F.col("vec_id").isin(queries)).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    s = x[queries].astype(float) @ x.astype(float).T
    s[np.arange(len(queries)), queries] = -np.inf
    truth = np.argsort(-s, axis=1, kind="stable")[:, :20]
    assert np.mean([len(got[q] & set(t)) / 20 for q, t in zip(queries, truth.tolist())]) >= 0.88
