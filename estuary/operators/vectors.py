"""Embedding and array analytics: text prep for reviews, cosine search,
blocked pairwise similarity, splits, forest classifier, report, pooling,
group quantisation, keyed vector deltas, imputation, subgraph gather.

Vectors stay ``ARRAY<FLOAT|DOUBLE>`` and are processed per row with higher-
order functions; per-dimension statistics use ``posexplode`` + groupBy so no
vector set is ever collected into one row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from estuary.functions.exprs import cosine, let, portable_hash, py_strip
from estuary.plans.ordinal import global_ordinal

def combine_text(reviews: DataFrame) -> DataFrame:
    """``"Title: " + Summary.strip() + "; Content: " + Text.strip()``."""
    return reviews.withColumn("combined", F.concat(F.lit("Title: "), py_strip(F.col("Summary")), F.lit("; Content: "),
                                                   py_strip(F.col("Text"))))


def unlabel_text(c: Column) -> Column:
    """Search output form: drop ``"Title: "`` and turn ``"; Content:"`` into ``": "``."""
    return F.replace(F.replace(c, F.lit("Title: "), F.lit("")), F.lit("; Content:"), F.lit(": "))


def recent_top_n(reviews: DataFrame, n: int = 1000, max_chars: int = 500, time_col: str = "Time",
                 key: str = "doc_id") -> DataFrame:
    """Newest 2n rows by time (ties: smaller key), keep combined texts of ≤ max_chars
    characters, then the newest n of those (a top-k report: limit is the feature)."""
    c = combine_text(reviews).withColumn("n_tokens", F.length("combined"))
    order = [F.col(time_col).desc(), F.col(key)]
    return c.orderBy(*order).limit(2 * n).where(F.col("n_tokens") <= max_chars).orderBy(*order).limit(n)


SEARCH_BLOCK = 4096  # corpus rows, and queries, that meet in one task
SEARCH_SLICE = 128  # queries of a block whose similarities are held at once


def _width(column) -> int:
    """Entries of the longest vector (0: none)."""
    return pc.max(pc.list_value_length(column)).as_py() or 0


def _unit_rows(column, dim: int) -> np.ndarray:
    """Rows scaled to length 1; NULL and zero vectors become NaN rows. Taken from Arrow's buffers, no row becomes a list."""
    if pc.any(pc.not_equal(pc.list_value_length(column), dim)).as_py():  # NULL vectors have no length
        raise ValueError("vectors of different lengths")
    x = np.zeros((len(column), dim))
    x[pc.is_valid(column).to_numpy().astype(bool)] = pc.list_flatten(column).to_numpy().reshape(-1, dim)
    length = np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
    np.divide(x, length, out=x, where=length > 0)
    x[~(length[:, 0] > 0)] = np.nan
    return x


def _nearest(rows, asks, k: int) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``asks`` the places and similarities of its k nearest rows, nearest first, ties by place, NaN last."""
    dim = max(1, _width(rows), _width(asks))
    units = _unit_rows(rows, dim).T
    best, found = [], []
    for x in range(0, len(asks), SEARCH_SLICE):
        sim = _unit_rows(asks.slice(x, SEARCH_SLICE), dim) @ units
        # a copy: a view of the first k places would keep the whole order alive
        best.append(np.argsort(np.where(np.isnan(sim), np.inf, -sim), axis=1, kind="stable")[:, :k].copy())
        found.append(np.take_along_axis(sim, best[-1], 1))
    return np.concatenate(best), np.concatenate(found)


def semantic_search(corpus: DataFrame, queries: DataFrame, k: int = 3, key: str = "vec_id",
                    vec: str = "embedding") -> DataFrame:
    """Top-k corpus rows by cosine similarity for each query (query_id, qvec); ties
    go to the smaller key, undefined similarities come last as NULL.

    Corpus and queries are dealt into blocks whose number follows their row counts.
    Each block of one meets each block of the other in a task, which takes the queries in slices of
    SEARCH_SLICE and keeps k rows a query, so it holds the similarities of one slice only; a window
    ranks the k-row lists of all blocks.
    """
    def dealt(df, name):
        n = df.agg(F.greatest(F.ceil(F.count(F.lit(1)) / SEARCH_BLOCK), F.lit(1)).cast("int").alias(name))
        return n  # one row

    nb, nq = dealt(corpus, "_nb"), dealt(queries, "_nq")
    span = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    both = nb.crossJoin(nq)
    rows = (corpus.select(F.col(key).alias("_key"), F.col(vec).alias("_vec")).crossJoin(F.broadcast(both))
            .select("_key", "_vec", F.pmod(F.xxhash64("_key"), F.col("_nb")).cast("int").alias("_b"), span("_nq").alias("_q")))
    asks = (queries.select("query_id", "qvec").crossJoin(F.broadcast(both))
            .select("query_id", "qvec", F.pmod(F.xxhash64("query_id"), F.col("_nq")).cast("int").alias("_q"),
                    span("_nb").alias("_b")))
    schema = T.StructType([T.StructField("query_id", queries.schema["query_id"].dataType),
                           T.StructField(key, corpus.schema[key].dataType), T.StructField("similarity", T.DoubleType())])
    kinds = [(f.name, to_arrow_type(f.dataType)) for f in schema]

    def rank(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({n: pa.array([], t) for n, t in kinds})
        left = left.sort_by("_key")
        best, found = _nearest(left["_vec"], right["qvec"], k)
        found = found.ravel()
        at = pa.array(np.repeat(np.arange(right.num_rows), best.shape[1]))
        out = (right["query_id"].take(at), left["_key"].take(pa.array(best.ravel())),
               pa.array(found, pa.float64(), mask=np.isnan(found)))
        return pa.table({n: c.cast(t) for (n, t), c in zip(kinds, out)})

    local = rows.groupBy("_b", "_q").cogroup(asks.groupBy("_b", "_q")).applyInArrow(rank, schema)
    w = Window.partitionBy("query_id").orderBy(F.col("similarity").desc_nulls_last(), F.col(key))
    return local.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(
        "query_id", "rank", key, "similarity")


def pairwise_similarity(df: DataFrame, block: Column, key: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """All i<j pairs within a block, as the comparison matrix of one short list of
    sentences asks for. The result is quadratic in a block by definition; the
    caller's block key names the lists."""
    b = df.select(block.alias("_blk"), key, vec)
    l = b.select("_blk", F.col(key).alias("i"), F.col(vec).alias("vi"))
    r = b.select("_blk", F.col(key).alias("j"), F.col(vec).alias("vj"))
    return (l.join(r, "_blk").where(F.col("i") < F.col("j"))
            .select("_blk", "i", "j", F.round(cosine("vi", "vj"), 2).alias("similarity")))


def train_test_split(df: DataFrame, key: str, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Deterministic split: order by a portable hash of (seed, key); the first
    ⌈test_size·n⌉ rows are the test set."""
    h = df.withColumn("_h", portable_hash(F.lit(seed), key))
    o = global_ordinal(h, ["_h", key], "_pos", bucket=F.shiftright("_h", 44))
    n = df.agg(F.count(F.lit(1)).alias("_n"))
    return (o.crossJoin(F.broadcast(n))
            .withColumn("is_test", F.col("_pos") < F.ceil(F.col("_n") * test_size))
            .drop("_h", "_pos", "_n"))


def forest_classifier(split: DataFrame, vec: str = "embedding", label: str = "label", trees: int = 100, seed: int = 42):
    """MLlib random forest on all train rows (trained where they lie, level by level; nothing is
    collected but split statistics); predictions for the test rows."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import array_to_vector

    data = split.withColumn("features", array_to_vector(F.col(vec).cast("array<double>"))).withColumn(
        "y", F.col(label).cast("double"))
    model = RandomForestClassifier(numTrees=trees, featuresCol="features", labelCol="y", seed=seed).fit(
        data.where(~F.col("is_test")))
    return model.transform(data.where(F.col("is_test"))).withColumn("pred", F.col("prediction").cast("int"))


def classification_report(pred: DataFrame, label: str = "label", predicted: str = "pred") -> DataFrame:
    """Per-class precision/recall/F1/support, then macro avg, weighted avg and
    accuracy rows (zero division → 0)."""
    cells = pred.groupBy(F.col(label).cast("string").alias("y"), F.col(predicted).cast("string").alias("p")).agg(
        F.count(F.lit(1)).alias("c"))  # the confusion table: one scan, classes squared rows
    zero = F.lit(0).cast("bigint")
    both = F.array(F.struct(F.col("y").alias("cls"), F.when(F.col("y") == F.col("p"), F.col("c")).otherwise(zero).alias("tp"),
                            F.col("c").alias("support"), zero.alias("npred")),
                   F.struct(F.col("p").alias("cls"), zero.alias("tp"), zero.alias("support"), F.col("c").alias("npred")))
    per = cells.select(F.explode(both).alias("e")).groupBy("e.cls").agg(
        *[F.sum(f"e.{c}").alias(c) for c in ("tp", "support", "npred")])
    z = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))
    per = per.select("cls", z(F.col("tp"), F.col("npred")).alias("precision"), z(F.col("tp"), F.col("support")).alias("recall"),
                     "support", "tp")
    per = per.withColumn("f1", z(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    tot = per.agg(F.sum("support").alias("n"), F.sum("tp").alias("correct"), F.count(F.lit(1)).alias("k"),
                  F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
                  F.sum(F.col("precision") * F.col("support")).alias("wp"), F.sum(F.col("recall") * F.col("support")).alias("wr"),
                  F.sum(F.col("f1") * F.col("support")).alias("wf"))
    macro = tot.select(F.lit("macro avg").alias("cls"), F.col("mp").alias("precision"), F.col("mr").alias("recall"),
                       F.col("mf").alias("f1"), F.col("n").alias("support"))
    weighted = tot.select(F.lit("weighted avg").alias("cls"), z(F.col("wp"), F.col("n")).alias("precision"),
                          z(F.col("wr"), F.col("n")).alias("recall"), z(F.col("wf"), F.col("n")).alias("f1"),
                          F.col("n").alias("support"))
    acc = tot.select(F.lit("accuracy").alias("cls"), F.lit(None).cast("double").alias("precision"),
                     F.lit(None).cast("double").alias("recall"), z(F.col("correct"), F.col("n")).alias("f1"),
                     F.col("n").alias("support"))
    return per.select("cls", "precision", "recall", "f1", "support").unionByName(macro).unionByName(weighted).unionByName(acc)


def _mean_vector(df: DataFrame, vec: str, by: list[str]) -> DataFrame:
    """Per-group mean vector with MLlib's Summarizer (a JVM aggregate with
    partial aggregation: one vector per partition and group is shuffled, never
    one row per element)."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    v = df.select(*by, array_to_vector(F.col(vec).cast("array<double>")).alias("_v"))
    g = v.groupBy(*by) if by else v
    return g.agg(Summarizer.mean(F.col("_v")).alias("_m")).select(*by, vector_to_array("_m").alias("mean"))


def masked_mean_pool(tokens: DataFrame, doc: str, vec: str, mask: str, eps: float = 1e-12) -> DataFrame:
    """Σ(hidden × mask) / Σ mask per document, then L2-normalised (norm floored
    at eps). Long form (doc, dim, value)."""
    m = _mean_vector(tokens.where(F.col(mask)), vec, [doc])
    nrm = F.sqrt(F.aggregate("mean", F.lit(0.0), lambda a, x: a + x * x))
    pooled = m.select(doc, F.transform("mean", lambda x: x / F.greatest(nrm, F.lit(eps))).alias("_p"))
    return pooled.select(doc, F.posexplode("_p").alias("dim", "value"))


def batch_index(items: DataFrame, order: list[str], tokens: Column, size: int = 4) -> DataFrame:
    """Batches of ``size`` in input order; global index = batch·size + i; token
    sums per batch."""
    o = global_ordinal(items.withColumn("_tok", tokens), order, "index")
    return o.withColumn("batch", F.floor(F.col("index") / size)).withColumn("i", F.col("index") % size)


def quantized(vec: Column, group: int = 256, bits: int = 8, symmetric: bool = True) -> Column:
    """Group-wise quantisation of a vector, its groups kept in the row: array<struct<grp, codes, scale,
    mn>>. Groups of ``group`` values, the
    last zero-padded (pad zeros take part in min/max); symmetric scale =
    B / max|x|, asymmetric scale = B / (max − min); clamp, round half-even.
    An all-zero group has no finite scale: its codes are 0 (the reference
    divides by zero)."""
    x = vec.cast("array<double>")
    b = float(2 ** (bits - 1) - 1 if symmetric else 2 ** bits - 1)

    def codes(v: Column, scaled, low: float) -> Column:
        return F.transform(v, lambda s: F.coalesce(
            F.bround(F.greatest(F.least(scaled(s), F.lit(b)), F.lit(low)), 0).cast("int"), F.lit(0)))

    def symmetric_group(g: Column, v: Column) -> Column:
        # the group's scale is bound once, not evaluated again for every element of the lambda
        return let(F.try_divide(F.lit(b), F.array_max(F.transform(v, F.abs))), lambda sc: F.struct(
            g.alias("grp"), codes(v, lambda s: s * sc, -b).alias("codes"), sc.alias("scale"), F.lit(None).cast("double").alias("mn")))

    def asymmetric_group(g: Column, v: Column) -> Column:
        pad = F.when(F.size(v) < group, F.lit(0.0))  # least and greatest skip NULL
        low, high = F.least(F.array_min(v), pad), F.greatest(F.array_max(v), pad)
        return let(F.struct(low.alias("mn"), F.try_divide(F.lit(b), high - low).alias("scale")), lambda p: F.struct(
            g.alias("grp"), codes(v, lambda s: (s - p["mn"]) * p["scale"], 0.0).alias("codes"), p["scale"].alias("scale"),
            p["mn"].alias("mn")))

    one = symmetric_group if symmetric else asymmetric_group
    last = F.greatest(F.ceil(F.size(x) / group) - 1, F.lit(0)).cast("int")
    return let(x, lambda xs: F.transform(F.sequence(F.lit(0), last),
                                         lambda g: let(F.slice(xs, g * group + 1, F.lit(group)), lambda v: one(g, v))))


def dequantized(groups: Column) -> Column:
    """codes / scale (+ mn) of all groups, in order; padding is never stored. One row's groups make its
    vector: no shuffle."""
    return F.flatten(F.transform(groups, lambda g: F.transform(g["codes"], lambda c: F.coalesce(
        F.try_divide(c.cast("double"), g["scale"]), F.lit(0.0)) + F.coalesce(g["mn"], F.lit(0.0)))))


def quantize_groups(df: DataFrame, key: str, vec: str, group: int = 256, bits: int = 8, symmetric: bool = True) -> DataFrame:
    """:func:`quantized` in long form (key, grp, codes, scale, mn): one row for each group."""
    return df.select(key, F.explode(quantized(F.col(vec), group, bits, symmetric)).alias("_g")).select(key, "_g.*")


def dequantize_groups(q: DataFrame, key: str) -> DataFrame:
    """:func:`dequantized` of the long form, whose rows have to be brought together again (one vector's
    groups per key – bounded by the vector length)."""
    g = q.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("grp", "codes", "scale", "mn"))).alias("_g"))
    return g.select(key, dequantized(F.col("_g")).alias("values"))


def array_delta_make(base: DataFrame, target: DataFrame, key: str = "name") -> tuple[DataFrame, DataFrame]:
    """(delta = target − base per key, keys of target missing from base)."""
    j = target.join(base, key, "inner")
    delta = j.select(key, F.zip_with("target_values", "base_values", lambda t, b: t.cast("double") - b.cast("double")).alias("delta"))
    missing = target.select(key).join(base.select(key), key, "left_anti")
    return delta, missing


def array_delta_apply(base: DataFrame, delta: DataFrame, key: str = "name") -> DataFrame:
    """base + delta per key, with the element count of each result."""
    j = base.join(delta, key, "inner")
    return j.select(key, F.zip_with("base_values", "delta", lambda b, d: b.cast("double") + d).alias("values")).withColumn(
        "size", F.size("values"))


def mean_vector_impute(df: DataFrame, key: str, vec: str, is_new: Column) -> DataFrame:
    """Rows flagged new get the per-dimension mean of the existing rows (one
    global Summarizer mean: a single vector, attached by a broadcast)."""
    mvec = _mean_vector(df.where(~is_new), vec, []).select(F.col("mean").alias("_mean"))
    return df.crossJoin(F.broadcast(mvec)).select(
        key, F.when(is_new, F.col("_mean")).otherwise(F.col(vec).cast("array<double>")).alias(vec), is_new.alias("imputed"))


def gather_subgraph(items: DataFrame, nodes: DataFrame, node_key: str = "vec_id", feat: str = "embedding") -> DataFrame:
    """Node features in ``node_list`` order per item plus its edge index and
    target node; the graph type is the id prefix before the first ``_``."""
    e = items.select("id", "node_idx", "edge_index", F.posexplode("node_list").alias("pos", "node"))
    j = e.join(nodes.select(F.col(node_key).alias("node"), feat), "node", "left")
    return j.groupBy("id", "node_idx").agg(
        F.sort_array(F.collect_list(F.struct("pos", "node", feat))).alias("_n"), F.first("edge_index").alias("edge_index")
    ).select("id", "node_idx", F.split("id", "_")[0].alias("graph_type"),
             F.transform("_n", lambda s: s["node"]).alias("node_list"),
             F.transform("_n", lambda s: s[feat]).alias("features"), "edge_index")
