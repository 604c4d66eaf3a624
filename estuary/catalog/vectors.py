"""Registered queries of the embedding/array group and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from estuary.catalog.common import flat
from estuary.catalog.fixtures_sql import with_recipes
from estuary.operators import vectors as V
from estuary.sources import tables as TB


def _emb(spark, d):
    return TB.table(spark, d, "embeddings").select("vec_id", "embedding", "label")


def _reviews(spark, d):
    """``scan_reviews`` rules on the review recipe: rows with any NULL dropped."""
    return TB.reviews(spark, d).na.drop(how="any", subset=["Time", "ProductId", "Score", "Summary", "Text"])


def q_combine_text(spark, d):
    c = V.combine_text(_reviews(spark, d))
    return flat(c.select("doc_id", F.length("combined").alias("n_chars"), F.md5("combined").alias("md5"),
                         F.substring("combined", 1, 60).alias("head")))


def q_recent_top_n(spark, d):
    r = V.recent_top_n(_reviews(spark, d), n=1000, max_chars=500)
    return flat(r.select("doc_id", "Time", "n_tokens"))


def q_cosine_similarity(spark, d):
    e = _emb(spark, d)
    n = e.agg(F.count(F.lit(1)).alias("_n"))
    nxt = e.select(F.col("vec_id").alias("j"), F.col("embedding").alias("other"))
    pairs = e.crossJoin(F.broadcast(n)).withColumn("j", F.pmod(F.col("vec_id") + 1, F.col("_n"))).join(nxt, "j")
    return flat(pairs.select("vec_id", "j", F.round(V.cosine("embedding", "other"), 6).alias("similarity")))


def _queries(spark, d):
    """Every twentieth vector asks."""
    return _emb(spark, d).where(F.col("vec_id") % 20 == 0).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("qvec"))


def q_semantic_search(spark, d):
    s = V.semantic_search(_emb(spark, d), _queries(spark, d), k=3)
    return flat(s.select("query_id", "rank", "vec_id", F.round("similarity", 6).alias("similarity")))


def q_pairwise_similarity(spark, d):
    e = _emb(spark, d)
    p = V.pairwise_similarity(e, F.concat_ws("_", F.col("label").cast("string"), F.floor(F.col("vec_id") / 10).cast("string")))
    return flat(p.select("i", "j", "similarity"))


def q_train_test_split(spark, d):
    return flat(V.train_test_split(_emb(spark, d).select("vec_id", "label"), "vec_id").select("vec_id", "is_test"))


def q_forest_classifier(spark, d):
    split = V.train_test_split(_emb(spark, d), "vec_id")
    p = V.forest_classifier(split, trees=100)
    return flat(p.select("vec_id", "label", "pred"))


def q_classification_report(spark, d):
    r = V.classification_report(TB.labelled(spark, d))
    return flat(r.select("cls", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support"))


def q_masked_mean_pool(spark, d):
    e = _emb(spark, d).withColumn("mask", F.col("vec_id") % 3 != 0)
    p = V.masked_mean_pool(e, "label", "embedding", "mask")
    return flat(p.select("label", "dim", F.round("value", 6).alias("value")))


def q_batch_index(spark, d):
    docs = TB.table(spark, d, "documents").select("doc_id", "text")
    b = V.batch_index(docs.select("doc_id", "text"), ["doc_id"], F.size(F.filter(F.split("text", r"\s+"), lambda w: w != "")))
    return flat(b.groupBy("batch").agg(F.count(F.lit(1)).alias("n_inputs"), F.min("index").alias("first_index"),
                                       F.sum("_tok").alias("token_sum")))


def _q(spark, d, symmetric=True):
    return V.quantize_groups(_emb(spark, d), "vec_id", "embedding", group=256, bits=8, symmetric=symmetric)


def q_quantize_groups(spark, d):
    q = _q(spark, d)
    return flat(q.select("vec_id", "grp", F.posexplode("codes").alias("pos", "code"), F.round("scale", 6).alias("scale")))


def q_quantize_groups_asymmetric(spark, d):
    """Groups of 24 over 64 values: three groups, the last one padded."""
    q = V.quantize_groups(_emb(spark, d), "vec_id", "embedding", group=24, bits=8, symmetric=False)
    return flat(q.select("vec_id", "grp", F.posexplode("codes").alias("pos", "code"), F.round("scale", 6).alias("scale"),
                         F.round("mn", 6).alias("mn")))


def q_dequantize_groups(spark, d):
    codes = V.quantized(F.col("embedding"), group=256, bits=8)
    j = _emb(spark, d).select("vec_id", "embedding", V.dequantized(codes).alias("values"))
    err = F.array_max(F.zip_with("values", "embedding", lambda a, b: F.abs(a - b.cast("double"))))
    return flat(j.select("vec_id", F.size("values").alias("n"), F.round(err, 6).alias("max_abs_error"),
                         F.round(F.aggregate("values", F.lit(0.0), lambda a, x: a + x), 4).alias("value_sum")))


def q_array_delta_make(spark, d):
    p = TB.params(spark, d)
    delta, missing = V.array_delta_make(p.select("name", "base_values"), p.select("name", "target_values"))
    return flat(delta.select("name", F.size("delta").alias("n"),
                             F.round(F.aggregate("delta", F.lit(0.0), lambda a, x: a + x), 4).alias("delta_sum")))


def q_array_delta_apply(spark, d):
    p = TB.params(spark, d)
    delta, _ = V.array_delta_make(p.select("name", "base_values"), p.select("name", "target_values"))
    a = V.array_delta_apply(p.select("name", "base_values"), delta).join(p.select("name", "target_values"), "name")
    err = F.array_max(F.zip_with("values", "target_values", lambda x, t: F.abs(x - t)))
    return flat(a.select("name", "size", (err < 1e-9).alias("exact")))


def q_mean_vector_impute(spark, d):
    e = _emb(spark, d)
    m = V.mean_vector_impute(e, "vec_id", "embedding", F.col("label") == 9)
    return flat(m.select("vec_id", "imputed", F.posexplode("embedding").alias("dim", "v")).select(
        "vec_id", "imputed", "dim", F.round("v", 6).alias("value")))


def q_gather_subgraph(spark, d):
    g = V.gather_subgraph(TB.graph_items(spark, d), _emb(spark, d))
    e = g.select("id", "node_idx", "graph_type", F.posexplode(F.arrays_zip("node_list", "features")).alias("pos", "z"))
    return flat(e.select("id", "node_idx", "graph_type", "pos", F.col("z.node_list").alias("node"),
                         F.round(F.aggregate(F.col("z.features"), F.lit(0.0), lambda a, x: a + x.cast("double")), 4).alias("feat_sum")))


QUERIES = {k[2:]: v for k, v in globals().items() if k.startswith("q_")}

WS = r"[\s\p{Z}\x{1c}-\x{1f}\x{85}]"
COMBINED = (f"'Title: ' || regexp_replace(Summary, '^{WS}+|{WS}+$', '', 'g') || '; Content: ' || "
            f"regexp_replace(Text, '^{WS}+|{WS}+$', '', 'g')")
REV = "rv as (select * from reviews where \"Time\" is not null and ProductId is not null and Score is not null and Summary is not null and Text is not null)"
COS = ("list_dot_product({a}::double[], {b}::double[]) / (sqrt(list_dot_product({a}::double[], {a}::double[])) * "
       "sqrt(list_dot_product({b}::double[], {b}::double[])))")

ORACLE = {
    "combine_text": with_recipes("reviews", f"""
with {REV}, c as (select doc_id, {COMBINED} combined from rv)
select doc_id, length(combined) n_chars, md5(combined) md5, substr(combined, 1, 60) head from c"""),
    "recent_top_n": with_recipes("reviews", f"""
with {REV}, c as (select doc_id, "Time", length({COMBINED}) n_tokens from rv),
t as (select * from c order by "Time" desc, doc_id limit 2000)
select doc_id, "Time", n_tokens from t where n_tokens <= 500 order by "Time" desc, doc_id limit 1000"""),
    "cosine_similarity": f"""
with e as (select vec_id, embedding from embeddings), n as (select count(*) n from e)
select a.vec_id, b.vec_id j, round({COS.format(a='a.embedding', b='b.embedding')}, 6) similarity
from e a, n join e b on b.vec_id = (a.vec_id + 1) % n.n""",
    "semantic_search": f"""
with q as (select vec_id query_id, embedding qvec from embeddings where vec_id % 20 = 0),
s as (select q.query_id, c.vec_id, {COS.format(a='c.embedding', b='q.qvec')} similarity from q, embeddings c),
r as (select *, row_number() over (partition by query_id order by similarity desc nulls last, vec_id) "rank" from s)
select query_id, "rank", vec_id, round(similarity, 6) similarity from r where "rank" <= 3""",
    "pairwise_similarity": f"""
with e as (select vec_id, embedding, label || '_' || (vec_id // 10) blk from embeddings)
select a.vec_id i, b.vec_id j, round({COS.format(a='a.embedding', b='b.embedding')}, 2) similarity
from e a join e b on a.blk = b.blk and a.vec_id < b.vec_id""",
    "train_test_split": """
with h as (select vec_id, ('0x' || substr(md5(concat_ws('|', '42', cast(vec_id as varchar))), 1, 15))::bigint hv from embeddings),
o as (select vec_id, row_number() over (order by hv, vec_id) - 1 pos, count(*) over () n from h)
select vec_id, pos < ceil(n * 0.2) is_test from o""",
    "classification_report": with_recipes("labelled", """
with t as (select cast(label as varchar) y, cast(pred as varchar) p from labelled),
cls as (select y c from t union select p from t),
per as (select c cls, count(*) filter (where t.y = c and t.p = c) tp, count(*) filter (where t.y = c) support,
               count(*) filter (where t.p = c) npred from cls, t group by c),
m as (select cls, coalesce(tp / nullif(npred, 0), 0.0) "precision", coalesce(tp / nullif(support, 0), 0.0) recall, support, tp from per),
f as (select *, coalesce(2 * "precision" * recall / nullif("precision" + recall, 0), 0.0) f1 from m),
tot as (select sum(support) n, sum(tp) correct, avg("precision") mp, avg(recall) mr, avg(f1) mf,
               sum("precision" * support) wp, sum(recall * support) wr, sum(f1 * support) wf from f)
select cls, round("precision", 6) "precision", round(recall, 6) recall, round(f1, 6) f1, cast(support as bigint) support from f
union all select 'macro avg', round(mp, 6), round(mr, 6), round(mf, 6), cast(n as bigint) from tot
union all select 'weighted avg', round(wp / n, 6), round(wr / n, 6), round(wf / n, 6), cast(n as bigint) from tot
union all select 'accuracy', null, null, round(correct / n, 6), cast(n as bigint) from tot"""),
    "masked_mean_pool": """
with e as (select label, unnest(range(0, 64)) dim, unnest(embedding::double[]) v from embeddings where vec_id % 3 <> 0),
m as (select label, dim, avg(v) m from e group by 1, 2),
n as (select label, sqrt(sum(m * m)) nn from m group by 1)
select cast(m.label as bigint) label, cast(m.dim as bigint) dim, round(m.m / greatest(n.nn, 1e-12), 6) "value" from m join n using (label)""",
    "batch_index": r"""
with o as (select doc_id, row_number() over (order by doc_id) - 1 idx, len(list_filter(string_split_regex(text, '\s+'), lambda w: w <> '')) tok from documents)
select cast(idx // 4 as bigint) batch, count(*) n_inputs, min(idx) first_index, cast(sum(tok) as bigint) token_sum from o group by 1""",
    "quantize_groups": """
with e as (select vec_id, unnest(range(0, len(embedding))) pos, unnest(embedding::double[]) x from embeddings),
g as (select vec_id, max(abs(x)) amax from e group by vec_id)
select e.vec_id, cast(0 as bigint) grp, cast(e.pos as bigint) pos,
       cast(coalesce(round_even(greatest(least(x * (127 / nullif(amax, 0)), 127), -127), 0), 0) as bigint) code,
       round(127 / nullif(amax, 0), 6) scale
from e join g using (vec_id)""",
    "quantize_groups_asymmetric": """
with e as (select vec_id, unnest(range(0, len(embedding))) pos, unnest(embedding::double[]) x, len(embedding) n from embeddings),
g as (select vec_id, pos // 24 grp, min(x) mn0, max(x) mx0, count(*) < 24 padded from e group by all),
s as (select vec_id, grp, case when padded then least(mn0, 0.0) else mn0 end mn, case when padded then greatest(mx0, 0.0) else mx0 end mx from g)
select e.vec_id, cast(s.grp as bigint) grp, cast(e.pos % 24 as bigint) pos,
       cast(coalesce(round_even(greatest(least((x - mn) * (255 / nullif(mx - mn, 0)), 255), 0), 0), 0) as bigint) code,
       round(255 / nullif(mx - mn, 0), 6) scale, round(mn, 6) mn
from e join s on s.vec_id = e.vec_id and s.grp = e.pos // 24""",
    "dequantize_groups": """
with e as (select vec_id, unnest(range(0, len(embedding))) pos, unnest(embedding::double[]) x from embeddings),
g as (select vec_id, 127 / nullif(max(abs(x)), 0) scale from e group by vec_id),
q as (select e.vec_id, e.pos, e.x, coalesce(round_even(greatest(least(x * scale, 127), -127), 0) / scale, 0.0) v from e join g using (vec_id))
select vec_id, count(*) n, round(max(abs(v - x)), 6) max_abs_error, round(sum(v order by pos), 4) value_sum from q group by vec_id""",
    "array_delta_make": with_recipes("params", """
select name, cast(len(base_values) as bigint) n,
       round(list_sum(list_transform(list_zip(target_values, base_values), lambda z: z[1]::double - z[2]::double)), 4) delta_sum from params"""),
    "array_delta_apply": with_recipes("params", "select name, cast(len(base_values) as bigint) size, true exact from params"),
    "mean_vector_impute": """
with e as (select vec_id, label, unnest(range(0, 64)) dim, unnest(embedding::double[]) v from embeddings),
m as (select dim, avg(v) m from e where label <> 9 group by dim)
select e.vec_id, e.label = 9 imputed, cast(e.dim as bigint) dim, round(case when e.label = 9 then m.m else e.v end, 6) "value"
from e join m using (dim)""",
    "gather_subgraph": with_recipes("graph_items", """
with n as (select id, node_idx, unnest(range(0, 3)) pos, unnest(node_list) node from graph_items)
select n.id, n.node_idx, split_part(n.id, '_', 1) graph_type, cast(n.pos as bigint) pos, n.node,
       round(list_sum(e.embedding::double[]), 4) feat_sum
from n left join embeddings e on e.vec_id = n.node"""),
}
