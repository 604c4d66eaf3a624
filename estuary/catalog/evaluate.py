"""Registered queries of the batch-evaluation group and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from estuary.catalog import series as CS
from estuary.catalog.common import flat, scratch_path
from estuary.catalog.fixtures_sql import with_recipes
from estuary.operators import evaluate as EV
from estuary.operators import runner as RN
from estuary.operators import text as X
from estuary.sources import tables as TB


def _ids(spark, d):
    return CS._rendered(spark, d).select("id", "n", "t", "gpt")


def q_id_range_slice(spark, d):
    return flat(EV.id_range_slice(_ids(spark, d), ["t", "n"], 5, 115).select("id", "pos"))


def _chunks(spark, d):
    return EV.chunk_assign(_ids(spark, d), ["t", "n"], 8)


def q_chunk_assign(spark, d):
    return flat(_chunks(spark, d).select("id", "pos", "chunk"))


def q_resume_pending(spark, d):
    c = _chunks(spark, d)
    done = c.where(F.col("pos") - F.col("chunk_start") < 7)
    return flat(EV.resume_pending(c, done).select("id", "chunk"))


def _answer_sizes(batches):
    """A stand-in for a model run: any callable over pandas frames."""
    for b in batches:
        yield b[["id"]].assign(n_chars=b["gpt"].str.len(), n_words=b["gpt"].str.split().str.len())


def q_run_resumable(spark, d):
    out = RN.run_resumable(_ids(spark, d).select("id", "gpt"), "id", _answer_sizes, "id string, n_chars long, n_words long",
                           scratch_path(spark, "runs"), slices=8)
    return flat(out)


def q_assemble_results(spark, d):
    w = CS._windows(spark, d)
    ids = _ids(spark, d).select("id", "n", "t", "gpt")
    j = ids.join(w, ["n", "t"])
    last = lambda c: F.array_repeat(F.element_at(c, -1), 12)
    s = lambda c: F.round(F.aggregate(c, F.lit(0.0), lambda a, x: a + x), 6)
    return flat(j.select("id", EV.strip_stop_suffix(F.col("gpt"), "</s>").alias("res"),
                         s(F.col("x_sediment")).alias("x_in"), s(F.col("x_discharge")).alias("x_out"),
                         s(F.col("y_sediment")).alias("y_in"), s(F.col("y_discharge")).alias("y_out"),
                         s(last(F.col("x_sediment"))).alias("st_pre_infolow"), s(last(F.col("x_discharge"))).alias("st_pre_outfolow")))


def _pred(spark, d):
    return TB.predictions(spark, d).where(F.col("y_pred").isNotNull())


def q_mae(spark, d):
    p = _pred(spark, d)
    return flat(p.agg(F.round(EV.mae(p, "y_true", "y_pred"), 6).alias("mae")))


def q_mae_masked(spark, d):
    p = _pred(spark, d)
    mask = F.when(F.col("y_true") > 10, F.lit(1.0)).otherwise(F.lit(0.0))
    return flat(p.agg(F.round(EV.mae(p, "y_true", "y_pred", mask_value=5.0), 6).alias("mae_mask_value"),
                      F.round(EV.mae(p, "y_true", "y_pred", mask=mask), 6).alias("mae_mask")))


def q_binarize_labels(spark, d):
    p = TB.predictions(spark, d)
    return flat(p.select("event_id", EV.binarize(F.col("y_true") / 10).alias("label")))


def q_bce_with_logits(spark, d):
    p = _pred(spark, d)
    x = (F.col("y_pred") - 10) / 5
    return flat(p.agg(F.round(F.avg(EV.bce_with_logits(x, EV.binarize(F.col("y_true") / 10))), 6).alias("bce")))


def q_task_route(spark, d):
    w = CS._windows(spark, d)
    p = CS._parsed(spark, d)
    j = p.join(w.select("n", "t", F.array(F.element_at("x_sediment", 1), F.element_at("x_discharge", 1)).alias("features")),
               (p.snapshot == w.t) & (p.region_start == w.n))
    task, route = EV.task_route(F.col("features"))
    return flat(j.select("id", F.round(task, 6).alias("task_type"), route.alias("route")))


def q_echo_mismatch(spark, d):
    t = TB.turns(spark, d)
    u = t.where(F.col("role") == "user").select("conv_id", "i", F.col("text").alias("prompt"))
    a = t.where(F.col("role") == "assistant").select("conv_id", (F.col("i") - 1).alias("i"), F.col("text").alias("reply"))
    j = u.join(a, ["conv_id", "i"])
    return flat(j.select("conv_id", "i", EV.echo_mismatch(X.token_ids(F.col("prompt")), X.token_ids(F.col("reply"))).alias("n_diff")))


QUERIES = {k[2:]: v for k, v in globals().items() if k.startswith("q_")}

ORD = "o as (select id, n, t, row_number() over (order by t, n) - 1 pos, count(*) over () total from rendered)"
CH = "c as (select id, pos, least(pos // greatest(total // 8, 1), 7) chunk, greatest(total // 8, 1) sz from o)"
PRED = "p as (select * from predictions where y_pred is not null)"
TOKIDS = ("list_transform(list_filter(string_split_regex({x}, '\\s+'), lambda w: w <> ''), "
          "lambda w: (('0x' || substr(md5(w), 1, 8))::bigint % 31997) + 3)")

ORACLE = {
    "id_range_slice": CS._with_more(ORD, "select id, pos from o where pos >= 5 and pos < 115"),
    "chunk_assign": CS._with_more(ORD + ",\n" + CH, "select id, pos, cast(chunk as bigint) chunk from c"),
    "resume_pending": CS._with_more(ORD + ",\n" + CH, "select id, cast(chunk as bigint) chunk from c where pos - chunk * sz >= 7"),
    "run_resumable": CS._wsql("""select id, length(gpt) n_chars,
  cast(len(list_filter(string_split_regex(gpt, '\\s+'), lambda w: w <> '')) as bigint) n_words from rendered""", flow=True),
    "assemble_results": CS._with_more("""agg as (select n, t, sum(sediment) filter (where k < 12) xs, sum(discharge) filter (where k < 12) xd,
  sum(sediment) filter (where k >= 12) ys, sum(discharge) filter (where k >= 12) yd,
  max(sediment) filter (where k = 11) ls, max(discharge) filter (where k = 11) ld from wcells group by n, t)""", """
select r.id, 'Based on the given information, the predicted tokens in this region are <ST_PRE>.' res,
  round(xs, 6) x_in, round(xd, 6) x_out, round(ys, 6) y_in, round(yd, 6) y_out, round(12 * ls, 6) st_pre_infolow,
  round(12 * ld, 6) st_pre_outfolow
from rendered r join agg a on a.n = r.n and a.t = r.t"""),
    "mae": with_recipes("predictions", f"with {PRED} select round(avg(abs(y_true - y_pred)), 6) mae from p"),
    "mae_masked": with_recipes("predictions", f"""with {PRED}
select round(avg(abs(y_true - y_pred)) filter (where y_true > 5.0), 6) mae_mask_value,
       round(avg(abs(y_true * (case when y_true > 10 then 1.0 else 0.0 end) - y_pred * (case when y_true > 10 then 1.0 else 0.0 end))), 6) mae_mask
from p"""),
    "binarize_labels": with_recipes("predictions", "select event_id, case when y_true / 10 >= 1 then 1.0::double else 0.0::double end label from predictions"),
    "bce_with_logits": with_recipes("predictions", f"""with {PRED}, x as (select (y_pred - 10) / 5 x, case when y_true / 10 >= 1 then 1.0 else 0.0 end y from p)
select round(avg(greatest(x, 0.0) - x * y + ln(1 + exp(-abs(x)))), 6) bce from x"""),
    "task_route": CS._with_more(CS.PARSED, """
select p.id, round(d.discharge, 6) task_type, case when d.discharge in (3, 4) then 'classification' else 'regression' end route
from parsed p join dense d on d.n = p.region_start and d.t = p.snapshot"""),
    "echo_mismatch": with_recipes("turns", f"""
with j as (select u.conv_id, u.i, {TOKIDS.format(x='u.text')} a, {TOKIDS.format(x='r.text')} b
           from turns u join turns r on r.conv_id = u.conv_id and r.i = u.i + 1 and r.role = 'assistant' where u.role = 'user')
select conv_id, i, cast(len(list_filter(range(1, len(a) + 1), lambda k: k > len(b) or a[k] <> b[k])) as bigint) n_diff from j"""),
}
