"""Registered queries of the log-analytics group and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from estuary.catalog.common import flat
from estuary.catalog.fixtures_sql import with_recipes
from estuary.functions.exprs import epoch_seconds
from estuary.operators import activity as A
from estuary.sources import tables as TB


def _log(spark, d):
    return TB.conv_log(spark, d)


def q_anony_votes(spark, d):
    return flat(A.anony_votes(_log(spark, d)).select("event_id", "tstamp", "type"))


def q_trailing_window(spark, d):
    h = A.with_horizons(_log(spark, d)).where("in_day")
    return flat(h.select("event_id", "type", "in_hour"))


def q_daily_activity(spark, d):
    return flat(A.daily_activity(_log(spark, d)))


def q_model_call_histogram(spark, d):
    return flat(A.model_call_histogram(_log(spark, d)))


def q_merge_counts(spark, d):
    log = _log(spark, d)
    series = [A.trailing_window(log, s).groupBy("model").agg(F.count(F.lit(1)).alias("c"))
              for s in (10**12, A.DAY, A.HOUR)]
    return flat(A.merge_counts(series, "model", ["All", "Last Day", "Last Hour"]))


def q_action_histogram(spark, d):
    return flat(A.action_histogram(_log(spark, d)))


def q_anony_vote_histogram(spark, d):
    return flat(A.anony_vote_histogram(_log(spark, d)))


def q_hourly_last_day(spark, d):
    return flat(A.hourly_last_day(_log(spark, d)))


def q_last_updated(spark, d):
    return flat(A.last_updated(_log(spark, d)))


def q_markdown_table(spark, d):
    h = A.model_call_histogram(_log(spark, d))
    return flat(A.markdown_table(h, ["model", "All", "Last Day", "Last Hour"],
                                 [F.col("All").desc(), F.col("model")]))


def _throughput_pairs(spark, d):
    t = TB.turns(spark, d)
    ev = TB.table(spark, d, "events").select("event_id", epoch_seconds("ts").alias("at"))
    u = t.where(F.col("role") == "user").select("conv_id", "i", F.col("text").alias("prompt"))
    a = t.where(F.col("role") == "assistant").select("conv_id", (F.col("i") - 1).alias("i"), F.col("text").alias("reply"))
    n = ev.agg(F.max("event_id").alias("_n"))  # one row: pairs are timed by events (e0, e0 + 1), all of them in turn
    p = u.join(a, ["conv_id", "i"]).crossJoin(F.broadcast(n)).select(
        "conv_id", "i", "prompt", F.concat_ws(" ", "prompt", "reply").alias("output"),
        ((F.col("conv_id") * 10 + F.col("i")) % F.col("_n")).alias("e0"))
    return (p.join(ev.withColumnRenamed("event_id", "e0").withColumnRenamed("at", "start"), "e0")
            .join(ev.select((F.col("event_id") - 1).alias("e0"), F.col("at").alias("finish")), "e0"))


def q_throughput(spark, d):
    r = A.throughput(_throughput_pairs(spark, d))
    return flat(r.select("requests", "new_words", F.round("elapsed", 6).alias("elapsed"),
                         F.round("words_per_sec", 6).alias("words_per_sec")))


def _batches(spark, d):
    li = TB.table(spark, d, "lineitem").select("l_suppkey", "l_linenumber", "l_discount", "l_tax")
    return li.select(F.col("l_suppkey").alias("run_id"), F.col("l_linenumber").alias("epoch"),
                     (F.col("l_discount") + F.col("l_tax")).alias("loss"))


def q_epoch_loss(spark, d):
    e = A.epoch_loss(_batches(spark, d))
    return flat(e.select("run_id", "epoch", F.round("epoch_loss", 6).alias("epoch_loss"), "batches"))


def q_plateau_detect(spark, d):
    p = A.plateau_detect(TB.metric_log(spark, d), patience=30)
    return flat(p.select("run_id", "stop_epoch", F.round("best_loss", 6).alias("best_loss"), "best_epoch", "epochs_seen"))


def q_plateau_detect_delta(spark, d):
    p = A.plateau_detect(TB.metric_log(spark, d), patience=10, delta=0.005)
    return flat(p.select("run_id", "stop_epoch", F.round("best_loss", 6).alias("best_loss"), "best_epoch", "epochs_seen"))


QUERIES = {k[2:]: v for k, v in globals().items() if k.startswith("q_")}

VOTES_SQL = "('tievote', 'leftvote', 'rightvote', 'bothbad_vote')"
PAC = "timezone('America/Los_Angeles', to_timestamp({x}))"
STAMP = ("strftime(" + PAC + ", '%Y-%m-%d %H:%M:%S') || case when date_diff('hour', to_timestamp({x})::timestamp, "
         + PAC + ") = -7 then ' PDT' else ' PST' end")

HORIZON = """h as (select c.*, c.tstamp > m.mx - 3600 in_hour, c.tstamp > m.mx - 86400 in_day
                   from conv_log c, (select max(tstamp) mx from conv_log) m)"""


def _three(key: str, where: str = "true") -> str:
    return with_recipes("conv_log", "with " + HORIZON + f"""
select {key}, count(*) "All", count(*) filter (where in_day) "Last Day", count(*) filter (where in_hour) "Last Hour"
from h where {where} group by {key}
having count(*) filter (where in_day) > 0 and count(*) filter (where in_hour) > 0""")


ORACLE = {
    "anony_votes": with_recipes("conv_log", f"""
select event_id, tstamp, "type" from conv_log where "type" in {VOTES_SQL} and models[1] = ''"""),
    "trailing_window": with_recipes("conv_log", "with " + HORIZON + """
select event_id, "type", in_hour from h where in_day"""),
    "daily_activity": with_recipes("conv_log", f"""
select series, "day", count(*) "count" from (
  select case when "type" = 'chat' then 'Chat' when "type" in {VOTES_SQL} and models[1] = '' then 'Anony. Vote' end series,
         strftime({PAC.format(x='tstamp')}, '%Y-%m-%d') "day" from conv_log) where series is not null group by 1, 2"""),
    "model_call_histogram": _three("model", "\"type\" = 'chat'"),
    "merge_counts": with_recipes("conv_log", "with " + HORIZON + """
select model, count(*) "All", count(*) filter (where in_day) "Last Day", count(*) filter (where in_hour) "Last Hour"
from h group by model having count(*) filter (where in_day) > 0 and count(*) filter (where in_hour) > 0"""),
    "action_histogram": _three("\"type\""),
    "anony_vote_histogram": _three("\"type\"", f"\"type\" in {VOTES_SQL} and models[1] = ''"),
    "hourly_last_day": with_recipes("conv_log", "with " + HORIZON + f""",
b as (select min(tstamp) base from h where in_day),
c as (select cast(floor((tstamp - base) / 3600) as bigint) + 1 i, count(*) v from h, b where in_day and "type" = 'chat' group by 1)
select g.i, {STAMP.format(x='b.base + g.i * 3600')} "time", coalesce(c.v, 0) "value"
from b, range(1, 25) g(i) left join c on c.i = g.i"""),
    "last_updated": with_recipes("conv_log", f"""
select {STAMP.format(x='m')} last_updated from (select max(tstamp) m from conv_log)"""),
    "throughput": """
with t as (select conv_id, turn, role, text, row_number() over (partition by conv_id order by turn) - 1 i from conversations),
ev as (select event_id, epoch(ts) ev_at from events),
n as (select max(event_id) n from events),
p as (select u.conv_id, u.i, u.text prompt, u.text || ' ' || a.text output, e0.ev_at start, e1.ev_at finish
      from t u join t a on a.conv_id = u.conv_id and a.i = u.i + 1 and a.role = 'assistant'
      cross join n
      join ev e0 on e0.event_id = (u.conv_id * 10 + u.i) % n.n join ev e1 on e1.event_id = (u.conv_id * 10 + u.i) % n.n + 1
      where u.role = 'user')
select count(*) requests, cast(sum(len(string_split(output, ' ')) - len(string_split(prompt, ' '))) as bigint) new_words,
       round(max(finish) - min(start), 6) elapsed,
       round(sum(len(string_split(output, ' ')) - len(string_split(prompt, ' '))) / (max(finish) - min(start)), 6) words_per_sec
from p""",
    "epoch_loss": """
select l_suppkey run_id, cast(l_linenumber as bigint) epoch, round(avg(l_discount + l_tax), 6) epoch_loss, count(*) batches
from lineitem group by 1, 2""",
    "plateau_detect": with_recipes("metric_log", """
with a as (select run_id, epoch, loss,
              min(loss) over (partition by run_id order by epoch rows between unbounded preceding and 1 preceding) prev_min
           from metric_log),
b as (select *, prev_min is null or loss <= prev_min imp from a),
c as (select *, epoch - max(case when imp then epoch end) over (partition by run_id order by epoch rows between unbounded preceding and current row) counter from b),
s as (select run_id, min(epoch) stop_epoch from c where counter >= 30 group by run_id),
j as (select c.*, s.stop_epoch from c left join s using (run_id) where s.stop_epoch is null or c.epoch <= s.stop_epoch)
select run_id, any_value(stop_epoch) stop_epoch, round(arg_max(loss, epoch) filter (where imp), 6) best_loss,
       max(epoch) filter (where imp) best_epoch, count(*) epochs_seen
from j group by run_id"""),
    # one step an epoch, all runs together: (best, its epoch, losses without improvement, stop)
    "plateau_detect_delta": with_recipes("metric_log", """
with recursive m as (select run_id, epoch, cast(loss as double) loss from metric_log),
r(run_id, epoch, best, best_epoch, bad, stop) as (
  select run_id, epoch, loss, epoch, 0::bigint, null::bigint from m where epoch = 1
  union all
  select r.run_id, m.epoch, case when m.loss > r.best - 0.005 then r.best else m.loss end,
         case when m.loss > r.best - 0.005 then r.best_epoch else m.epoch end,
         case when m.loss > r.best - 0.005 then r.bad + 1 else 0 end,
         case when m.loss > r.best - 0.005 and r.bad + 1 >= 10 then m.epoch end
  from r join m on m.run_id = r.run_id and m.epoch = r.epoch + 1 where r.stop is null)
select run_id, max(stop) stop_epoch, round(arg_max(best, epoch), 6) best_loss, arg_max(best_epoch, epoch) best_epoch,
       max(epoch) epochs_seen from r group by run_id"""),
}
