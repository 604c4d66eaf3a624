"""Registered streaming queries: each drains the driver table as a file stream
(``availableNow``) into Parquet files on the shared checkpoint location, with a
checkpoint folder of its own, and reads them back. Aggregates run in update mode;
of each key the last update counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from estuary.catalog import activity as CA
from estuary.catalog import ratings as CR
from estuary.catalog.common import flat, scratch_path
from estuary.catalog.fixtures_sql import with_recipes
from estuary.functions.exprs import from_epoch
from estuary.sources import tables as TB
from estuary.streaming import ops as ST


def _log_stream(spark, d, max_files=None):
    ev = ST.stream_table(spark, d, "events", max_files)
    return TB.conv_log(spark, d, source=ev).withColumn("ts", from_epoch("tstamp"))


def _drain(spark, df, mode="append"):
    return ST.drain(df, scratch_path(spark, "stream"), scratch_path(spark, "ck"), mode)


def q_stream_log_source(spark, d, max_files=None):
    return flat(_drain(spark, _log_stream(spark, d, max_files).select("event_id", "tstamp", "model", "type")).drop("_batch"))


def q_stream_refresh(spark, d, max_files=None):
    counts = scratch_path(spark, "refresh_counts")
    ST.refresh_until_drained(_log_stream(spark, d, max_files), counts, scratch_path(spark, "ck"))
    return flat(ST.refresh_counts(spark, counts))


def q_stream_daily_activity(spark, d, max_files=None):
    out = _drain(spark, ST.stream_daily_activity(_log_stream(spark, d, max_files), watermark=ST.BACKLOG), "update")
    return flat(ST.latest(out, ["series", "day"]))


def q_stream_hourly_calls(spark, d, max_files=None):
    out = _drain(spark, ST.stream_hourly_calls(_log_stream(spark, d, max_files), watermark=ST.BACKLOG), "update")
    return flat(ST.latest(out, ["window_start"]))


def q_stream_trailing_activity(spark, d, max_files=None):
    out = _drain(spark, ST.stream_trailing_activity(_log_stream(spark, d, max_files), watermark=ST.BACKLOG), "update")
    return flat(ST.latest(out, ["window_start", "window_end", "type"]))


def q_stream_worker_liveness(spark, d, max_files=None):
    """Last beat and beats of each worker, and whether it has expired by the last beat of all."""
    hb = TB.heartbeats(spark, d, source=ST.stream_table(spark, d, "events", max_files)).withColumn("ts", from_epoch("beat"))
    last = ST.latest(_drain(spark, ST.stream_worker_liveness(hb, watermark=ST.BACKLOG), "update"), ["worker"])
    return flat(ST.expired_at(last, last.agg(F.max("last_beat").alias("_now"))).select(
        "worker", "last_beat", "beats", "check_heart_beat", "expired"))


def q_stream_elo(spark, d, max_files=None):
    b = TB.battles(spark, d, source=ST.stream_table(spark, d, "events", max_files)).where(F.col("anony")).withColumn(
        "ts", from_epoch("tstamp"))
    last = ST.latest(_drain(spark, ST.stream_elo(b, delay=ST.BACKLOG), "update"), ["board", "model"])
    return flat(last.select("board", "model", F.round("rating", 6).alias("rating")))


def q_stream_delta(spark, d, max_files=None):
    c = TB.chunks(spark, d, source=ST.stream_table(spark, d, "documents", max_files))
    return flat(_drain(spark, ST.stream_delta(c)).drop("_batch"))


def q_stream_content_dedup(spark, d, max_files=None):
    c = TB.content(spark, d, source=ST.stream_table(spark, d, "documents", max_files)).withColumn(
        "ts", F.col("date").cast("timestamp"))
    return flat(_drain(spark, ST.stream_content_dedup(c, watermark=ST.BACKLOG).select("date", "h")).drop("_batch"))


QUERIES = {k[2:]: v for k, v in globals().items() if k.startswith("q_")}

ORACLE = {
    "stream_log_source": with_recipes("conv_log", "select event_id, tstamp, model, \"type\" from conv_log"),
    "stream_refresh": with_recipes("conv_log", "select \"type\", count(*) \"count\" from conv_log group by 1"),
    "stream_daily_activity": CA.ORACLE["daily_activity"],
    "stream_hourly_calls": with_recipes("conv_log", """
select strftime(date_trunc('hour', to_timestamp(tstamp)::timestamp), '%Y-%m-%d %H:%M:%S') window_start, count(*) "count"
from conv_log where "type" = 'chat' group by 1"""),
    "stream_trailing_activity": with_recipes("conv_log", """
with w as (select "type", date_trunc('hour', to_timestamp(tstamp)::timestamp) - to_hours(cast(k as bigint)) s
           from conv_log, range(0, 24) r(k))
select strftime(s, '%Y-%m-%d %H:%M:%S') window_start, strftime(s + interval 1 day, '%Y-%m-%d %H:%M:%S') window_end, "type",
       count(*) "count" from w group by all"""),
    "stream_worker_liveness": with_recipes("heartbeats", """
with w as (select worker, max(beat) last_beat, count(*) beats, arg_max(check_heart_beat, {'b': beat, 'c': check_heart_beat}) check_heart_beat
           from heartbeats group by 1)
select *, check_heart_beat and last_beat < (select max(beat) from heartbeats) - 90 expired from w"""),
    "stream_elo": CR.ORACLE["elo_online"],
    "stream_delta": with_recipes("chunks", """
with c as (select stream_id, seq, replace(text, '�', '') t, finish_reason from chunks),
d as (select *, coalesce(lag(t) over (partition by stream_id order by seq), '') prev from c),
e as (select stream_id, seq, nullif(substr(t, length(prev) + 1), '') delta, finish_reason from d)
select stream_id, cast(seq as bigint) seq, delta, finish_reason from e where delta is not null or finish_reason is not null"""),
    "stream_content_dedup": with_recipes("content", "select distinct strftime(\"date\", '%Y-%m-%d') \"date\", h from content"),
}
