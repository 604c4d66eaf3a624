"""Registered queries of the scans/sinks group: each sink writes to a fresh
folder under the shared checkpoint location and the query re-reads it."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import functions as F
from pyspark.sql import types as T

from estuary.catalog import battles as CB
from estuary.catalog import evaluate as CE
from estuary.catalog import series as CS
from estuary.catalog.common import flat, scratch_path
from estuary.catalog.fixtures_sql import with_recipes
from estuary.functions.exprs import pacific_day, py_round
from estuary.operators import battles as B
from estuary.operators import series as S
from estuary.sources import files
from estuary.sources import tables as TB


def _log_rows(spark, d):
    """conv_log with some fields absent (written as missing JSON keys)."""
    c = TB.conv_log(spark, d)
    return c.select("tstamp", "type", F.when(F.col("event_id") % 4 != 0, F.col("model")).alias("model"),
                    F.when(F.col("event_id") % 5 != 0, F.col("models")).alias("models"))


def q_scan_conv_log(spark, d):
    path = scratch_path(spark, "conv_log")
    files.sink_json(_log_rows(spark, d), path)
    s = files.scan_conv_log(spark, path)
    return flat(s.select("type", "tstamp", "model", F.element_at("models", 1).alias("model_a"),
                         F.element_at("models", 2).alias("model_b"), "bad_row"))


def _server_logs(spark, d):
    """Daily logs laid out per server and date (partition folders)."""
    ev = TB.table(spark, d, "events").select("event_id", "ts", "user_id", "event_type")
    path = scratch_path(spark, "server_logs")
    out = ev.select((F.col("user_id") % 12).cast("int").alias("server"), F.date_format("ts", "yyyy-MM-dd").alias("date"),
                    "event_id", "event_type")
    out.write.mode("overwrite").partitionBy("server", "date").json(path)
    return files.log_files_index(spark, path, glob="*.json", server_re=r"server=(\d+)/", date_re=r"date=(\d{4}-\d{2}-\d{2})/")


JAN = [(date(2024, 1, 1) + timedelta(days=i)).isoformat() for i in range(31)]


def q_select_log_files(spark, d):
    idx = _server_logs(spark, d).select("server", "date").distinct()
    return flat(files.select_log_files(idx, JAN, max_num_files=50).select("server", "date", "rank_from_end"))


def q_select_log_files_cutoff(spark, d):
    dates = [x for x in JAN if "2024-01-10" <= x <= "2024-01-25"]
    cutoff = dates[-1].replace("-", "")
    idx = _server_logs(spark, d).select("server", "date").distinct()
    sel = files.select_log_files(idx, dates, None)
    return flat(sel.select("server", "date", F.lit(cutoff).alias("cutoff")))


def q_scan_battles_json(spark, d):
    b = TB.battles(spark, d).select("event_id", "model_a", "model_b", "win", "anony", "tstamp")
    path = scratch_path(spark, "battles_json")
    files.sink_json_arrays(b, path, ["tstamp", "event_id"], rows_per_file=2000)
    s = files.scan_json_arrays(spark, path, files.BATTLE)
    return flat(s.select("model_a", "model_b", "win", "anony", "tstamp"))


def q_scan_instructions(spark, d):
    nc = S.nest_conversation(CS._rendered(spark, d))
    path = scratch_path(spark, "instructions")
    files.sink_json_arrays(nc.join(CS._rendered(spark, d).select("id", "t", "n"), "id").select("id", "conversations", "t", "n")
                           .withColumn("k", F.col("t").cast("long") * 1_000_000_000 + F.col("n")).select("id", "conversations", "k"),
                           path, ["k"], rows_per_file=50)
    s = files.scan_json_arrays(spark, path, files.INSTRUCTION)
    e = s.select("id", F.posexplode("conversations").alias("pos", "c"))
    return flat(e.select("id", "pos", F.col("c.from").alias("from"), F.col("c.value").alias("value")))


def q_scan_snapshots(spark, d):
    path = scratch_path(spark, "snapshots")
    files.sink_parquet(CS._snapshots(spark, d), path)
    return flat(S.snapshot_cells(spark.read.parquet(path)))


def q_scan_reviews(spark, d):
    path = scratch_path(spark, "reviews_csv")
    r = TB.reviews(spark, d).withColumnRenamed("doc_id", "_c0")
    r.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    s = files.scan_reviews(spark, path, ["_c0", "Time", "ProductId", "Score", "Summary", "Text"])
    return flat(s.select(F.col("_c0").cast("long").alias("doc_id"), F.col("Time").cast("long").alias("Time"), "ProductId",
                         F.col("Score").cast("long").alias("Score"), F.length("Text").alias("text_len"), F.md5("Text").alias("text_md5")))


def q_preview_profile(spark, d):
    tabs = {name: TB.table(spark, d, name) for name in ("events", "documents", "embeddings", "conversations")}
    return flat(files.preview_profile(tabs, array_col=("embeddings", "embedding")))


def q_sink_cube(spark, d):
    path = scratch_path(spark, "cube")
    files.sink_parquet_by_key(S.stack_cube(CS._dense(spark, d), chunk=16), path, "site", ["chunk"])
    c = spark.read.parquet(path)
    e = c.select("n", "site", "chunk", F.posexplode("values").alias("i", "v"))
    return flat(e.select("n", "site", "chunk", "i", F.col("v")[0].alias("sediment"), F.col("v")[1].alias("discharge")))


def q_sink_instructions(spark, d):
    path = scratch_path(spark, "instructions_jsonl")
    files.sink_json(S.nest_conversation(CS._rendered(spark, d)), path)
    s = spark.read.schema(files.INSTRUCTION).json(path)
    e = s.select("id", F.posexplode("conversations").alias("pos", "c"))
    return flat(e.select("id", "pos", F.col("c.from").alias("from"), F.col("c.value").alias("value")))


def q_sink_clean_battles(spark, d):
    path = scratch_path(spark, "clean_battle_20240125")
    files.sink_json(B.clean_battles(CB._votes(spark, d, detect=True)), path)
    schema = T.StructType([T.StructField("event_id", T.LongType())] + list(files.BATTLE.fields))
    return flat(spark.read.schema(schema).json(path))


def q_sink_daily_log(spark, d):
    path = scratch_path(spark, "daily_logs")
    c = TB.conv_log(spark, d).select("event_id", "type", py_round("tstamp", 4).alias("tstamp"),
                                     pacific_day("tstamp").alias("date"))
    files.sink_json(c, path, partition_by=["date"], mode="append")
    s = spark.read.schema("event_id long, type string, tstamp double, date string").json(path)
    return flat(s)


def q_sink_eval_results(spark, d):
    path = scratch_path(spark, "eval_results")
    res = CE.q_assemble_results(spark, d).join(CE._chunks(spark, d).select("id", "chunk"), "id")
    files.sink_json(res, path, partition_by=["chunk"])
    s = spark.read.schema("id string, res string, x_in double, x_out double, y_in double, y_out double, "
                          "st_pre_infolow double, st_pre_outfolow double, chunk int").json(path)
    return flat(s)


def q_content_hash_dedup(spark, d):
    return flat(files.content_hash_dedup(TB.content(spark, d)))


QUERIES = {k[2:]: v for k, v in globals().items() if k.startswith("q_")}

SERVER = "s as (select distinct cast(user_id % 12 as bigint) server, strftime(ts, '%Y-%m-%d') \"date\" from events)"

ORACLE = {
    "scan_conv_log": with_recipes("conv_log", """
select "type", tstamp, case when event_id % 4 <> 0 then model else '' end model,
       case when event_id % 5 <> 0 then models[1] else '' end model_a, case when event_id % 5 <> 0 then models[2] else '' end model_b,
       false bad_row from conv_log"""),
    "select_log_files": f"""with {SERVER}
select server, "date", rank_from_end from (select *, row_number() over (order by "date" desc, server desc) rank_from_end from s)
where rank_from_end <= 50""",
    "select_log_files_cutoff": f"""with {SERVER}
select server, "date", '20240125' cutoff from s where "date" between '2024-01-10' and '2024-01-25'""",
    "scan_battles_json": with_recipes("battles", "select model_a, model_b, win, anony, tstamp from battles"),
    "scan_instructions": CS.ORACLE["nest_conversation"],
    "scan_snapshots": CS.ORACLE["assemble_snapshots"],
    "scan_reviews": with_recipes("reviews", """
select doc_id, "Time", ProductId, cast(Score as bigint) Score, length(Text) text_len, md5(Text) text_md5 from reviews
where "Time" is not null and ProductId is not null and Score is not null and Summary is not null and Text is not null"""),
    "preview_profile": """
select 'events' name, count(*) n_rows, 6 n_cols from events union all select 'documents', count(*), 5 from documents
union all select 'embeddings', count(*), 3 from embeddings union all select 'conversations', count(*), 4 from conversations
union all select 'embedding_dims', max(len(embedding)), 1 from embeddings""".replace("6 n_cols", "cast(6 as bigint) n_cols"),
    "sink_cube": CS.ORACLE["stack_cube"],
    "sink_instructions": CS.ORACLE["nest_conversation"],
    "sink_clean_battles": CB.ORACLE["clean_battles"],
    "sink_daily_log": with_recipes("conv_log", """
select event_id, "type", cast(round_even(cast(printf('%.20f', tstamp) as decimal(38, 20)), 4) as double) tstamp, strftime(timezone('America/Los_Angeles', to_timestamp(tstamp)), '%Y-%m-%d') "date"
from conv_log"""),
    "sink_eval_results": CS._with_more(CE.ORD + ",\n" + CE.CH + """,
agg as (select n, t, sum(sediment) filter (where k < 12) xs, sum(discharge) filter (where k < 12) xd,
  sum(sediment) filter (where k >= 12) ys, sum(discharge) filter (where k >= 12) yd,
  max(sediment) filter (where k = 11) ls, max(discharge) filter (where k = 11) ld from wcells group by n, t)""", """
select r.id, 'Based on the given information, the predicted tokens in this region are <ST_PRE>.' res,
  round(xs, 6) x_in, round(xd, 6) x_out, round(ys, 6) y_in, round(yd, 6) y_out, round(12 * ls, 6) st_pre_infolow,
  round(12 * ld, 6) st_pre_outfolow, cast(c.chunk as bigint) chunk
from rendered r join agg a on a.n = r.n and a.t = r.t join c on c.id = r.id"""),
    "content_hash_dedup": with_recipes("content", """
select strftime("date", '%Y-%m-%d') "date", h, min(doc_id) doc_id from content group by 1, 2"""),
}
