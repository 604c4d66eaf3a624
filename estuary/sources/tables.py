"""Driver tables and the input recipes built on them (see FIXTURES.md part B).

Each recipe is a lazy DataFrame over the parquet tables; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from estuary.functions.exprs import epoch_seconds

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

# Fixed values of the fixtures: site codes are 4178000 + 500 n, wide files have 20
# sites; the calendar of the driver's events table, for synthetic dates only.
N_SITES = 20
SITE_BASE = 4178000
SITE_STEP = 500
CAL_START = "2024-01-01"
CAL_END = "2024-01-30"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _k(props: str = "props"):
    return F.get_json_object(F.col(props), "$.k").cast("int")


def _site_facts(spark: SparkSession, sf_dir: str, n) -> DataFrame:
    """Sums of a day's events by site: clicks, views and errors are sediment,
    purchases and signups are discharge. A day without events of a kind leaves a
    NULL cell, a day without any leaves no row."""
    ev = table(spark, sf_dir, "events").select("user_id", "ts", "event_type", "value")
    dec = F.col("value").cast("decimal(18,2)")
    flow = F.col("event_type").isin("purchase", "signup")
    return (ev.groupBy(n.cast("int").alias("n"), (F.lit(SITE_BASE) + SITE_STEP * n).cast("string").alias("site"),
                       F.col("ts").cast("date").alias("date"))
            .agg(F.sum(F.when(~flow, dec)).cast("double").alias("sediment"),
                 F.sum(F.when(flow, dec)).cast("double").alias("discharge")))


def site_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long series (n, site, date, sediment, discharge): one site for each user."""
    return _site_facts(spark, sf_dir, F.col("user_id"))


def site_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, users folded to N_SITES sites: wide files name their sites as columns."""
    return _site_facts(spark, sf_dir, F.col("user_id") % N_SITES)


def site_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site dimension (n, site) from the data."""
    u = table(spark, sf_dir, "events").select(F.col("user_id").alias("u")).distinct()
    return u.select(F.col("u").cast("int").alias("n"), (F.lit(SITE_BASE) + SITE_STEP * F.col("u")).cast("string").alias("site"))


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row (start, steps): first day of the data and number of days to the last."""
    day = F.col("ts").cast("date")
    c = table(spark, sf_dir, "events").agg(F.min(day).alias("start"), F.max(day).alias("end"))
    return c.select("start", (F.datediff("end", "start") + 1).alias("steps"))


def _flow(spark: SparkSession, sf_dir: str, src, dst) -> DataFrame:
    """Directed pairs with their count less the mean count of a pair."""
    ev = table(spark, sf_dir, "events").select("user_id", "props")
    top = ev.agg((F.max("user_id") + 1).alias("_users"))  # one row
    pairs = ev.crossJoin(F.broadcast(top)).groupBy(src.cast("int").alias("src"), dst.cast("int").alias("dst")).agg(
        F.count(F.lit(1)).alias("_c"))
    mean = pairs.agg(F.avg("_c").alias("_mean"))  # one row
    return pairs.crossJoin(F.broadcast(mean)).select("src", "dst", (F.col("_c") - F.col("_mean")).alias("direction"))


def flow_edge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flow between the folded sites, for the wide matrix file."""
    return _flow(spark, sf_dir, F.col("user_id") % N_SITES, (F.col("user_id") + _k()) % N_SITES)


def flow_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flow between all sites."""
    return _flow(spark, sf_dir, F.col("user_id"), (F.col("user_id") + _k()) % F.col("_users"))


def conv_log(spark: SparkSession, sf_dir: str, source: DataFrame | None = None) -> DataFrame:
    ev = (source if source is not None else table(spark, sf_dir, "events")).select("event_id", "ts", "user_id", "event_type", "props")
    typ = (F.when(F.col("event_type") == "click", "chat").when(F.col("event_type") == "view", "leftvote")
           .when(F.col("event_type") == "purchase", "rightvote").when(F.col("event_type") == "signup", "tievote")
           .otherwise("bothbad_vote"))
    model = F.concat(F.lit("m"), (F.col("user_id") % 8).cast("string"))
    models = F.when(_k() % 2 == 0, F.array(F.lit(""), F.lit(""))).otherwise(
        F.array(model, F.concat(F.lit("m"), ((F.col("user_id") + 1) % 8).cast("string"))))
    return ev.select("event_id", epoch_seconds("ts").alias("tstamp"), model.alias("model"), typ.alias("type"),
                     models.alias("models"))


# Names of served models: registered ones and two that the registry does not know.
MODEL_NAMES = ("gpt-4", "gpt-3.5-turbo", "claude-v1", "vicuna-13b", "vicuna-7b", "koala-13b", "m6", "m7")


def model_name(n):
    """Name number ``n`` (taken modulo the list)."""
    return F.element_at(F.array(*[F.lit(m) for m in MODEL_NAMES]), (n % len(MODEL_NAMES) + 1).cast("int"))


def battles(spark: SparkSession, sf_dir: str, source: DataFrame | None = None) -> DataFrame:
    ev = (source if source is not None else table(spark, sf_dir, "events")).select("event_id", "ts", "user_id", "event_type", "props")
    win = (F.when(F.col("event_type") == "click", "model_a").when(F.col("event_type") == "view", "model_b")
           .when(F.col("event_type") == "purchase", "tie").otherwise("tie (bothbad)"))
    return ev.select(
        F.col("user_id").cast("long").alias("board"), "event_id", epoch_seconds("ts").alias("tstamp"),
        model_name(F.col("user_id")).alias("model_a"), model_name(F.col("user_id") + 1 + _k() % 7).alias("model_b"),
        win.alias("win"), (_k() % 3 != 0).alias("anony"))


def raw_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    convs = table(spark, sf_dir, "conversations").select("conv_id").distinct()
    n = convs.agg(F.count(F.lit(1)).alias("_n"))  # one row
    typ = (F.when(F.col("event_type") == "click", "leftvote").when(F.col("event_type") == "view", "rightvote")
           .when(F.col("event_type") == "purchase", "tievote").when(F.col("event_type") == "signup", "bothbad_vote")
           .otherwise("chat"))
    r = F.col("event_id") % 5
    models = (F.when(r == 0, F.array(F.lit(""), F.lit(""))).when(r == 1, F.array(F.lit(""), F.lit("bard")))
              .when(r == 2, F.array(F.lit("Model A"), F.lit("Model B")))
              .when(r == 3, F.array(F.lit("<h3>Model A: bard</h3>\n"), F.lit("<h3>Model B: m1</h3>\n")))
              .otherwise(F.array(F.lit("m0"), F.lit("m1"))))
    ev = ev.crossJoin(F.broadcast(n)).withColumn("_c", F.col("event_id") % F.col("_n"))
    return ev.join(convs, F.col("_c") == F.col("conv_id")).select(
        "event_id", epoch_seconds("ts").alias("tstamp"), typ.alias("type"), models.alias("models"),
        F.when(F.col("event_id") % 11 == 0, F.lit(None).cast("string")).otherwise(F.lit("bard")).alias("hidden_a"),
        F.lit("m1").alias("hidden_b"), (F.col("event_id") % 3).cast("int").alias("offset"), "conv_id",
        F.when(F.col("event_id") % 13 == 0, F.lit(" I am ChatGPT")).otherwise(F.lit("")).alias("leak"))


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", "role", "text",
                    (F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")) - 1).alias("i"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return o.select(
        F.col("o_orderkey").alias("request_id"), F.concat(F.lit("m"), (F.col("o_custkey") % 9).cast("string")).alias("model"),
        (F.col("o_orderkey") % 600 - 20).cast("int").alias("max_tokens"), (F.col("o_orderkey") % 5).cast("int").alias("n"),
        ((F.col("o_custkey") % 30) / F.lit(10.0) - 0.4).alias("temperature"),
        ((F.col("o_orderkey") % 14) / F.lit(10.0) - 0.1).alias("top_p"),
        (F.col("o_orderkey") % 2100).cast("int").alias("token_num"))


def chunks(spark: SparkSession, sf_dir: str, source: DataFrame | None = None) -> DataFrame:
    d = (source if source is not None else table(spark, sf_dir, "documents")).select("doc_id", "text")
    steps = F.explode(F.sequence(F.lit(1), F.lit(6)))
    return (d.select("doc_id", "text", steps.alias("s"))
            .select(F.col("doc_id").alias("stream_id"), F.col("s").cast("int").alias("seq"),
                    F.expr("substr(text, 1, int((length(text) * least(s, 5) + 4) div 5))").alias("text"),
                    F.when(F.col("s") == 6, F.lit("stop")).alias("finish_reason")))


def heartbeats(spark: SparkSession, sf_dir: str, source: DataFrame | None = None) -> DataFrame:
    ev = (source if source is not None else table(spark, sf_dir, "events")).select("event_id", "ts", "user_id", "props")
    w = F.col("user_id") % 50
    return ev.select(
        "event_id", F.concat(F.lit("w"), w.cast("string")).alias("worker"), epoch_seconds("ts").alias("beat"),
        (_k() % 8).alias("queue_length"), (1 + F.col("user_id") % 3).alias("speed"),
        (F.col("user_id") % 4 != 0).alias("check_heart_beat"),
        F.array(model_name(w), model_name(w % 5)).alias("model_names"))


def metric_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey",
                                                 "l_extendedprice", "l_discount", "l_tax")
    w = Window.partitionBy("l_suppkey").orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return li.select(F.col("l_suppkey").alias("run_id"), F.row_number().over(w).alias("epoch"),
                     (F.col("l_discount") + F.col("l_tax")).alias("loss"))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return ev.select("event_id", F.col("value").alias("y_true"), F.lag("value").over(w).alias("y_pred"))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label")
    return e.select("vec_id", "label",
                    ((F.col("label") + F.when(F.col("vec_id") % 7 == 0, 1).otherwise(0)) % 10).cast("int").alias("pred"))


def params(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.concat(F.lit("p"), F.col("vec_id").cast("string")).alias("name"),
                    F.col("embedding").alias("base_values"),
                    F.transform("embedding", lambda x: x + F.col("label") * F.lit(0.01)).alias("target_values"))


def graph_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").select("vec_id")
    n = F.col("_n")
    return e.crossJoin(F.broadcast(e.agg(F.count(F.lit(1)).alias("_n")))).select(
        F.concat(F.lit("g_"), F.col("vec_id").cast("string")).alias("id"), F.col("vec_id").alias("node_idx"),
        F.array(F.col("vec_id"), (F.col("vec_id") + 1) % n, (F.col("vec_id") + 7) % n).alias("node_list"),
        F.array(F.array(F.lit(0).cast("long"), F.lit(0).cast("long")),
                F.array(F.lit(1).cast("long"), F.lit(2).cast("long"))).alias("edge_index"))


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return d.join(lab, "doc_id", "left").select(
        "doc_id", (F.col("doc_id") * 7919 % 10007).cast("long").alias("Time"), F.col("source").alias("ProductId"),
        F.col("quality").alias("Score"), F.split_part("text", F.lit("\n"), F.lit(1)).alias("Summary"), F.col("text").alias("Text"))


def content(spark: SparkSession, sf_dir: str, source: DataFrame | None = None) -> DataFrame:
    d = (source if source is not None else table(spark, sf_dir, "documents")).select("doc_id", "text")
    return d.select("doc_id", F.date_add(F.lit(CAL_START).cast("date"), (F.col("doc_id") % 30).cast("int")).alias("date"),
                    F.md5("text").alias("h"))
