"""Activity statistics over chat/vote logs: histograms over trailing horizons,
daily counts in US/Pacific, the last-day hourly profile, training-loss logs.

Every multi-horizon count is one grouped scan with conditional counts; the
horizon anchor (data max) is a one-row aggregate attached to each row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estuary.functions.exprs import pacific_day, pacific_stamp

# The four vote actions of the arena logs.
VOTES = ["tievote", "leftvote", "rightvote", "bothbad_vote"]
HOUR = 3600
DAY = 86400


def is_anony_vote(type_col: str = "type", models_col: str = "models") -> Column:
    """Vote action whose first public model name is empty (only element 0 is tested)."""
    return F.col(type_col).isin(VOTES) & (F.element_at(models_col, 1) == F.lit(""))


def anony_votes(log: DataFrame) -> DataFrame:
    return log.where(is_anony_vote())


def with_horizons(log: DataFrame, ts: str = "tstamp") -> DataFrame:
    """Attach the data max and the two trailing-horizon flags (strict ``>``)."""
    now = log.agg(F.max(ts).alias("_now"))
    return (log.crossJoin(F.broadcast(now))
            .withColumn("in_hour", F.col(ts) > F.col("_now") - HOUR)
            .withColumn("in_day", F.col(ts) > F.col("_now") - DAY))


def trailing_window(log: DataFrame, seconds: int, ts: str = "tstamp") -> DataFrame:
    now = log.agg(F.max(ts).alias("_now"))
    return log.crossJoin(F.broadcast(now)).where(F.col(ts) > F.col("_now") - seconds).drop("_now")


def daily_activity(log: DataFrame) -> DataFrame:
    """Chats and anonymous votes per Pacific day, stacked as (series, day, count);
    a day missing from one series has no row there."""
    series = F.when(F.col("type") == "chat", F.lit("Chat")).when(is_anony_vote(), F.lit("Anony. Vote"))
    return (log.select(series.alias("series"), pacific_day("tstamp").alias("day"))
            .where(F.col("series").isNotNull())
            .groupBy("series", "day").agg(F.count(F.lit(1)).alias("count")))


def three_horizon_counts(log: DataFrame, key: str, where: Column | None = None,
                         names=("All", "Last Day", "Last Hour")) -> DataFrame:
    """``value_counts`` over all rows, the last day and the last hour, merged by an
    inner join (keys idle in a horizon vanish) – fused into one aggregation."""
    h = with_horizons(log)
    if where is not None:
        h = h.where(where)
    agg = h.groupBy(key).agg(F.count(F.lit(1)).alias(names[0]), F.count_if("in_day").alias(names[1]),
                             F.count_if("in_hour").alias(names[2]))
    return agg.where((F.col(f"`{names[1]}`") > 0) & (F.col(f"`{names[2]}`") > 0))


def model_call_histogram(log: DataFrame) -> DataFrame:
    return three_horizon_counts(log, "model", F.col("type") == "chat")


def action_histogram(log: DataFrame) -> DataFrame:
    return three_horizon_counts(log, "type")


def anony_vote_histogram(log: DataFrame) -> DataFrame:
    """Horizons are anchored on the max over **all** rows, then restricted."""
    return three_horizon_counts(log, "type", is_anony_vote())


def merge_counts(series: list[DataFrame], on: str, names: list[str]) -> DataFrame:
    """Inner join of k (key, count) series; the count columns get ``names``."""
    renamed = [s.select(on, F.col(s.columns[-1]).alias(n)) for s, n in zip(series, names)]
    return reduce(lambda a, b: a.join(b, on, "inner"), renamed)


def hourly_last_day(log: DataFrame) -> DataFrame:
    """24 hourly chat counts over the last day. The base is the **min** tstamp of
    the last-day rows (all types); bucket i covers [base+(i-1)h, base+ih), is
    labelled by its right edge in Pacific time, zeros kept."""
    h = with_horizons(log).where("in_day")
    base = h.agg(F.min("tstamp").alias("_base"))
    counts = (h.where(F.col("type") == "chat").crossJoin(F.broadcast(base))
              .select(F.floor((F.col("tstamp") - F.col("_base")) / HOUR).cast("int") + 1)
              .toDF("i").groupBy("i").agg(F.count(F.lit(1)).alias("value")))
    spine = base.select("_base", F.explode(F.sequence(F.lit(24), F.lit(1), F.lit(-1))).alias("i"))
    return (spine.join(counts, "i", "left")
            .select("i", pacific_stamp(F.col("_base") + F.col("i") * HOUR).alias("time"),
                    F.coalesce("value", F.lit(0)).alias("value")))


def last_updated(log: DataFrame, ts: str = "tstamp") -> DataFrame:
    return log.agg(F.max(ts).alias("_m")).select(pacific_stamp("_m").alias("last_updated"))


def markdown_table(df: DataFrame, columns: list[str], order: list[Column]) -> DataFrame:
    """GitHub-style table text (tabulate ``github``): numbers right-aligned,
    text left-aligned, one space of padding. For report-sized inputs only
    (aggregated rows), so the global width/ordering steps stay tiny."""
    from pyspark.sql import types as T

    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    ranked = df.withColumn("_ln", F.row_number().over(Window.orderBy(*order)))
    txt = ranked.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in columns], "_ln")
    widths = txt.agg(*[F.greatest(F.max(F.length(F.col(f"`{c}`"))), F.lit(len(c))).alias(c) for c in columns])
    w = txt.crossJoin(F.broadcast(widths.select(*[F.col(f"`{c}`").alias(f"_w{i}") for i, c in enumerate(columns)])))

    def cell(value: Column, i: int, c: str) -> Column:
        width = F.col(f"_w{i}")
        return F.lpad(value, width, " ") if c in numeric else F.rpad(value, width, " ")

    def line(cells: list[Column]) -> Column:
        return F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))

    body = w.select((F.col("_ln") + 2).alias("line_no"),
                    line([cell(F.col(f"`{c}`"), i, c) for i, c in enumerate(columns)]).alias("line"))
    head_src = w.limit(1)
    header = head_src.select(F.lit(1).alias("line_no"),
                             line([cell(F.lit(c), i, c) for i, c in enumerate(columns)]).alias("line"))
    rule = head_src.select(F.lit(2).alias("line_no"), F.concat(F.lit("|"), F.concat_ws(
        "|", *[F.repeat(F.lit("-"), F.col(f"_w{i}") + 2) for i in range(len(columns))]), F.lit("|")).alias("line"))
    return header.unionByName(rule).unionByName(body.toDF("line_no", "line"))


def throughput(pairs: DataFrame, prompt: str = "prompt", output: str = "output", start: str = "start",
               finish: str = "finish") -> DataFrame:
    """``Σ(len(out.split(" ")) − len(prompt.split(" "))) / elapsed`` with elapsed
    = last finish − first start over the requests."""
    words = F.size(F.split(F.col(output), " ")) - F.size(F.split(F.col(prompt), " "))
    agg = pairs.agg(F.count(F.lit(1)).alias("requests"), F.sum(words).alias("new_words"),
                    (F.max(finish) - F.min(start)).alias("elapsed"))
    return agg.withColumn("words_per_sec", F.try_divide(F.col("new_words").cast("double"), F.col("elapsed")))


def epoch_loss(batches: DataFrame, run: str = "run_id", epoch: str = "epoch", loss: str = "loss") -> DataFrame:
    return batches.groupBy(run, epoch).agg(F.avg(loss).alias("epoch_loss"), F.count(F.lit(1)).alias("batches"))


def plateau_detect(curve: DataFrame, patience: int = 30, delta: float = 0.0, run: str = "run_id",
                   epoch: str = "epoch", loss: str = "loss", block: int = 1024) -> DataFrame:
    """Early stopping: the first loss sets the best; a later loss counts as no
    improvement when ``loss > best - delta``; stop once the counter reaches
    ``patience``. For ``delta = 0`` best is the running min and the counter is
    the distance to the last improvement: two prefix scans over blocks of a run
    (no single task holds a whole run), then one aggregate per run. Epochs of a
    run are consecutive.

    Returns per run: stop_epoch (NULL if never), best_loss and best_epoch at
    the stop (or at the end), epochs seen.
    """
    if delta != 0.0:
        return plateau_detect_fold(curve, patience, delta, run, epoch, loss)
    d = curve.select(F.col(run).alias("run"), F.col(epoch).alias("e"), F.col(loss).alias("l"))
    # rows are dealt by (run, block) once; everything row-sized stays dealt that way
    d = d.withColumn("b", F.floor(F.col("e") / block).cast("long")).repartition("run", "b")
    earlier = Window.partitionBy("run").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("run", "b").orderBy("e")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)

    def carried(rows, value, agg, name):
        """``agg`` of ``value`` over the blocks before each block (one row a block)."""
        per = rows.groupBy("run", "b").agg(agg(value).alias("_v"))
        return per.select("run", "b", agg("_v").over(earlier).alias(name))

    d = d.join(carried(d, F.col("l"), F.min, "low"), ["run", "b"])
    prev = F.least(F.col("low"), F.min("l").over(before))  # least skips NULLs
    d = d.withColumn("prev", prev).withColumn("hit", F.when(F.col("prev").isNull() | (F.col("l") <= F.col("prev")), F.col("e")))
    d = d.join(carried(d, F.col("hit"), F.max, "last"), ["run", "b"])
    d = d.withColumn("at", F.greatest(F.col("last"), F.max("hit").over(upto)))
    # epochs are consecutive: the counter is the distance to the last improvement
    stop = F.when(F.col("e") - F.col("at") >= patience, F.struct("e", F.least("prev", "l").alias("l"), "at"))
    r = d.groupBy("run").agg(F.min(stop).alias("s"), F.min("l").alias("l"), F.max("at").alias("at"), F.min("e").alias("first"),
                             F.count(F.lit(1)).alias("n"))
    return r.select(F.col("run").alias(run), F.col("s.e").alias("stop_epoch"), F.coalesce("s.l", "l").alias("best_loss"),
                    F.coalesce("s.at", "at").alias("best_epoch"),
                    F.coalesce(F.col("s.e") - F.col("first") + 1, F.col("n")).alias("epochs_seen"))


PLATEAU_SCHEMA = "run_id long, stop_epoch long, best_loss double, best_epoch long, epochs_seen long"


def plateau_detect_fold(curve: DataFrame, patience: int = 30, delta: float = 0.0, run: str = "run_id",
                        epoch: str = "epoch", loss: str = "loss") -> DataFrame:
    """Early stopping for any ``delta``: with delta != 0 the best value is not a
    running minimum, so the rule is folded in epoch order per run. Runs are
    hash-partitioned and sorted inside their partition (no global sort);
    state per run is three numbers, carried across Arrow batches."""
    import pandas as pd

    def fold(batches):
        out, cur = [], None
        for pdf in batches:
            for r, e, l in zip(pdf["run"].to_numpy(), pdf["e"].to_numpy(), pdf["l"].to_numpy()):
                if cur is None or cur[0] != r:
                    if cur is not None:
                        out.append(cur[:5])
                    cur = [int(r), None, None, None, 0, 0]  # run, stop, best, best_epoch, seen, counter
                if cur[1] is not None:
                    continue  # stopped: later epochs are never run
                cur[4] += 1
                if cur[2] is None:
                    cur[2], cur[3] = float(l), int(e)
                elif l > cur[2] - delta:
                    cur[5] += 1
                    if cur[5] >= patience:
                        cur[1] = int(e)
                else:
                    cur[2], cur[3], cur[5] = float(l), int(e), 0
        if cur is not None:
            out.append(cur[:5])
        yield pd.DataFrame(out, columns=["run_id", "stop_epoch", "best_loss", "best_epoch", "epochs_seen"]).astype(
            {"stop_epoch": "Int64"})

    c = curve.select(F.col(run).cast("long").alias("run"), F.col(epoch).cast("long").alias("e"), F.col(loss).cast("double").alias("l"))
    out = c.repartition("run").sortWithinPartitions("run", "e").mapInPandas(fold, PLATEAU_SCHEMA)
    return out.withColumnRenamed("run_id", run) if run != "run_id" else out
