"""Structured Streaming versions of the periodic dashboards, heartbeat expiry,
running ratings, stream deltas and content dedup.

Every operator takes a streaming DataFrame and returns a streaming DataFrame
(or starts a query for sinks). Operators with state of their own are
``transformWithStateInPandas`` processors: named values, lists and maps per key in
the state store, and event-time timers. They need the RocksDB state store, which
``estuary.session.configure`` names.

Files of a backlog come in no time order. ``BACKLOG`` is a delay for draining such
a table: no row counts as late, and the results equal those of a batch over all rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from estuary.functions.exprs import PACIFIC, pacific_day
from estuary.operators.activity import is_anony_vote
from estuary.operators.ratings import BASE, INIT_RATING, K_FACTOR, SCALE, SCORES, elo_shift

BACKLOG = "36500 days"


def _hadoop(spark: SparkSession, path: str):
    """File system of a path and the path, for whatever store holds it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, at = _hadoop(spark, path)
    return bool(fs.exists(at))


def stream_files(spark: SparkSession, path: str, schema: T.StructType, format: str = "parquet", max_files: int | None = None,
                 nested: bool = False) -> DataFrame:
    """A growing folder (or one file) as a stream.

    The folder itself is the stream's path, so the manifest of a table that a streaming
    sink wrote is followed and ``key=value`` folders become columns. ``nested`` also takes
    files of plain subfolders (``server0/2023-04-01-conv.json``); folder names are no
    columns then. A batch takes at most ``max_files`` files. A folder without files is a
    stream without rows."""
    fs, at = _hadoop(spark, path)
    reader = spark.readStream.schema(schema).format(format)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if fs.exists(at) and fs.getFileStatus(at).isFile():
        return reader.option("pathGlobFilter", at.getName()).load(at.getParent().toString())
    if not fs.exists(at):
        fs.mkdirs(at)
    return reader.option("recursiveFileLookup", nested).load(path)


def stream_table(spark: SparkSession, sf_dir: str, name: str, max_files: int | None = None) -> DataFrame:
    """A driver table, one file or a folder of files, as a file stream."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    return stream_files(spark, path, spark.read.parquet(path).schema, max_files=max_files)


def drain(df: DataFrame, path: str, ckpt: str, mode: str = "append") -> DataFrame:
    """Run over all available input (``availableNow``), append every micro-batch's
    rows with its number (column ``_batch``) to Parquet files at ``path``, and read
    them back. Nothing is kept on the driver. A batch that is run again after a
    failure writes the same folder again, so its rows count once. A stream without rows
    gives an empty table."""
    spark = df.sparkSession
    schema = T.StructType([*df.schema.fields, T.StructField("_batch", T.LongType())])

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/_batch={number}")

    fs, at = _hadoop(spark, path)
    fs.mkdirs(at)
    q = (df.writeStream.outputMode(mode).foreachBatch(store).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return spark.read.schema(schema).parquet(path)


def latest(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The last update of each key from ``drain`` in update mode."""
    values = [c for c in rows.columns if c not in (*keys, "_batch")]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "_batch").alias("_v"))
    return newest.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in values])


# ---------------------------------------------------------------- stateless / aggregate


def stream_daily_activity(log: DataFrame, ts: str = "ts", watermark: str = "2 days") -> DataFrame:
    """Chats and anonymous votes per US/Pacific day.

    The event-time key is the instant at which the local day began (23 or 25 hours apart
    where clocks change), so the watermark closes days: a day is final, and leaves the state,
    once a day has begun that is ``watermark`` younger. In append mode each day comes once,
    when it closes; in update mode with every change."""
    series = F.when(F.col("type") == "chat", F.lit("Chat")).when(is_anony_vote(), F.lit("Anony. Vote"))
    local_start = F.date_trunc("day", F.from_utc_timestamp(F.col(ts).cast("timestamp"), PACIFIC))
    return (log.select(series.alias("series"), F.to_utc_timestamp(local_start, PACIFIC).alias("day_start"))
            .withWatermark("day_start", watermark).where(F.col("series").isNotNull())
            .groupBy("series", "day_start").agg(F.count(F.lit(1)).alias("count"))
            .select("series", F.date_format(F.from_utc_timestamp("day_start", PACIFIC), "yyyy-MM-dd").alias("day"), "count"))


def stream_hourly_calls(log: DataFrame, ts: str = "ts", watermark: str = "1 hour") -> DataFrame:
    """Chat counts per clock-aligned hour (tumbling window)."""
    return (log.withWatermark(ts, watermark).where(F.col("type") == "chat")
            .groupBy(F.window(ts, "1 hour")).agg(F.count(F.lit(1)).alias("count"))
            .select(F.col("window.start").alias("window_start"), "count"))


def stream_trailing_activity(log: DataFrame, ts: str = "ts", watermark: str = "1 hour") -> DataFrame:
    """Per type, counts over sliding one-day windows every hour (the trailing
    horizon at slide granularity)."""
    return (log.withWatermark(ts, watermark)
            .groupBy(F.window(ts, "1 day", "1 hour"), "type").agg(F.count(F.lit(1)).alias("count"))
            .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "type", "count"))


def stream_content_dedup(content: DataFrame, ts: str = "ts", watermark: str = "1 day") -> DataFrame:
    """Drop a (date, md5) seen before within the watermark."""
    return content.withWatermark(ts, watermark).dropDuplicatesWithinWatermark(["date", "h"])


# ---------------------------------------------------------------- refresh

REFRESH = "type string, count long, batch_id long, total boolean"


def refresh_counts(spark: SparkSession, counts_path: str, before: int | None = None) -> DataFrame:
    """Counts per type so far: the newest total and the batches after it (``before`` leaves
    out batches from that number on)."""
    rows = spark.read.schema(REFRESH).parquet(counts_path)
    if before is not None:
        rows = rows.where(F.col("batch_id") < before)
    base = F.broadcast(rows.where("total").agg(F.coalesce(F.max("batch_id"), F.lit(-1)).alias("_base")))
    rows = rows.crossJoin(base).where((F.col("batch_id") > F.col("_base")) | F.col("total") & (F.col("batch_id") == F.col("_base")))
    return rows.where(F.col("type").isNotNull()).groupBy("type").agg(F.sum("count").alias("count"))


def stream_refresh_batch(counts_path: str, compact_every: int = 50):
    """``foreachBatch`` body: each micro-batch's counts per type are a folder of their own
    (``batch_id=n``), written over when the batch is run again, so the last write wins and
    no batch counts twice. Every ``compact_every`` batches a batch writes the total of
    all before it and itself, and the folders that the total replaces are removed; those
    of the last batch stay until the next total, so a total can be computed again."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        own = batch.groupBy("type").agg(F.count(F.lit(1)).alias("count"))
        whole = batch_id > 0 and batch_id % compact_every == 0
        if whole:
            own = own.unionByName(refresh_counts(spark, counts_path, batch_id)).groupBy("type").agg(F.sum("count").alias("count"))
        # a row without a type stands for a batch without any
        mark = spark.range(1).select(F.lit(None).cast("string").alias("type"), F.lit(0).cast("long").alias("count"))
        own.unionByName(mark).withColumn("total", F.lit(whole)).coalesce(1).write.mode("overwrite").parquet(
            f"{counts_path}/batch_id={batch_id}")
        if batch_id > 0 and batch_id % compact_every == 1:  # the total before is committed: what it replaced can go
            fs, at = _hadoop(spark, counts_path)
            for status in fs.listStatus(at):
                name = status.getPath().getName()
                if name.startswith("batch_id=") and int(name[9:]) < batch_id - 1:
                    fs.delete(status.getPath(), True)

    return run


# ---------------------------------------------------------------- stateful


LIVENESS_OUT = "worker string, last_beat double, beats long, check_heart_beat boolean, expired boolean"


class _Liveness(StatefulProcessor):
    """Last beat of a worker; a timer where it is to be removed if it stays silent."""

    def __init__(self, ttl_seconds: float):
        self.ttl_ms = int(ttl_seconds * 1000)

    def init(self, handle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "beat double, beats long, check boolean")

    def _end(self, beat: float) -> int:
        return int(beat * 1000) + self.ttl_ms

    def _row(self, key, last, expired: bool) -> pd.DataFrame:
        return pd.DataFrame({"worker": [key[0]], "last_beat": [last[0]], "beats": [last[1]], "check_heart_beat": [last[2]],
                             "expired": [expired]})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        old = self.last.get()
        beat, beats, check = old if old else (float("-inf"), 0, False)
        for pdf in rows:  # a busy worker's beats come in bounded frames
            beats += len(pdf)
            newest = float(pdf["beat"].max())
            if newest >= beat:
                same = bool(pdf.loc[pdf["beat"] == newest, "check_heart_beat"].any())
                beat, check = newest, same or (newest == beat and check)
        if old and old[2] and (old[0], old[2]) != (beat, check):
            self.handle.deleteTimer(self._end(old[0]))
        self.last.update((beat, beats, check))
        if check:
            self.handle.registerTimer(self._end(beat))
        yield self._row(key, (beat, beats, check), False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last = self.last.get()
        if last and last[2] and self._end(last[0]) <= expiredTimerInfo.getExpiryTimeInMs():
            self.last.clear()
            yield self._row(key, last, True)

    def close(self) -> None:
        pass


def stream_worker_liveness(beats: DataFrame, ttl_seconds: int = 90, watermark: str = "90 seconds") -> DataFrame:
    """Latest beat per worker, with the number of beats. A worker whose last beat asks for it
    (``check_heart_beat``; of beats at one time any) expires and leaves the state when the event-time watermark
    passes its last beat + ttl; others never do."""
    rows = beats.select("worker", "beat", "check_heart_beat", "ts").withWatermark("ts", watermark)
    return rows.groupBy("worker").transformWithStateInPandas(_Liveness(ttl_seconds), LIVENESS_OUT, "update", "EventTime")


def expired_at(last: DataFrame, now: DataFrame, ttl_seconds: int = 90) -> DataFrame:
    """The last states of :func:`stream_worker_liveness` with ``expired`` as of ``_now`` (one row):
    workers that the stream has removed, and silent ones whose beats are checked."""
    silent = F.col("check_heart_beat") & (F.col("last_beat") < F.col("_now") - ttl_seconds)
    return last.crossJoin(F.broadcast(now)).withColumn("expired", F.col("expired") | silent).drop("_now")


ELO_OUT = "board long, model string, rating double, folded long, late long"
_BATTLE = "tstamp double, event_id long, model_a string, model_b string, win string"


class _Elo(StatefulProcessor):
    """Ratings of a board. ``ratings`` and ``head`` hold history that no row can precede any
    more; ``waiting`` the battles inside the delay, appended as they come."""

    def __init__(self, k=K_FACTOR, scale=SCALE, base=BASE, init=INIT_RATING):
        self.rule = (k, scale, base, init)

    def init(self, handle) -> None:
        self.handle = handle
        self.head = handle.getValueState("head", "last_ts double, last_id long, folded long, late long")
        self.ratings = handle.getMapState("ratings", "model string", "rating double")
        self.waiting = handle.getListState("waiting", _BATTLE)

    def _fold(self, ratings: dict[str, float], rows) -> None:
        k, scale, base, init = self.rule
        for _, _, left, right, win in rows:
            gap = ratings.setdefault(left, init) - ratings.setdefault(right, init)
            points = elo_shift(gap, SCORES[win], k, scale, base)
            ratings[left] += points
            ratings[right] -= points

    def _settle(self, ratings: dict[str, float], head, old: list, new: list, watermark: int):
        """Fold what the watermark has passed; returns the head and the battles that still wait, in order."""
        ms = lambda r: round(r[0] * 1_000_000) // 1000  # noqa: E731  exact microseconds, then floor to ms
        rows = sorted([*old, *new], key=lambda r: (r[0], r[1]))
        ready = [r for r in rows if ms(r) <= watermark]
        rest = rows[len(ready):]
        if ready:
            self._fold(ratings, ready)
            for model in {m for r in ready for m in r[2:4]}:
                self.ratings.updateValue((model,), (ratings[model],))
            head = (ready[-1][0], ready[-1][1], head[2] + len(ready), head[3])
            if rest:
                self.waiting.put(rest)
            else:
                self.waiting.clear()
        elif new:
            self.waiting.appendList(new)
        if rest and (ready or not old or min(new, default=rest[0])[:2] <= rest[0][:2]):
            self.handle.registerTimer(max(ms(rest[0]), watermark + 1))
        return head, rest

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        head = tuple(self.head.get() or (float("-inf"), -1, 0, 0))
        ratings = {k[0]: v[0] for k, v in self.ratings.iterator()} if head[2] else {}
        new, late = [], 0
        for pdf in rows:
            for r in zip(pdf["tstamp"].tolist(), pdf["event_id"].tolist(), pdf["model_a"], pdf["model_b"], pdf["win"]):
                if r[:2] <= head[:2]:
                    late += 1  # older than history already folded: dropped and counted
                else:
                    new.append(r)
        head = (*head[:3], head[3] + late)
        old = [tuple(r) for r in self.waiting.get()]
        head, rest = self._settle(ratings, head, old, new, timerValues.getCurrentWatermarkInMs())
        self.head.update(head)
        self._fold(ratings, rest)  # for the output only: battles that still wait, in order
        n = len(ratings)
        yield pd.DataFrame({"board": [key[0]] * n, "model": list(ratings), "rating": list(ratings.values()),
                            "folded": [head[2] + len(rest)] * n, "late": [head[3]] * n})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        head = tuple(self.head.get())
        ratings = {k[0]: v[0] for k, v in self.ratings.iterator()} if head[2] else {}
        old = [tuple(r) for r in self.waiting.get()]
        head, _ = self._settle(ratings, head, old, [], timerValues.getCurrentWatermarkInMs())
        self.head.update(head)
        return iter(())  # the ratings that were put out stay the same

    def close(self) -> None:
        pass


def stream_elo(battles: DataFrame, ts: str = "ts", delay: str = "1 hour") -> DataFrame:
    """Running Elo per board: after each batch the ratings over all its battles so far,
    folded in (tstamp, event_id) order, whatever order they came in.

    Battles within ``delay`` of the newest event wait in a state list, those that the
    watermark has passed are folded into the ratings for good. Rows behind the watermark
    are dropped by Spark before the processor (query progress reports them as
    ``numRowsDroppedByWatermark``); a row that still reaches it but is older than folded
    history is dropped and counted (``late``). State per board: its ratings and the battles
    inside the delay."""
    rows = battles.select(F.col("board").cast("long").alias("board"), "tstamp", "event_id", "model_a", "model_b", "win", ts)
    return (rows.withWatermark(ts, delay).groupBy("board")
            .transformWithStateInPandas(_Elo(), ELO_OUT, "update", "EventTime"))


DELTA_OUT = "stream_id long, seq int, delta string, finish_reason string"


class _Delta(StatefulProcessor):
    """Deltas of a stream's cumulative texts in ``seq`` order; chunks behind a gap wait in a map."""

    def __init__(self, first_seq: int):
        self.first = first_seq

    def init(self, handle) -> None:
        self.head = handle.getValueState("head", "next int, length int, waiting int")
        self.waiting = handle.getMapState("waiting", "seq int", "text string, finish_reason string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        at, length, n_waiting = self.head.get() or (self.first, 0, 0)
        stored = {k[0]: tuple(v) for k, v in self.waiting.iterator()} if n_waiting else {}
        held, was = dict(stored), set(stored)
        for _, seq, text, finish in rows:
            if seq is not None and seq >= at:  # an earlier one was sent again
                held.setdefault(seq, ((text or "").replace("\ufffd", ""), finish))
            while at in held:
                text, finish = held.pop(at)
                delta = text[length:]
                if delta or finish is not None:
                    yield Row(stream_id=key[0], seq=at, delta=delta or None, finish_reason=finish)
                length = len(text)
                at += 1
        for seq in was - held.keys():
            self.waiting.removeKey((seq,))
        for seq in held.keys() - was:
            self.waiting.updateValue((seq,), held[seq])
        self.head.update((at, length, len(held)))

    def close(self) -> None:
        pass


def stream_delta(chunks: DataFrame, first_seq: int = 1) -> DataFrame:
    """Cumulative text chunks (stream_id, seq, text, finish_reason) → deltas.

    Chunks are taken in ``seq`` order from ``first_seq`` on without gaps, over as many batches
    as it takes: one that comes early waits for those before it, one that comes again is
    ignored. State per stream: the next number, the length of the last text and the
    waiting chunks."""
    rows = chunks.select("stream_id", "seq", "text", "finish_reason")
    return rows.groupBy("stream_id").transformWithState(_Delta(first_seq), DELTA_OUT, "append", "None")


def start_refresh(log_stream: DataFrame, counts_path: str, checkpoint: str, interval: str = "300 seconds"):
    """Dashboard refresh as a long-running query: every ``interval`` the new log
    lines' counts per type are added (a batch that is retried counts once); readers
    use :func:`refresh_counts`. Returns the StreamingQuery."""
    return (log_stream.writeStream.foreachBatch(stream_refresh_batch(counts_path))
            .option("checkpointLocation", checkpoint).trigger(processingTime=interval).start())


def refresh_until_drained(log_stream: DataFrame, counts_path: str, checkpoint: str, compact_every: int = 50) -> None:
    """The same over all input that is there now."""
    spark = log_stream.sparkSession
    fs, at = _hadoop(spark, counts_path)
    fs.mkdirs(at)
    q = (log_stream.writeStream.foreachBatch(stream_refresh_batch(counts_path, compact_every))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def start_daily_log_sink(log_stream: DataFrame, path: str, checkpoint: str, ts: str = "tstamp", available_now: bool = False):
    """Append log lines to date-partitioned JSON files (the writer's Pacific
    date), exactly once through the file sink's checkpoint. Runs continuously,
    or drains what is available when ``available_now``."""
    w = (log_stream.withColumn("date", pacific_day(ts)).writeStream.format("json").partitionBy("date")
         .option("path", path).option("checkpointLocation", checkpoint).outputMode("append"))
    return (w.trigger(availableNow=True) if available_now else w).start()
