import datetime as dt
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from estuary.catalog import streams as CS
from estuary.operators.ratings import elo_shift
from estuary.streaming import ops as ST
from tests.conftest import SF001

SCHEMA = "board long, event_id long, tstamp double, model_a string, model_b string, win string"


def _write(spark, root, name, rows):
    spark.createDataFrame([(0, *r) for r in rows], SCHEMA).coalesce(1).write.mode("overwrite").parquet(os.path.join(root, name))


def test_stream_elo_restart_and_late_rows(spark):
    root = tempfile.mkdtemp(prefix="elo-src-")
    src = os.path.join(root, "in")
    os.makedirs(src)
    ck = tempfile.mkdtemp(prefix="elo-ck-")
    _write(spark, src, "b1", [(1, 100.0, "a", "b", "model_a"), (2, 101.0, "b", "c", "tie"), (3, 102.0, "a", "c", "model_b")])

    out = os.path.join(root, "out")

    def run():
        s = (spark.readStream.schema(SCHEMA).option("recursiveFileLookup", True).parquet(src)
             .withColumn("ts", F.timestamp_micros((F.col("tstamp") * 1_000_000).cast("long"))))
        q = (ST.stream_elo(s, delay="0 seconds").writeStream.outputMode("update").option("checkpointLocation", ck)
             .foreachBatch(lambda b, i: b.write.mode("append").parquet(out)).trigger(availableNow=True).start())
        q.awaitTermination()
        dropped = sum(o["numRowsDroppedByWatermark"] for p in q.recentProgress for o in p["stateOperators"])
        return tuple(spark.read.parquet(out).agg(F.max("folded"), F.max("late")).first()), dropped

    assert run() == ((3, 0), 0)
    _write(spark, src, "b2", [(4, 50.0, "a", "b", "model_b"), (5, 200.0, "a", "b", "model_a")])
    # restart from the checkpoint: t=50 is behind the watermark (dropped, reported); t=200 is folded
    assert run() == ((4, 0), 1)


def test_daily_log_file_sink(spark):
    from estuary.sources import tables as TB

    root = tempfile.mkdtemp(prefix="dlog-")
    log = TB.conv_log(spark, SF001, source=ST.stream_table(spark, SF001, "events")).select("event_id", "tstamp", "type")
    q = ST.start_daily_log_sink(log, os.path.join(root, "logs"), os.path.join(root, "ck"), available_now=True)
    q.awaitTermination()
    back = spark.read.json(os.path.join(root, "logs"))
    assert back.count() == spark.read.parquet(f"{SF001}/events.parquet").count()
    assert back.select("date").distinct().count() >= 28


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _folder_copy(spark, names, files, empty=False):
    """The tables of SF001 as folders of several files, rows in no order (or without rows)."""
    root = tempfile.mkdtemp(prefix="tables-")
    for name in names:
        df = spark.read.parquet(f"{SF001}/{name}.parquet")
        df = df.limit(0) if empty else df.repartition(files, F.rand(7))
        df.write.parquet(f"{root}/{name}.parquet")
    return root


@pytest.fixture(scope="module")
def folders(spark):
    return _folder_copy(spark, ["events", "documents"], 20), _folder_copy(spark, ["events", "documents"], 1, empty=True)


@pytest.mark.parametrize("key", sorted(CS.QUERIES))
def test_streams_over_one_file_many_files_and_none(spark, folders, key):
    q = CS.QUERIES[key]
    many, none = folders
    assert _rows(q(spark, many, max_files=7)) == _rows(q(spark, SF001))
    empty = q(spark, none)
    assert empty.collect() == [] and empty.columns


def test_nested_folders_and_a_folder_without_files(spark):
    root = tempfile.mkdtemp(prefix="logs-")
    for server in ("server0", "server1"):
        spark.range(3).coalesce(1).write.json(f"{root}/{server}/day")
    schema = spark.range(1).schema
    path, ck = (tempfile.mkdtemp(prefix=x) for x in ("out-", "ck-"))
    assert ST.drain(ST.stream_files(spark, root, schema, "json", nested=True), path + "/t", ck).count() == 6
    path, ck = (tempfile.mkdtemp(prefix=x) for x in ("out-", "ck-"))
    assert ST.drain(ST.stream_files(spark, root + "/nothing", schema), path + "/t", ck).count() == 0


def test_manifest_of_a_streaming_sink_is_followed(spark):
    """A file that the sink's log does not name, as a failed attempt leaves it, is not read."""
    root = tempfile.mkdtemp(prefix="sink-")
    src, out = f"{root}/src", f"{root}/out"
    spark.range(5).coalesce(1).write.parquet(src)
    schema = spark.range(1).schema
    q = (ST.stream_files(spark, src, schema).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", f"{root}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    spark.range(100, 103).coalesce(1).write.mode("append").parquet(f"{root}/stray")
    stray = next(f for f in os.listdir(f"{root}/stray") if f.endswith(".parquet"))
    os.link(f"{root}/stray/{stray}", f"{out}/{stray}")
    got = ST.drain(ST.stream_files(spark, out, schema), f"{root}/back", f"{root}/ck2")
    assert sorted(r.id for r in got.collect()) == [0, 1, 2, 3, 4]


def test_refresh_counts_a_retried_batch_once_and_compacts(spark):
    path = tempfile.mkdtemp(prefix="refresh-")
    run = ST.stream_refresh_batch(path, compact_every=3)
    want = {}
    for n in range(9):
        batch = spark.createDataFrame([(t,) for t in ["chat"] * n + ["leftvote"] * 2], "type string")
        for _ in range(1 + n % 2):  # every other batch is run again
            run(batch, n)
        if n in (3, 6):
            run(batch, n)  # a total, or the batch after one
        for t, k in (("chat", n), ("leftvote", 2)):
            want[t] = want.get(t, 0) + k
        got = {r.type: r["count"] for r in ST.refresh_counts(spark, path).collect()}
        assert got == {t: k for t, k in want.items() if k}
    assert len([f for f in os.listdir(path) if f.startswith("batch_id=")]) <= 5  # older ones are in the total


def _stream_of_batches(spark, root, schema, batches):
    """A stream whose files come in the order of ``batches``, one a batch."""
    src = os.path.join(root, "src")
    os.makedirs(src)
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{src}/f{k}")
        for f in os.listdir(f"{src}/f{k}"):
            os.utime(f"{src}/f{k}/{f}", (1_000_000 + k, 1_000_000 + k))
    s = spark.createDataFrame([], schema).schema
    return ST.stream_files(spark, src, s, max_files=1, nested=True)


DELTA = "stream_id long, seq int, text string, finish_reason string"


def test_chunks_in_any_order_give_the_same_deltas(spark):
    rng = random.Random(1)
    rows, want = [], []
    for s in range(30):
        text, prev = "", ""
        for seq in range(1, 9):
            text += rng.choice(["ab", "c\ufffd", "", "dé"])
            clean = text.replace("\ufffd", "")
            fin = "stop" if seq == 8 else None
            rows.append((s, seq, text if text or seq % 2 else None, fin))
            if clean[len(prev):] or fin:
                want.append((s, seq, clean[len(prev):] or None, fin))
            prev = clean
    rows += rng.sample(rows, 20)  # sent again
    rng.shuffle(rows)
    root = tempfile.mkdtemp(prefix="delta-")
    stream = _stream_of_batches(spark, root, DELTA, [rows[k::6] for k in range(6)])
    got = ST.drain(ST.stream_delta(stream), f"{root}/out", f"{root}/ck").drop("_batch")
    assert _rows(got) == sorted(want, key=repr)


def test_a_gap_holds_later_chunks_back(spark):
    root = tempfile.mkdtemp(prefix="gap-")
    stream = _stream_of_batches(spark, root, DELTA, [[(1, 1, "a", None), (1, 3, "abc", "stop")]])
    got = ST.drain(ST.stream_delta(stream), f"{root}/out", f"{root}/ck").drop("_batch")
    assert [tuple(r) for r in got.collect()] == [(1, 1, "a", None)]


def test_battles_in_any_order_give_the_ratings_of_the_ordered_fold(spark):
    """Within the delay the order of arrival does not matter, and passed battles leave the waiting list."""
    rng = random.Random(3)
    battles = [(b, k, 1000.0 + 10 * k + rng.random(), *rng.sample("abcde", 2), rng.choice(["model_a", "model_b", "tie"]))
               for b in range(4) for k in range(60)]
    want = {}
    for b, _, _, left, right, win in sorted(battles, key=lambda r: (r[0], r[2], r[1])):
        gap = want.setdefault((b, left), 1000.0) - want.setdefault((b, right), 1000.0)
        points = elo_shift(gap, {"model_a": 1.0, "model_b": 0.0, "tie": 0.5}[win], 4, 400, 10)
        want[b, left] += points
        want[b, right] -= points
    by_time = sorted(battles, key=lambda r: r[2])
    batches = [by_time[k:k + 40] for k in range(0, 240, 40)]
    for k in range(5):  # neighbouring batches mixed: up to 200 s of disorder
        both = batches[k] + batches[k + 1]
        rng.shuffle(both)
        batches[k], batches[k + 1] = both[:40], both[40:]
    root = tempfile.mkdtemp(prefix="elo-")
    s = _stream_of_batches(spark, root, SCHEMA, batches).withColumn("ts", F.timestamp_micros((F.col("tstamp") * 1_000_000).cast("long")))
    out = ST.drain(ST.stream_elo(s, delay="600 seconds"), f"{root}/out", f"{root}/ck", "update")
    got = {(r.board, r.model): r.rating for r in ST.latest(out, ["board", "model"]).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert out.agg(F.max("late")).first()[0] == 0 and out.agg(F.max("folded")).first()[0] == 60


BEAT = "worker string, beat double, check_heart_beat boolean"


def test_only_checked_workers_expire(spark):
    batches = [[("a", 100.0, True), ("b", 100.0, False), ("c", 100.0, True)], [("c", 300.0, True)], [("d", 1000.0, True)],
               [("a", 1001.0, False)]]
    root = tempfile.mkdtemp(prefix="beat-")
    s = _stream_of_batches(spark, root, BEAT, batches).withColumn("ts", F.timestamp_seconds("beat"))
    out = ST.drain(ST.stream_worker_liveness(s, 90, "10 seconds"), f"{root}/out", f"{root}/ck", "update")
    expired = {(r.worker, r.last_beat) for r in out.where("expired").collect()}
    assert expired == {("a", 100.0), ("c", 300.0)}
    last = ST.latest(out, ["worker"])
    assert {r.worker: (r.beats, r.expired) for r in last.collect()} == {"a": (1, False), "b": (1, False), "c": (2, True), "d": (1, False)}


def test_local_days_close_and_leave_the_state(spark):
    """Three days around a change of clocks: the day of 23 hours has 23 hourly rows, and closed days are evicted."""
    start = dt.datetime(2023, 3, 11, 8, tzinfo=dt.timezone.utc)  # midnight in US/Pacific
    hours = [start + dt.timedelta(hours=h) for h in range(24 + 23 + 24 + 1)]
    rows = [[("chat", h.timestamp(), ["", ""])] for h in hours]
    batches = [sum(rows[k:k + 24], []) for k in range(0, len(rows), 24)]
    root = tempfile.mkdtemp(prefix="days-")
    s = _stream_of_batches(spark, root, "type string, tstamp double, models array<string>", batches)
    s = s.withColumn("ts", F.timestamp_seconds("tstamp"))
    out = f"{root}/out"
    q = (ST.stream_daily_activity(s, watermark="1 hour").writeStream.outputMode("append").option("checkpointLocation", f"{root}/ck")
         .foreachBatch(lambda b, i: b.write.mode("append").parquet(out)).trigger(availableNow=True).start())
    q.awaitTermination()
    assert {(r.series, r.day): r["count"] for r in spark.read.parquet(out).collect()} == {
        ("Chat", "2023-03-11"): 24, ("Chat", "2023-03-12"): 23, ("Chat", "2023-03-13"): 24}
    state = [p["stateOperators"][0] for p in q.recentProgress]
    assert sum(p["numRowsRemoved"] for p in state) == 3 and state[-1]["numRowsTotal"] == 1
