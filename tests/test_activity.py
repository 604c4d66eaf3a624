from pyspark.sql import functions as F

from estuary.operators import activity as A


def _log(spark, rows):
    return spark.createDataFrame(rows, "event_id long, tstamp double, model string, type string, models array<string>")


def test_model_idle_last_hour_vanishes(spark):
    now = 1_700_000_000.0
    log = _log(spark, [(1, now, "a", "chat", ["", ""]), (2, now - 7200, "b", "chat", ["", ""]),
                       (3, now - 60, "a", "chat", ["", ""])])
    h = {r.model: (r["All"], r["Last Day"], r["Last Hour"]) for r in A.model_call_histogram(log).collect()}
    assert h == {"a": (2, 2, 2)}


def test_hourly_last_day_keeps_zeros(spark):
    now = 1_700_000_000.0
    log = _log(spark, [(1, now, "a", "chat", ["", ""]), (2, now - 3 * 3600 - 5, "a", "leftvote", ["", ""])])
    rows = A.hourly_last_day(log).collect()
    assert len(rows) == 24 and sum(r.value for r in rows) == 1


def test_pacific_day_across_dst(spark):
    # 2023-03-12 is a 23-hour day in America/Los_Angeles.
    from estuary.functions.exprs import pacific_day

    start = 1678608000.0  # 2023-03-12 08:00 UTC = 00:00 PST
    df = spark.createDataFrame([(start + h * 3600.0,) for h in range(24)], "t double")
    days = [r.d for r in df.select(pacific_day("t").alias("d")).collect()]
    assert days.count("2023-03-12") == 23 and days.count("2023-03-13") == 1


def test_plateau_detect_equal_loss_is_improvement(spark):
    losses = [5.0, 4.0, 4.0] + [4.5] * 3
    df = spark.createDataFrame([(1, i + 1, l) for i, l in enumerate(losses)], "run_id long, epoch long, loss double")
    r = A.plateau_detect(df, patience=3).first()
    assert (r.stop_epoch, r.best_epoch, r.best_loss) == (6, 3, 4.0)


def test_plateau_with_delta(spark):
    curves = {1: [1.0, 0.95, 0.85, 0.84, 0.8], 2: [2.0, 3.0, 1.0, 1.5, 1.2, 0.5], 3: [0.5]}
    df = spark.createDataFrame([(r, i + 1, x) for r, xs in curves.items() for i, x in enumerate(xs)],
                               "run_id long, epoch long, loss double")
    # stop epoch, best loss, its epoch, epochs seen
    want = {0.0: {1: (None, 0.8, 5, 5), 2: (5, 1.0, 3, 5), 3: (None, 0.5, 1, 1)},
            0.1: {1: (5, 0.85, 3, 5), 2: (5, 1.0, 3, 5), 3: (None, 0.5, 1, 1)}}
    for delta, expected in want.items():
        got = {r.run_id: (r.stop_epoch, r.best_loss, r.best_epoch, r.epochs_seen)
               for r in A.plateau_detect(df, patience=2, delta=delta).collect()}
        assert got == expected
