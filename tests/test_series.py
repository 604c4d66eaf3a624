import math
from datetime import date, timedelta

from pyspark.sql import Window
from pyspark.sql import functions as F

from estuary.operators import series as S
from estuary.plans.ordinal import blocked_running, global_ordinal


def _facts(spark, days, drop=(), empty_sed=(), empty_dis=()):
    rows = []
    for site in ("s1", "s2"):
        for i in range(days):
            if (site, i) in drop:
                continue
            d = date(2024, 1, 1) + timedelta(days=i)
            rows.append((site, d, None if (site, i) in empty_sed else float(i + 1),
                         None if (site, i) in empty_dis else float(100 + i)))
    return spark.createDataFrame(rows, "site string, date date, sediment double, discharge double")


def _sites(spark):
    return spark.createDataFrame([(0, "s1"), (1, "s2")], "n int, site string")


def test_missing_rules_and_window_count(spark):
    facts = _facts(spark, 26, drop={("s1", 3)}, empty_sed={("s1", 4)}, empty_dis={("s2", 5)})
    dense = S.densify_series(facts, _sites(spark), "2024-01-01", 26)
    got = {(r.site, r.t): (r.sediment, r.discharge) for r in dense.collect()}
    assert got[("s1", 3)] == (0.0, 0.0)          # absent row → 0 / 0
    assert got[("s1", 4)] == (0.0, 104.0)        # empty sediment → 0
    assert math.isnan(got[("s2", 5)][1])         # empty discharge → NaN
    w = S.sliding_windows(dense, 26, drop_last=True)
    assert w.count() == 2 * (26 - 24)


def test_last_window_rule(spark):
    for days, train, enc in ((25, 1, 2), (24, 0, 1)):
        dense = S.densify_series(_facts(spark, days), _sites(spark), "2024-01-01", days)
        assert S.sliding_windows(dense, days, drop_last=True).count() == 2 * train
        assert S.sliding_windows(dense, days, drop_last=False).count() == 2 * enc


def test_halo_buckets_equal_plain_windows(spark):
    dense = S.densify_series(_facts(spark, 60), _sites(spark), "2024-01-01", 60)
    a = S.sliding_windows(dense, 60, bucket=4096).select("site", "t", "x_sediment", "y_discharge")
    b = S.sliding_windows(dense, 60, bucket=24).select("site", "t", "x_sediment", "y_discharge")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_format_values_python_rounding(spark):
    df = spark.createDataFrame([([0.125, 0.375, 2.675, 1.005, float("nan")],)], "x array<double>")
    from estuary.functions.exprs import fmt2_join

    got = df.select(fmt2_join("x").alias("s")).first().s
    assert got == " ".join(f"{v:.2f}" for v in [0.125, 0.375, 2.675, 1.005, float("nan")])
    assert got == "0.12 0.38 2.67 1.00 nan"


def test_flow_description_empty_and_lists(spark):
    sites = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "n int, site string")
    edges = spark.createDataFrame([(0, 1, 2.0), (1, 0, -1.0), (0, 0, 5.0)], "src int, dst int, direction double")
    ft = {r.n: r.flow_text for r in S.flow_description(S.flow_neighbors(edges, sites)).collect()}
    assert ft[2] == ""
    assert ft[0] == "The water flows out from this site: to site B. "
    assert ft[1] == "The water flows into this site: from site A. "


def test_instruction_id_parse_roundtrip(spark):
    df = spark.createDataFrame([("train_discharge_site_3_4_len_17",), ("bad_id",)], "id string")
    rows = {r.id: r for r in S.parse_instruction_id(df).collect()}
    r = rows["train_discharge_site_3_4_len_17"]
    assert (r.region_start, r.region_end, r.snapshot, r.bad_id) == (3, 4, 17, False)
    assert rows["bad_id"].bad_id is True


def test_global_ordinal_matches_row_number(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k"), F.col("id").alias("tie"))
    o = global_ordinal(df, ["k", "tie"], "pos", buckets=17)
    ref = df.withColumn("rn", F.row_number().over(Window.orderBy("k", "tie")) - 1)
    j = o.join(ref, ["k", "tie"])
    assert j.where("rn != pos").count() == 0 and j.count() == 5000


def test_ordinal_splits_equal_first_keys_text_keys_and_nulls(spark):
    """90 % of the rows share the first key: no range holds more than twice the median rows."""
    from estuary.plans.ordinal import range_of, range_splitters

    df = spark.range(60_000).select(
        F.when(F.col("id") % 10 == 0, F.col("id").cast("string")).when(F.col("id") % 1001 != 1, "hot" * 10).alias("k"),
        F.md5(F.col("id").cast("string")).alias("t"), F.col("id").alias("tie"))
    order = ["k", "t", "tie"]
    splitters = range_splitters(df, order, 16)
    sizes = sorted(r["count"] for r in df.groupBy(range_of(df, order, splitters).alias("r")).count().collect())
    assert len(sizes) == 16 and sizes[-1] < 2 * sizes[8]
    o = global_ordinal(df, order, "pos", buckets=16)
    ref = df.withColumn("rn", F.row_number().over(Window.orderBy(*order)) - 1).select("tie", "rn")
    j = o.join(ref, "tie")
    assert j.where("rn != pos").count() == 0 and j.count() == 60_000


def test_ordinal_of_an_empty_table_and_other_types(spark):
    df = spark.createDataFrame([], "k string, tie long")
    assert global_ordinal(df, ["k", "tie"]).collect() == []
    days = spark.range(300).select(F.date_add(F.lit("2024-01-01"), (F.col("id") % 7).cast("int")).alias("d"),
                                   (F.col("id") / 3).cast("decimal(10,2)").alias("x"), F.col("id").alias("tie"))
    got = global_ordinal(days, ["d", "x", "tie"], buckets=9).orderBy("pos").collect()
    assert [r.pos for r in got] == list(range(300))
    assert [tuple(r)[:3] for r in got] == sorted(tuple(r)[:3] for r in got)


def test_blocked_running_min(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("run"), F.col("id").alias("e"),
                                  ((F.col("id") * 37) % 101).cast("double").alias("l"))
    b = blocked_running(df, ["run"], "e", "l", "min", block=50, inclusive=False, name="pm")
    ref = df.withColumn("ref", F.min("l").over(Window.partitionBy("run").orderBy("e").rowsBetween(Window.unboundedPreceding, -1)))
    j = b.join(ref, ["run", "e"])
    assert j.where(~F.col("pm").eqNullSafe(F.col("ref"))).count() == 0


def test_unpivot_rejects_duplicate_dates(spark):
    wide = spark.createDataFrame([(date(2024, 1, 1), 1.0, 2.0), (date(2024, 1, 1), 3.0, 4.0), (date(2024, 1, 2), 5.0, None)],
                                 "date date, a double, b double")
    assert [r.date for r in S.duplicate_dates(wide).collect()] == [date(2024, 1, 1)]
    long = S.unpivot_sites(wide, "v", sites=["b"]).collect()
    assert [(r.date, r.site, r.v) for r in long] == [(date(2024, 1, 2), "b", None)]


def test_record_at(spark):
    from estuary.sources.files import record_at

    df = spark.range(100).select(F.col("id").alias("k"), (F.col("id") * 3).alias("v"))
    assert record_at(df, ["k"], 7).first().v == 21
    assert record_at(df, ["k"], -1).first().v == 297
