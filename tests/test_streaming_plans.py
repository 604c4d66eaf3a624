from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.conftest import SF001, SF01


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_streaming_equals_batch(spark):
    q = E.queries()
    assert _rows(q["stream_daily_activity"](spark, SF001)) == _rows(q["daily_activity"](spark, SF001))
    assert _rows(q["stream_elo"](spark, SF001)) == _rows(q["elo_online"](spark, SF001))


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["id", "n", "t", "human", "gpt"]


def test_every_key_has_an_entry_and_names_match_oracles():
    q, o = E.queries(), E.oracle_sql()
    assert len(q) >= 150
    assert set(o) <= set(q)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_plan_has_no_cartesian_and_prunes_columns(spark):
    df = E.queries()["render_instruction"](spark, SF01)
    plan = _plan(df)
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan or "BroadcastExchange" in plan


def test_scan_prunes_and_pushes(spark):
    from estuary.operators import series as S
    from estuary.sources import tables as TB

    df = S.date_membership_filter(TB.table(spark, SF01, "orders").select("o_orderkey", F.col("o_orderdate").alias("date")),
                                  "1995-01-01", "1995-12-31")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


AUDITED = ["render_instruction", "sliding_windows", "zscore_by_site", "clean_battles", "elo_online", "pairwise_win_fraction",
           "battle_counts", "model_call_histogram", "hourly_last_day", "detect_language", "semantic_search", "quantize_groups",
           "masked_mean_pool", "cumulative_to_delta", "supervision_mask_v1", "plateau_detect", "batch_assign", "usage_totals",
           "worker_liveness", "weighted_pair_sample"]


def test_no_cartesian_product_in_registered_plans(spark):
    q = E.queries()
    for key in AUDITED:
        plan = _plan(q[key](spark, SF001))
        assert "CartesianProduct" not in plan, key
