"""Batch-evaluation data flow and metrics: ordinal slices, contiguous chunks,
resume, result assembly, MAE variants, label binarisation, BCE with logits,
task routing, echo mismatch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estuary.functions.exprs import py_strip
from estuary.plans.ordinal import global_ordinal


def id_range_slice(df: DataFrame, order: list[str], start: int, end: int | None) -> DataFrame:
    """``items[start:end]`` by position (half-open), positions from a distributed ordinal."""
    o = global_ordinal(df, order, "pos")
    cond = F.col("pos") >= start
    if end is not None:
        cond = cond & (F.col("pos") < end)
    return o.where(cond)


def chunk_assign(df: DataFrame, order: list[str], k: int) -> DataFrame:
    """Contiguous chunks of ``n // k`` rows, the last chunk takes the rest
    (never fails, unlike the reference when the remainder is large)."""
    o = global_ordinal(df, order, "pos")
    n = df.agg(F.count(F.lit(1)).alias("_n"))
    size = F.greatest(F.floor(F.col("_n") / k), F.lit(1))
    return (o.crossJoin(F.broadcast(n))
            .withColumn("chunk", F.least(F.floor(F.col("pos") / size), F.lit(k - 1)).cast("int"))
            .withColumn("chunk_start", F.col("chunk") * size).drop("_n"))


def resume_pending(todo: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    """Items without a stored result (anti join on the id)."""
    return todo.join(done.select(key), key, "left_anti")


def strip_stop_suffix(text: Column, stop: str) -> Column:
    """``strip``, drop a trailing stop string, ``strip`` again."""
    s = py_strip(text)
    return py_strip(F.when(F.endswith(s, F.lit(stop)), s.substr(F.lit(1), F.length(s) - len(stop))).otherwise(s))


def mae(df: DataFrame, true: str, pred: str, mask_value: float | None = None, mask: Column | None = None) -> Column:
    """Mean absolute error; ``mask`` multiplies both sides first (zeros still
    count), ``mask_value`` keeps only elements with ``true > mask_value``.
    No kept element → NULL."""
    t, p = F.col(true), F.col(pred)
    if mask is not None:
        t, p = t * mask, p * mask
    err = F.abs(t - p)
    if mask_value is not None:
        err = F.when(t > mask_value, err)
    return F.avg(err)


def binarize(c: Column) -> Column:
    return F.when(c >= 1, F.lit(1.0)).otherwise(F.lit(0.0))


def bce_with_logits(x: Column, y: Column) -> Column:
    """Numerically stable per-element BCE with logits."""
    return F.greatest(x, F.lit(0.0)) - x * y + F.log1p(F.exp(-F.abs(x)))


def task_route(features: Column) -> tuple[Column, Column]:
    """Task type = last feature; 3 or 4 → classification, else regression."""
    task = F.element_at(features, -1)
    return task, F.when(task.isin(3, 4), F.lit("classification")).otherwise(F.lit("regression"))


def echo_mismatch(input_ids: Column, output_ids: Column) -> Column:
    """Positions where the output's prefix differs from the input ids (a
    shorter output counts its missing positions as different)."""
    n = F.size(input_ids)
    prefix = F.slice(output_ids, 1, n)
    padded = F.concat(prefix, F.array_repeat(F.lit(None).cast("int"), F.greatest(n - F.size(prefix), F.lit(0))))
    return F.size(F.filter(F.zip_with(input_ids, padded, lambda a, b: ~a.eqNullSafe(b)), lambda d: d))
