"""Distributed global ordinals and halo-bucketed sliding windows.

Neither uses an unpartitioned Window over data-sized input (that would pull
every row into one task); both stay in the DataFrame API.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F


MAX_RANGES = 4096
RANGE_SAMPLES = 32  # sampled rows for each range


def range_splitters(df: DataFrame, order: list[str], ranges: int | None = None,
                    rows_per_range: int = 2_000_000) -> list[Row]:
    """Keys that cut the rows of ``df``, in the order ``order``, into ranges of about equal size.

    They come from a sample of whole keys (rows whose key hash is below a threshold, so the
    choice is the same in every run): however many rows share the first columns, the
    following ones split them. ``ranges`` grows with the rows, up to MAX_RANGES; at most
    MAX_RANGES * RANGE_SAMPLES keys reach the driver. Keys are whole, so order by short columns."""
    n = df.count()
    if not ranges:
        floor = max(64, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        ranges = min(MAX_RANGES, max(floor, -(-n // rows_per_range)))
    keys = df.select(*order)
    share = ranges * RANGE_SAMPLES / max(n, 1)
    if share < 1:
        keys = keys.where(F.pmod(F.xxhash64(*order), F.lit(1 << 30)) < int(share * (1 << 30)))
    sample = keys.orderBy(*order).collect()
    picks = [sample[k * len(sample) // ranges] for k in range(1, ranges)] if sample else []
    return [p for p, q in zip(picks, [None, *picks]) if p != q]


def range_of(df: DataFrame, order: list[str], splitters: list[Row]) -> Column:
    """Number of splitters that are not after a row's key: a binary search in a constant array."""
    if not splitters:
        return F.lit(0).cast("long")
    kind = dict(df.dtypes)
    key = F.struct(*[F.col(c) for c in order])
    all_keys = F.array(*[F.struct(*[F.lit(v).cast(kind[c]).alias(c) for c, v in zip(order, s)]) for s in splitters])
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(splitters).bit_length()))])
    # try_element_at: beyond the last splitter there is none, and the comparison is NULL
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        F.try_element_at(all_keys, at + step) <= key, at + step).otherwise(at)).cast("long")


def global_ordinal(df: DataFrame, order: list[str], name: str = "pos", buckets: int | None = None,
                   rows_per_bucket: int = 2_000_000, bucket: Column | None = None) -> DataFrame:
    """0-based position of each row in the total order ``order`` (end with a unique tie-break
    column; any sortable types, NULL first).

    Rows go to ranges of the whole order, bounded by sampled keys (see
    :func:`range_splitters`; the sample is taken when this is called), so a first key that
    most rows share is split by the columns after it. The range is a deterministic function of the key:
    recomputation after a lost executor gives the same positions. Range counts (at most
    MAX_RANGES rows) get a running sum for the offsets; rows are numbered inside their
    range only.

    ``bucket`` may give a monotone (non-decreasing in ``order``) integer expression
    instead whose values are known to be even, e.g. the top bits of a hash; then nothing is
    sampled.
    """
    if bucket is None:
        bucket = range_of(df, order, range_splitters(df, order, buckets, rows_per_bucket))
    return _ordinal_by_bucket(df.withColumn("_b", bucket.cast("long")), order, name)


def _ordinal_by_bucket(tagged: DataFrame, order: list[str], name: str) -> DataFrame:
    counts = tagged.groupBy("_b").agg(F.count(F.lit(1)).alias("_cnt"))  # one row per range, at most MAX_RANGES (or hash buckets)
    offsets = counts.select("_b", (F.sum("_cnt").over(Window.orderBy("_b")) - F.col("_cnt")).alias("_off"))
    within = tagged.withColumn("_r", F.row_number().over(Window.partitionBy("_b").orderBy(*order)) - 1)
    return (within.join(F.broadcast(offsets), "_b")
            .withColumn(name, F.col("_off") + F.col("_r"))
            .drop("_b", "_off", "_r"))


def halo_slices(df: DataFrame, key: list[str], t: str, width: int, columns: list[str], bucket: int = 4096,
                at: str = "at") -> DataFrame:
    """Rows (``key``, an array of each of ``columns``, ``at``): for each position t that ``width`` - 1 others
    follow in its key, place ``at`` (from 1) of the arrays is t and the following places are t + 1 and so
    on (dense integer ``t`` assumed). Take windows with ``slice(column, at, n)``.

    Long series are cut into buckets of ``bucket`` steps; the first ``width`` - 1
    rows of a bucket are copied to the previous one (the halo), so one series
    never has to fit in one task and a hot key is spread over many tasks. A bucket's values are
    gathered once, in arrays of at most ``bucket`` + ``width`` places, and each window is a slice of them:
    no value is copied for each window that it is in.
    """
    bucket = max(bucket, width)
    b = F.floor(F.col(t) / bucket).cast("long")
    halo = (F.col(t) % bucket < width - 1) & (b > 0)
    spread = df.withColumn("_bkt", F.explode(F.when(halo, F.array(b, b - 1)).otherwise(F.array(b))))
    held = spread.groupBy(*key, "_bkt").agg(F.sort_array(F.collect_list(F.struct(t, *[c for c in columns if c != t]))).alias("_w"))
    arrays = held.select(*key, *[F.col(f"_w.{c}").alias(c) for c in columns])
    n = F.size(columns[0]) - (width - 1)
    return arrays.where(n > 0).select("*", F.explode(F.sequence(F.lit(1), n)).alias(at))


def blocked_running(df: DataFrame, key: list[str], order: str, value: str, fn: str, block: int = 1024,
                    inclusive: bool = True, name: str = "running") -> DataFrame:
    """Running min/max of ``value`` along integer ``order`` within ``key``.

    A two-level prefix scan: rows are grouped into blocks of ``block`` steps;
    the block aggregates (1/block of the rows) get a running value per key and
    each row combines it with the running value inside its own block. So no
    task ever holds a whole key, however long or hot it is.
    """
    agg = {"min": F.min, "max": F.max}[fn]
    combine = F.least if fn == "min" else F.greatest  # both skip NULLs
    d = df.withColumn("_blk", F.floor(F.col(order) / block).cast("long"))
    per_block = d.groupBy(*key, "_blk").agg(agg(value).alias("_bv"))
    prior = per_block.select(*key, "_blk", agg("_bv").over(
        Window.partitionBy(*key).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)).alias("_pv"))
    within = d.withColumn("_wv", agg(value).over(
        Window.partitionBy(*key, "_blk").orderBy(order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)))
    return (within.join(prior, [*key, "_blk"], "left")
            .withColumn(name, combine(F.col("_wv"), F.col("_pv")))
            .drop("_blk", "_wv", "_pv"))
