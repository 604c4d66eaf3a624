"""File scans and sinks with explicit schemas (no inference)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ------------------------------------------------------------------ schemas

GEN_PARAMS = T.StructType([
    T.StructField("temperature", T.DoubleType()),
    T.StructField("top_p", T.DoubleType()),
    T.StructField("max_new_tokens", T.LongType()),
])

STATE = T.StructType([
    T.StructField("system", T.StringType()),
    T.StructField("roles", T.ArrayType(T.StringType())),
    T.StructField("messages", T.ArrayType(T.ArrayType(T.StringType()))),
    T.StructField("offset", T.IntegerType()),
    T.StructField("sep", T.StringType()),
    T.StructField("sep2", T.StringType()),
    T.StructField("conv_id", T.StringType()),
    T.StructField("model_name", T.StringType()),
])

LOG_LINE = T.StructType([
    T.StructField("tstamp", T.DoubleType()),
    T.StructField("type", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("models", T.ArrayType(T.StringType())),
    T.StructField("gen_params", GEN_PARAMS),
    T.StructField("start", T.DoubleType()),
    T.StructField("finish", T.DoubleType()),
    T.StructField("state", STATE),
    T.StructField("states", T.ArrayType(STATE)),
    T.StructField("ip", T.StringType()),
])

BATTLE = T.StructType([
    T.StructField("model_a", T.StringType()),
    T.StructField("model_b", T.StringType()),
    T.StructField("win", T.StringType()),
    T.StructField("anony", T.BooleanType()),
    T.StructField("rounds", T.IntegerType()),
    T.StructField("language", T.StringType()),
    T.StructField("tstamp", T.DoubleType()),
])

INSTRUCTION = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("conversations", T.ArrayType(T.StructType([
        T.StructField("from", T.StringType()), T.StructField("value", T.StringType())]))),
])

REVIEW = T.StructType([
    T.StructField("_idx", T.LongType()),
    T.StructField("Id", T.LongType()),
    T.StructField("ProductId", T.StringType()),
    T.StructField("UserId", T.StringType()),
    T.StructField("Score", T.LongType()),
    T.StructField("Summary", T.StringType()),
    T.StructField("Text", T.StringType()),
    T.StructField("Time", T.LongType()),
])


def wide_schema(site_codes: list[str]) -> T.StructType:
    return T.StructType([T.StructField("date", T.DateType())] + [T.StructField(c, T.DoubleType()) for c in site_codes])


# ------------------------------------------------------------------ scans


def scan_wide_series(spark: SparkSession, path: str, site_codes: list[str]) -> DataFrame:
    """Wide CSV: ``date`` + one DOUBLE per site code; empty cell → NULL."""
    return spark.read.schema(wide_schema(site_codes)).option("header", True).option("mode", "FAILFAST").csv(path)


def scan_flow_matrix(spark: SparkSession, path: str) -> DataFrame:
    """Flow CSV → edges (src_id, dst_col, direction). The source id is the first
    column by position, whatever its header says."""
    raw = spark.read.option("header", True).csv(path)
    first, rest = raw.columns[0], raw.columns[1:]
    typed = raw.select(F.col(f"`{first}`").cast("long").alias("src_id"),
                       *[F.col(f"`{c}`").cast("double").alias(c) for c in rest])
    return (typed.unpivot(["src_id"], rest, "dst_col", "direction")
            .where(F.col("direction").isNotNull()))


def scan_conv_log(spark: SparkSession, path: str, stream: bool = False, mode: str = "FAILFAST") -> DataFrame:
    """JSON lines with the four fields the statistics use; absent ``model`` → ''
    and absent ``models`` → ['', '']. A malformed line fails the scan (as
    ``json.loads`` does; ``mode="PERMISSIVE"`` keeps going). ``type`` and
    ``tstamp`` are required: rows missing them are flagged (``bad_row``),
    since an absent field is NULL even in FAILFAST mode."""
    reader = (spark.readStream if stream else spark.read).schema(LOG_LINE).option("mode", mode)
    df = reader.json(path)
    return df.select(
        "type", "tstamp", F.coalesce("model", F.lit("")).alias("model"),
        F.coalesce("models", F.array(F.lit(""), F.lit(""))).alias("models"),
        (F.col("type").isNull() | F.col("tstamp").isNull()).alias("bad_row"))


def log_files_index(spark: SparkSession, root: str, glob: str = "*-conv.json",
                    server_re: str = r"server(\d+)/", date_re: str = r"(\d{4}-\d{2}-\d{2})-conv\.json$") -> DataFrame:
    """Every log file under ``root`` as a row (path, server, date); the default
    layout is ``server{i}/{YYYY-MM-DD}-conv.json``. Only the listing is used:
    the binary-file source does not read content unless it is selected."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", "true").load(root).select("path"))
    return files.select(
        "path",
        F.regexp_extract("path", server_re, 1).cast("int").alias("server"),
        F.regexp_extract("path", date_re, 1).alias("date"))


def select_log_files(index: DataFrame, dates: list[str], max_num_files: int | None = None) -> DataFrame:
    """``get_log_files``: files of the listed dates (date, then server number),
    keeping the last ``max_num_files``. The rank runs over the file index, whose
    size is the number of files, not of log rows."""
    from pyspark.sql import Window

    order = [F.col("date").desc(), F.col("server").desc()]
    wanted = index.where(F.col("date").isin(dates))
    if max_num_files:
        wanted = wanted.orderBy(*order).limit(max_num_files)  # a top-k; only its rows are ranked
    return wanted.withColumn("rank_from_end", F.row_number().over(Window.orderBy(*order)))


def default_dates() -> list[str]:
    """April and May 2023, day 1..31 each (04-31 never exists on disk)."""
    return [f"2023-{m:02d}-{d:02d}" for m in (4, 5) for d in range(1, 32)]


def cutoff_dates() -> tuple[list[str], str]:
    """The cleaning variant: 2023-04-24..2023-05-23 and the cutoff ``20230523``."""
    dates = [f"2023-04-{d:02d}" for d in range(24, 32)] + [f"2023-05-{d:02d}" for d in range(1, 24)]
    return dates, dates[-1].replace("-", "")


def scan_battles_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BATTLE).option("multiLine", True).json(path)


def scan_instructions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INSTRUCTION).option("multiLine", True).json(path)


REVIEW_COLUMNS = ["Time", "ProductId", "UserId", "Score", "Summary", "Text"]


def scan_reviews(spark: SparkSession, path: str, cols: list[str] = REVIEW_COLUMNS) -> DataFrame:
    """``read_csv(index_col=0)``, keep the review columns, drop rows with any NULL."""
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    keep = df.select(*[F.col(c) for c in cols])
    return keep.na.drop(how="any")


# ------------------------------------------------------------------ sinks


def sink_json(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.json(path)


def sink_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def sink_parquet_by_key(df: DataFrame, path: str, key: str, order: list[str], folders: int | None = None) -> None:
    """Parquet partitioned by a key of any number of values: folders ``part=0..`` (as many as shuffle
    partitions by default) of one file each, all rows of a key in one folder, side by side and in order, so a
    reader of one key opens one file and skips by its statistics. A folder for each value would make
    as many files as values, each opened, committed and listed on its own."""
    folders = folders or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.withColumn("part", F.pmod(F.xxhash64(key), F.lit(folders)).cast("int"))
    (dealt.repartition("part").sortWithinPartitions("part", key, *order).write.mode("overwrite")
     .partitionBy("part").parquet(path))


def sink_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def sink_json_arrays(df: DataFrame, path: str, order: list[str], rows_per_file: int = 20_000) -> None:
    """Write JSON-array documents (the ``json.dump(list)`` layout) of at most
    ``rows_per_file`` rows each: rows are numbered by a distributed ordinal,
    each slice becomes one array and one file, so no slice is unbounded."""
    from estuary.plans.ordinal import global_ordinal

    o = global_ordinal(df, order, "_pos").withColumn("_slice", F.floor(F.col("_pos") / rows_per_file))
    docs = (o.groupBy("_slice")
            .agg(F.sort_array(F.collect_list(F.struct("_pos", F.to_json(F.struct(*df.columns)).alias("_j")))).alias("_r"))
            .select("_slice", F.concat(F.lit("["), F.array_join(F.transform("_r", lambda s: s["_j"]), ",\n"), F.lit("]")).alias("value")))
    docs.repartition("_slice").write.mode("overwrite").partitionBy("_slice").text(path)


def scan_json_arrays(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Each file is one JSON array; every element becomes a row."""
    return spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True).json(path)


def preview_profile(tables: dict[str, DataFrame], array_col: tuple[str, str] | None = None) -> DataFrame:
    """``head()/shape/len`` as one table: per input its row count (a distributed
    count) and column count; optionally the max size of an array column."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("name"), "n_rows",
                                                              F.lit(len(df.columns)).alias("n_cols"))
             for name, df in tables.items()]
    if array_col:
        name, col = array_col
        parts.append(tables[name].agg(F.max(F.size(col)).alias("n_rows")).select(
            F.lit(f"{name[:-1] if name.endswith('s') else name}_dims").alias("name"), "n_rows", F.lit(1).alias("n_cols")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def content_hash_dedup(content: DataFrame, keys: list[str] = ["date", "h"], first: str = "doc_id") -> DataFrame:
    """Keep one item per (date, content hash): the first writer wins. An
    aggregate with map-side combine, so a heavily copied item never reaches
    one task as all its copies."""
    return content.groupBy(*keys).agg(F.min(first).alias(first))


def record_at(df: DataFrame, order: list[str], index: int) -> DataFrame:
    """``items[index]`` of an ordered table (negative counts from the end), via
    the distributed ordinal – never by collecting the table."""
    from estuary.plans.ordinal import global_ordinal

    o = global_ordinal(df, order, "_pos")
    if index >= 0:
        return o.where(F.col("_pos") == index).drop("_pos")
    n = df.agg(F.count(F.lit(1)).alias("_n"))
    return o.crossJoin(F.broadcast(n)).where(F.col("_pos") == F.col("_n") + index).drop("_pos", "_n")
