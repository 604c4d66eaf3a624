"""Resumable runs of a Python callable over the rows of a table.

The rows are dealt into slices, one file each, below a shared folder. A file stream hands
a few slices at a time to the callable and commits their results with its checkpoint;
what a commit holds is never run again. A lost executor costs the slices it was working on,
a failed run is taken up by calling it again, and rows that came meanwhile are added as
new slices.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estuary.operators.evaluate import resume_pending
from estuary.streaming.ops import path_exists, stream_files

Task = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]


def add_slices(todo: DataFrame, key: str, folder: str, slices: int) -> DataFrame:
    """Write the rows of ``todo`` whose key has no slice yet as ``slices`` files below ``folder``; returns
    all rows that have one. The slice of a row follows its key, so a retried write deals alike."""
    spark = todo.sparkSession
    if path_exists(spark, folder):
        todo = resume_pending(todo, spark.read.schema(todo.schema).parquet(folder), key)
    number = F.pmod(F.xxhash64(key), F.lit(slices)).cast("int")
    (todo.repartitionById(slices, number).sortWithinPartitions(key).write.mode("append").parquet(folder))
    return spark.read.schema(todo.schema).parquet(folder)


def run_resumable(todo: DataFrame, key: str, task: Task, schema: str | T.StructType, folder: str, slices: int = 64,
                  slices_per_commit: int | None = None) -> DataFrame:
    """Results of ``task`` over every row of ``todo`` (unique ``key``), kept below ``folder``.

    ``task`` gets the rows of a slice in Arrow batches and yields rows of ``schema``; it should
    keep the key in them. At most ``slices_per_commit`` slices (default: as many as the session runs at
    once) are run again after a failure, those whose results were not committed; with 1 no
    finished slice is. NULL keys share a slice. An empty table gives no rows."""
    spark = todo.sparkSession
    add_slices(todo, key, f"{folder}/slices", slices)
    per_commit = slices_per_commit or spark.sparkContext.defaultParallelism
    rows = stream_files(spark, f"{folder}/slices", todo.schema, max_files=per_commit)
    q = (rows.mapInPandas(task, schema).writeStream.format("parquet").option("path", f"{folder}/results")
         .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    want = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    if not path_exists(spark, f"{folder}/results"):
        return spark.createDataFrame([], want)
    return spark.read.schema(want).parquet(f"{folder}/results")
