"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from estuary.session import checkpoint_dir
from estuary.sources.tables import table

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"

__all__ = ["WORD", "SPACE", "SPACE_CHARS", "table", "words", "word_count", "materialize", "scratch", "id_text",
           "id_crc32", "rebatched", "trimmed", "release_memory"]


def words(text: Column | str) -> Column:
    """Array of the maximal runs of non-space characters (space, tab to CR); NULL text gives []."""
    t = F.col(text) if isinstance(text, str) else text
    parts = F.split(F.btrim(F.coalesce(t, F.lit("")), F.lit(SPACE_CHARS)), SPACE)
    # only a text without any word leaves one empty string
    return F.when(F.element_at(parts, 1) == "", F.array().cast("array<string>")).otherwise(parts)


def word_count(text: Column | str) -> Column:
    """Number of words as BIGINT; NULL text counts 0.

    Every run of spaces that follows a word ends it, so the words are counted
    by the characters that start one.
    """
    t = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(t, F.lit(WORD)), F.lit(0)).cast("bigint")


def id_text(c: Column | str) -> Column:
    """The id as text; a NULL id is the empty string."""
    return F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))


def id_crc32(c: Column | str) -> Column:
    """crc32 of the id's text, for hash splits into training and held-out rows."""
    return F.crc32(F.encode(id_text(c), "UTF-8"))


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint location."""
    return f"{checkpoint_dir(spark).rstrip('/')}/estuary-llm/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet below the shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor re-reads the files) and, unlike an RDD
    checkpoint, keeps the size statistics that adaptive joins rely on.
    """
    path = scratch(df.sparkSession, name)
    df.write.mode("error").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def rebatched(batches: Iterator[pa.RecordBatch], text: str, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the ``text`` column of each piece holds about
    ``max_bytes`` (one longer text is a piece of its own). Bounds task memory
    whatever the number of rows Spark puts into a batch."""
    for b in batches:
        if not b.num_rows:
            continue
        sizes = pa.compute.fill_null(pa.compute.binary_length(b.column(text)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if held and held + n > max_bytes:
                yield b.slice(start, i - start)
                start, held = i, 0
            held += int(n) + 16
        yield b.slice(start)


def release_memory() -> None:
    """Give freed memory back to the system: a Python worker lives on after its task
    and shares the executor's memory with later tasks of other kinds."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # a C library without it
        pass


def trimmed(batches: Iterator) -> Iterator:
    """The same batches; memory is released after the last one."""
    yield from batches
    release_memory()
