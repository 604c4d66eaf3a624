"""Helpers shared by the registered queries: flat output types and a scratch
folder on the shared checkpoint location."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estuary.session import checkpoint_dir


def flat(df: DataFrame) -> DataFrame:
    """Checked outputs use BIGINT / DOUBLE / STRING / BOOLEAN only: integers are
    widened, dates and timestamps rendered as ISO text."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(t, T.FloatType):
            c = c.cast("double")
        elif isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(t, T.DecimalType):
            c = c.cast("double")
        out.append(c.alias(f.name))
    return df.select(*out)


def scratch_path(spark: SparkSession, name: str) -> str:
    """Fresh folder under the shared checkpoint location (never a machine-local
    temp folder on a cluster)."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/estuary-out/{name}-{uuid.uuid4().hex[:12]}"
