"""Parquet table access: one immutable directory is one snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewell.session import ship


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """Read one table; zone-less timestamps are declared UTC instants."""
    ship(spark)
    df = spark.read.parquet(f"{directory}/{name}.parquet")
    naive = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in naive}) if naive else df
