"""Key normalisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Outer blanks that do not count.
BLANKS = " \t\n\r\f\u000b\u00a0"


def uuid_key(c: str | Column) -> Column:
    """A uuid reference without case, outer blanks and braces; null when nothing is left."""
    s = F.lower(F.btrim(as_col(c).cast("string"), F.lit(BLANKS + "{}")))
    return F.when(F.length(s) > 0, s)


def bare(c: str | Column) -> Column:
    """Text without case and outer blanks of any kind."""
    return F.lower(F.btrim(as_col(c), F.lit(BLANKS)))


def month_utc(ts: str | Column) -> Column:
    """``YYYY-MM`` of an instant, in UTC whatever the session zone is."""
    return F.date_format(F.to_utc_timestamp(as_col(ts), F.current_timezone()), "yyyy-MM")


def kept_once(df: DataFrame, condition: Column) -> DataFrame:
    """Filter by a column whose expression is long, without computing it a second time.

    A filter is otherwise pushed below the projections it reads from, which
    repeats their expressions.  The partition number, being no deterministic
    expression, keeps it above.
    """
    return df.withColumn("_here", F.spark_partition_id()).where((F.col("_here") >= 0) & condition).drop("_here")


def with_one_row(df: DataFrame, totals: DataFrame) -> DataFrame:
    """``df`` with the columns of an ungrouped aggregate: in effect a cross join, with exactly one row."""
    return df.withColumn("_one", F.lit(1)).join(F.broadcast(totals.withColumn("_one", F.lit(1))), "_one").drop("_one")
