"""References to records that do not exist, at the time of the reference.

Distinct keys first: the child table is reduced to one row per foreign key
(map-side combine, so a key that holds a third of all rows shuffles as one row
per task) and left-anti-joined against the parent keys whose validity covers
every use of the key.  Only the keys that survive, the suspects, are joined
back to the child rows; AQE splits a hot suspect on the child side of that
join.  A sound key never causes its child rows to be shuffled when the
suspects are small enough to broadcast, which Spark decides from their size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.functions.keys import month_utc


def parent_keys(present: DataFrame, removed: DataFrame | None = None) -> DataFrame:
    """One row per parent key: (key, valid_from, valid_to).

    ``present`` has (key, valid_from, valid_to); ``removed`` has the same for
    rows that were taken away, whether or not they still stand in the table.
    A present row's start wins over the removal record's.  Null keys are no
    parents.  Repeated keys collapse to the earliest start and earliest end.
    """
    rows = present.select("key", F.col("valid_from").alias("_here"), F.lit(None).cast("timestamp").alias("_gone"), "valid_to")
    if removed is not None:
        rows = rows.unionByName(removed.select("key", F.lit(None).cast("timestamp").alias("_here"), F.col("valid_from").alias("_gone"), "valid_to"))
    return (
        rows.where(F.col("key").isNotNull())
        .groupBy("key")
        .agg(F.min("_here").alias("_here"), F.min("_gone").alias("_gone"), F.min("valid_to").alias("valid_to"))
        .select("key", F.coalesce("_here", "_gone").alias("valid_from"), "valid_to")
    )


def orphan_references(child: DataFrame, parents: DataFrame) -> DataFrame:
    """Child rows whose reference fails at their own time.

    ``child``: (row_key string, fk, t timestamp) plus nothing else needed;
    ``parents``: the result of :func:`parent_keys`.
    Result: (row_key, fk, t, kind) with kind ``missing`` (no such key),
    ``removed`` (valid_to <= t) or ``late`` (valid_from > t), tested in that
    order.  Null foreign keys are no references.  A null t can only be
    ``missing``.  Rows repeated with the same row key, reference and time
    count once.  Empty inputs give an empty result or, for empty parents, all
    references as missing.
    """
    child = child.select("row_key", "fk", "t").where(F.col("fk").isNotNull())
    used = child.groupBy("fk").agg(F.min("t").alias("_lo"), F.max("t").alias("_hi"))
    covers = (F.col("fk") == F.col("key")) & ~(F.col("valid_from") > F.col("_lo")).eqNullSafe(True) & ~(F.col("valid_to") <= F.col("_hi")).eqNullSafe(True)
    suspects = used.join(parents, covers, "left_anti").select("fk")
    known = suspects.join(parents, F.col("fk") == F.col("key"), "left").select(F.col("fk").alias("_fk"), "key", "valid_from", "valid_to")
    kind = (
        F.when(F.col("key").isNull(), F.lit("missing"))
        .when(F.col("valid_to") <= F.col("t"), F.lit("removed"))
        .when(F.col("valid_from") > F.col("t"), F.lit("late"))
    )
    return (
        child.join(known, F.col("fk") == F.col("_fk"))
        .select("row_key", "fk", "t", kind.alias("kind"))
        .where(F.col("kind").isNotNull())
        .dropDuplicates(["row_key", "fk", "t"])
    )


def orphan_counts(orphans: DataFrame) -> DataFrame:
    """Failing references per table, month and kind from rows with (table_name, t, kind)."""
    return orphans.groupBy("table_name", month_utc("t").alias("month_utc"), "kind").agg(F.count(F.lit(1)).alias("n_references"))
