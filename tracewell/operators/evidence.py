"""Competing observations of the same fact, reconciled without guessing.

All operators are aggregations or windows over one fact's observations; a
fact's group is bounded by its sources and captures.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def agree(tolerance_kind: Column, a: Column, b: Column, price_pct: float = 0.1) -> Column:
    """Whether two values agree: null with anything, volumes exactly, others within a share of the larger."""
    near = F.abs(a - b).cast("double") / F.greatest(F.abs(a), F.abs(b), F.lit(1e-9)).cast("double") * 100 <= price_pct
    return F.when(a.isNull() | b.isNull(), F.lit(True)).when(tolerance_kind == "exact", a == b).when((a == 0) & (b == 0), F.lit(True)).otherwise(near)


def reconcile_fields(observations: DataFrame, keys: Sequence[str], precedence: Sequence[str], end_of_day: Sequence[str], intraday_window: str = "post_open") -> DataFrame:
    """One row per (keys, field): the value in force and what else was seen.

    ``observations``: keys, field, tolerance ("pct" or "exact"), source,
    capture_window, observed_at, obs_id, value.  Null values are absent.
    Fields in ``end_of_day`` do not use intraday captures; with nothing else
    they are ``not_yet_available``.  The winner is the first by source
    precedence (unknown sources last), then the latest, then the smallest id.
    Another candidate of the winner's source from another window, or any
    intraday one, is an earlier reading of a moving value: superseded if it
    disagrees.  The others are comparable; if one of them disagrees the field
    is a discrepancy, and all comparable values are its alternates.
    Result: keys, field, value, source, n_candidates, n_superseded,
    n_alternates, state (``discrepancy``, ``settled``, ``not_yet_available``).
    """
    rank = F.coalesce(*[F.when(F.col("source") == s, F.lit(i)) for i, s in enumerate(precedence)], F.lit(len(precedence)))
    rows = observations.where(F.col("value").isNotNull()).withColumn("_use", ~(F.col("field").isin(*end_of_day) & (F.col("capture_window") == intraday_window)))
    group = [*keys, "field"]
    order = Window.partitionBy(*group).orderBy(F.col("_use").desc(), rank, F.col("observed_at").desc(), "obs_id")
    first = order.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"_n": F.row_number().over(order), **{f"_w_{c}": F.first(c).over(first) for c in ("source", "capture_window", "value")}})
    same = agree(F.col("tolerance"), F.col("_w_value"), F.col("value"))
    other = F.col("_use") & (F.col("_n") > 1)
    moving = other & (F.col("source") == F.col("_w_source")) & ((F.col("capture_window") != F.col("_w_capture_window")) | (F.col("capture_window") == intraday_window))
    comparable = other & ~moving
    won = (F.col("_n") == 1) & F.col("_use")
    out = rows.groupBy(*group).agg(
        F.max(F.when(won, F.col("value"))).alias("value"),
        F.max(F.when(won, F.col("source"))).alias("source"),
        F.count_if("_use").alias("n_candidates"),
        F.count_if(moving & ~same).alias("n_superseded"),
        F.count_if(comparable).alias("_c"),
        F.count_if(comparable & ~same).alias("_bad"),
    )
    state = F.when(F.col("n_candidates") == 0, "not_yet_available").when(F.col("_bad") > 0, "discrepancy").otherwise("settled")
    return out.select(*group, "value", "source", "n_candidates", "n_superseded", F.when(F.col("_bad") > 0, F.col("_c")).otherwise(F.lit(0)).alias("n_alternates"), state.alias("state"))


def canonical_rows(fields: DataFrame, keys: Sequence[str], names: Sequence[str], end_of_day: Sequence[str]) -> DataFrame:
    """One row per keys: a column per field and the status of the whole."""
    settled = F.col("field").isin(*end_of_day) & F.col("value").isNotNull()
    out = fields.groupBy(*keys).agg(
        *[F.max(F.when(F.col("field") == n, F.col("value"))).alias(n) for n in names],
        F.count_if(F.col("state") == "discrepancy").alias("_d"),
        F.count_if(settled).alias("_e"),
        F.count_distinct(F.when(F.col("value").isNotNull(), F.col("source"))).alias("n_sources"),
        F.sum("n_alternates").alias("n_alternates"),
        F.sum("n_superseded").alias("n_superseded"),
    )
    status = F.when(F.col("_d") > 0, "discrepancy_flagged").when(F.col("_e") == 0, "pending").when(F.col("n_sources") <= 1, "single_source").otherwise("agreed")
    return out.select(*keys, *names, "n_sources", "n_alternates", "n_superseded", status.alias("status"))


def reconcile_facts(members: DataFrame, fact: str, document: str, value: str, half: str, order: Sequence[str]) -> DataFrame:
    """State and value interval of each fact from printed values with a precision.

    Two values agree when their intervals value -/+ half touch.  On a line all
    pairs agree exactly if one point lies in every interval, so the pairwise
    test is one aggregation: the largest lower end against the smallest upper
    end.  A conflicting fact has no interval and no representative.  The
    representative is a value of the finest precision: the first by ``order``
    if those are equal, none if they differ.
    Result: fact, state, n_documents, n_members, low, high, representative, annotations.
    """
    low, high = F.col(value) - F.col(half), F.col(value) + F.col(half)
    rows = members.where(F.col(value).isNotNull() & F.col(half).isNotNull())
    inner = rows.groupBy(fact, document).agg(
        F.max(low).alias("_lo"), F.min(high).alias("_hi"), F.count(F.lit(1)).alias("_n"), F.min(value).alias("_mn"), F.max(value).alias("_mx"),
        F.min(half).alias("_h"), F.min(F.struct(half, *order, value)).alias("_first"), F.min(F.struct(half, value)).alias("_a"), F.min(F.struct(half, (-F.col(value)).alias("_v"))).alias("_b"),
    )
    out = inner.groupBy(fact).agg(
        F.max("_lo").alias("low"), F.min("_hi").alias("high"), F.sum("_n").alias("n_members"), F.count(F.lit(1)).alias("n_documents"), F.min("_mn").alias("_mn"), F.max("_mx").alias("_mx"),
        F.min("_first").alias("_first"), F.min("_a").alias("_a"), F.min("_b").alias("_b"), F.bool_or(F.col("_lo") > F.col("_hi")).alias("_inside"),
    )
    conflict = F.col("low") > F.col("high")
    settled = lambda c: F.when(~conflict, c)
    same = F.col(f"_a.{value}") == -F.col("_b._v")
    notes = F.array_compact(F.array(F.when(~conflict & (F.col("_mn") != F.col("_mx")), F.lit("agreement_within_precision_only")), F.when(F.col("_inside"), F.lit("internal_conflict")), F.when(~conflict & ~same, F.lit("representative_ambiguous"))))
    return out.select(
        fact,
        F.when(conflict, "conflicting").when(F.col("n_documents") == 1, "single_source").otherwise("corroborated").alias("state"),
        "n_documents", "n_members",
        settled(F.col("low")).alias("low"), settled(F.col("high")).alias("high"),
        F.when(~conflict & same, F.col(f"_first.{value}")).alias("representative"),
        F.array_join(notes, ",").alias("annotations"),
    )


def visible_evidence(rows: DataFrame, mode: str, available: str, known: str, at: Column | None = None, horizon: Column | None = None) -> DataFrame:
    """Rows that a point-in-time question may use; all bounds inclusive.

    ``known``: recorded by T, and available by T or of unknown availability.
    ``available``: recorded by the horizon H (>= T) and available by T.
    ``current``: recorded by H.  ``recorded``: recorded by T, whatever was
    published.  A null recorded time is never known.
    """
    a, k = F.col(available), F.col(known)
    keep = {
        "known": (k <= at) & (a.isNull() | (a <= at)) if at is not None else None,
        "available": (k <= horizon) & (a <= at) if at is not None and horizon is not None else None,
        "current": k <= horizon if horizon is not None else None,
        "recorded": k <= at if at is not None else None,
    }[mode]
    if keep is None:
        raise ValueError(f"mode {mode!r} lacks a cutoff")
    return rows.where(keep)


def merge_listing_fields(versions: DataFrame, key: str, fields: Sequence[str], precedence: Sequence[Column], tolerance: Mapping[str, int] | None = None) -> DataFrame:
    """Field-wise merge of the current item of each source.

    ``versions``: key and a map column ``item``.  For each field the provider
    is the first source by ``precedence`` whose item contains the key; its
    value counts even when null.  n_differences: how many further sources say
    otherwise of a field; in the fields of ``tolerance`` integers less than
    that apart are equal.
    """
    rank = F.struct(*precedence)
    said = F.explode(F.array(*[F.struct(F.lit(f).alias("_f"), F.map_contains_key("item", F.lit(f)).alias("_has"), F.element_at("item", F.lit(f)).alias("_v")) for f in fields]))
    rows = versions.select(key, rank.alias("_at"), said.alias("_s")).select(key, "_at", "_s.*").where("_has")
    # A filing has a handful of sources.
    first = F.first("_v").over(Window.partitionBy(key, "_f").orderBy("_at"))
    rows = rows.withColumn("_first", first)
    near = F.lit(False)
    for f, width in (tolerance or {}).items():
        near = near | ((F.col("_f") == f) & F.coalesce(F.abs(F.col("_v").try_cast("long") - F.col("_first").try_cast("long")) < width, F.lit(False)))
    differs = ~F.col("_v").eqNullSafe(F.col("_first")) & ~near
    merged = rows.groupBy(key).agg(*[F.max(F.when(F.col("_f") == f, F.col("_first"))).alias(f) for f in fields], F.count_if(differs).alias("n_differences"))
    out = versions.groupBy(key).agg(F.count(F.lit(1)).alias("n_sources")).join(merged, key, "left")
    return out.select(key, "n_sources", *fields, F.coalesce("n_differences", F.lit(0).cast("long")).alias("n_differences"))
