"""Rows in order: latest per key, chains, change events, gaps, order checks, samples, digests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewell.sources.shared import materialize

# A key with more rows than this is not ordered by one task.
HOT_ROWS = 5_000_000


def hot_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame | None:
    """(keys, _n) of the keys with more than ``HOT_ROWS`` rows; None, after one aggregation, if there is none."""
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > HOT_ROWS)
    return None if counts.isEmpty() else materialize(counts, "hot-keys")


def with_previous(rows: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str] = (), carry: Sequence[str] = (), sums: Sequence[str] = ()) -> DataFrame:
    """``rows`` with what came before each within its key, in a total ``order``.

    Adds ``_seq`` (from 1), ``_prev`` (struct of ``columns`` of the row before,
    null on the first), ``_known_<c>`` for each of ``carry`` (its last value
    before that is not null) and ``_before_<c>`` for each of ``sums`` (the sum
    of the rows before, null on the first).  Null keys are one key.

    One window, unless a key has more than ``HOT_ROWS`` rows: those keys are
    divided by ranges of the order, each range is worked through by a task of
    its own, and ranges are stitched over one summary row each.
    """
    keys, order = list(keys), list(order)
    hot = hot_keys(rows, keys)
    if hot is None:
        return one_window(rows, keys, order, columns, carry, sums)
    total = hot.agg(F.sum("_n")).first()[0]
    same = lambda a, b: [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys]
    cold = rows.alias("r").join(hot.alias("h"), same("r", "h"), "left_anti")
    many = rows.alias("r").join(hot.alias("h"), same("r", "h"), "left_semi")
    ranged = materialize(many.repartitionByRange(max(2, -(-total // (HOT_ROWS // 4))), *keys, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    inside = one_window(ranged, [*keys, "_range"], order, columns, carry, sums)
    at = F.struct(*order)
    last = [F.count(F.lit(1)).alias("_c"), F.max_by(F.struct(F.lit(True).alias("_"), *columns), at).alias("_l")]
    last += [F.max_by(F.struct(c), F.when(F.col(c).isNotNull(), at)).getField(c).alias(f"_k_{c}") for c in carry] + [F.sum(c).alias(f"_s_{c}") for c in sums]
    across = Window.partitionBy(*keys).orderBy("_range")
    upto = across.rowsBetween(Window.unboundedPreceding, -1)
    ends = ranged.groupBy(*keys, "_range").agg(*last)
    ends = ends.select(*keys, "_range", F.coalesce(F.sum("_c").over(upto), F.lit(0).cast("long")).alias("_c"), F.lag("_l").over(across).alias("_l"), *[F.last(f"_k_{c}", ignorenulls=True).over(upto).alias(f"_k_{c}") for c in carry], *[F.sum(f"_s_{c}").over(upto).alias(f"_s_{c}") for c in sums])
    joined = inside.alias("a").join(ends.alias("b"), [*same("a", "b"), F.col("a._range") == F.col("b._range")])
    a, b = lambda c: F.col(f"a.{c}"), lambda c: F.col(f"b.{c}")
    prev = F.when(a("_seq") > 1, a("_prev")).when(b("_l").isNotNull(), F.struct(*[F.col(f"b._l.{c}").alias(c) for c in columns])) if columns else F.lit(None)
    before = [F.when(a(f"_before_{c}").isNull(), b(f"_s_{c}")).otherwise(a(f"_before_{c}") + F.coalesce(b(f"_s_{c}"), F.lit(0))).alias(f"_before_{c}") for c in sums]
    stitched = joined.select(*[a(f"`{c}`") for c in rows.columns], (a("_seq") + b("_c")).alias("_seq"), *([prev.alias("_prev")] if columns else []), *[F.coalesce(a(f"_known_{c}"), b(f"_k_{c}")).alias(f"_known_{c}") for c in carry], *before)
    return one_window(cold, keys, order, columns, carry, sums).unionByName(stitched)


def one_window(rows: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str] = (), carry: Sequence[str] = (), sums: Sequence[str] = ()) -> DataFrame:
    """:func:`with_previous` where no key is hot."""
    w = Window.partitionBy(*keys).orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, -1)
    added = {"_seq": F.row_number().over(w).cast("long")}
    if columns:
        added["_prev"] = F.lag(F.struct(*columns)).over(w)
    added |= {f"_known_{c}": F.last(c, ignorenulls=True).over(upto) for c in carry} | {f"_before_{c}": F.sum(c).over(upto) for c in sums}
    return rows.withColumns(added)


def latest_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key in a total order; a row number filter, which Spark plans as a group limit before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def append_chain(rows: DataFrame, keys: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """Adds ``sequence`` from 1 and ``previous_<value>`` within each key."""
    out = with_previous(rows, keys, order, [value])
    return out.withColumns({"sequence": F.col("_seq"), f"previous_{value}": F.col("_prev").getField(value)}).drop("_seq", "_prev")


def change_events(rows: DataFrame, keys: Sequence[str], order: Sequence[str], any_change: Sequence[str], increases: Sequence[str]) -> DataFrame:
    """Rows at which a watched column changed against the row before, with the names of what changed.

    ``any_change`` counts changes from or to null; ``increases`` need both values.
    """
    watched = list(dict.fromkeys([*any_change, *increases]))
    out = with_previous(rows, keys, order, watched)
    was = F.col("_prev").getField
    marks = [F.when((F.col("_seq") > 1) & ~F.col(c).eqNullSafe(was(c)), F.lit(f"{c}_changed")) for c in any_change]
    marks += [F.when(F.col(c) > was(c), F.lit(f"{c}_increased")) for c in increases]
    return out.withColumn("changes", F.array_join(F.array_compact(F.array(*marks)), ",")).where(F.col("changes") != "").drop("_seq", "_prev")


def order_violations(rows: DataFrame, keys: Sequence[str], ordinal: str, strictly: Sequence[str]) -> DataFrame:
    """Per key: pairs of neighbours whose composite does not strictly increase, and whether ordinals run 0..n-1 without gaps."""
    w = Window.partitionBy(*keys).orderBy(ordinal, *strictly)
    here = F.struct(*strictly)
    marked = rows.withColumn("_bad", (F.row_number().over(w) > 1) & ~(F.lag(here).over(w) < here))
    gapless = (F.max(ordinal) == F.count(F.lit(1)) - 1) & (F.min(ordinal) == 0) & (F.count_distinct(ordinal) == F.count(F.lit(1)))
    return marked.groupBy(*keys).agg(F.count_if("_bad").alias("n_not_increasing"), gapless.alias("gapless"))


def previous_value(rows: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str) -> DataFrame:
    """Adds the last non-null value strictly before each row."""
    return with_previous(rows, keys, order, carry=[value]).withColumnRenamed(f"_known_{value}", name).drop("_seq")


def cadence(rows: DataFrame, keys: Sequence[str], month_index: Column) -> DataFrame:
    """Per key the most frequent gap between successive months, the smallest on a tie; keys with at least two gaps."""
    months = rows.select(*keys, month_index.alias("_m")).distinct()
    gaps = months.withColumn("gap", F.col("_m") - F.lag("_m").over(Window.partitionBy(*keys).orderBy("_m"))).where(F.col("gap").isNotNull())
    counts = gaps.groupBy(*keys, "gap").agg(F.count(F.lit(1)).alias("_n"))
    out = counts.groupBy(*keys).agg(F.sum("_n").alias("n_gaps"), F.min(F.struct((-F.col("_n")).alias("_k"), "gap")).alias("_b"))
    return out.where(F.col("n_gaps") >= 2).select(*keys, "n_gaps", F.col("_b.gap").cast("long").alias("cadence_months"))


def rotating_sample(rows: DataFrame, seed: str, key: str, n: int) -> DataFrame:
    """n rows by the hash of seed and key: the same for a seed, another for the next.  A top-k, not a sort of all rows."""
    return rows.orderBy(F.sha2(F.concat_ws("|", F.lit(seed), F.col(key).cast("string")), 256), key).limit(n)


def stratified_sample(rows: DataFrame, stratum: Sequence[str], seed: str, key: str, n: int) -> DataFrame:
    """Round-robin over strata, hash order inside each: round by round, strata in order, n rows in all."""
    h = F.sha2(F.concat_ws("|", F.lit(seed), F.col(key).cast("string")), 256)
    # No stratum gives more than n rows, so the window is a group limit.
    ranked = rows.withColumn("round", F.row_number().over(Window.partitionBy(*stratum).orderBy(h, key)).cast("long")).where(F.col("round") <= n)
    return ranked.orderBy("round", *stratum).limit(n)


def canonical_text(c: Column, kind: T.DataType) -> Column:
    """A value as text that two values share only if they are equal: null is ``-``, everything else its length, a colon and its text.

    Doubles that eight decimals hold exactly are written with them, others as
    the shortest text that reads back; instants are microseconds; the elements
    of an array follow one another in this form.
    """
    if isinstance(kind, T.ArrayType):
        text = F.array_join(F.transform(c, lambda x: canonical_text(x, kind.elementType)), "")
    elif isinstance(kind, T.DoubleType | T.FloatType):
        printed = c.cast("string")
        exact = printed.try_cast("decimal(30,8)")
        text = F.when(exact == printed.try_cast("decimal(38,16)"), exact.cast("string")).otherwise(printed)
    elif isinstance(kind, T.TimestampType):
        text = F.unix_micros(c).cast("string")
    else:
        text = c.cast("string")
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def table_digest(rows: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Order-independent digest of whole rows: row count and the sum of the rows' SHA-256 modulo 2**256, as eight 32-bit limbs summed apart.

    Limb sums stay below 2**63 for up to 2**31 rows per partial sum and are
    decimals beyond, so any partitioning gives the same digest.
    """
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    text = F.concat(*[canonical_text(F.col(f"`{c}`"), kinds[c]) for c in columns or rows.columns])
    hashed = rows.select(F.sha2(text, 256).alias("_h"))
    return hashed.agg(F.count(F.lit(1)).alias("n_rows"), *limb_sums("_h"))


def limb_sums(digest: str) -> list[Column]:
    """The eight 32-bit limbs of a SHA-256 in hex, summed apart; none at all sum to 0."""
    zero = F.lit(0).cast("decimal(38,0)")
    return [F.coalesce(F.sum(F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("decimal(20,0)")).cast("decimal(38,0)"), zero).alias(f"limb_{i}") for i in range(8)]


def illegal_transitions(events: DataFrame, keys: Sequence[str], order: Sequence[str], state: str, legal: DataFrame) -> DataFrame:
    """Steps of an event log that are not in the table ``legal`` (from_state, to_state), with counts."""
    steps = with_previous(events.select(*dict.fromkeys([*keys, *order, state])), keys, order, [state])
    steps = steps.select(F.col("_prev").getField(state).alias("from_state"), F.col(state).alias("to_state")).where(F.col("from_state").isNotNull())
    return steps.join(legal, ["from_state", "to_state"], "left_anti").groupBy("from_state", "to_state").agg(F.count(F.lit(1)).alias("n_steps"))


def constraint_violations(rows: DataFrame, key: str, checks: dict[str, Column]) -> DataFrame:
    """(key, check_name) of every failed check; like SQL, a check that is null passes.  One scan for all checks."""
    failed = F.array_compact(F.array(*[F.when(~c, F.lit(n)) for n, c in checks.items()]))
    return rows.select(key, F.explode(failed).alias("check_name"))


def rows_to_append(held: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Rows of a batch whose key is not held yet, each key once: the first in a total order."""
    return latest_per_key(batch.join(held.select(*keys).distinct(), list(keys), "left_anti"), keys, order)


def order_statistics(rows: DataFrame, key: str, value: str) -> DataFrame:
    """least, most, median and p90 of each key's values (integers).

    The median of an even number of values is the mean of the middle two; p90
    is the value at place 0.9 (n - 1) from 0, rounded half to even.  Values are
    counted per distinct value before anything is ranked, and a key with very
    many distinct values is ranked in ranges.
    """
    counts = rows.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count(F.lit(1)).alias("_c"))
    zero = F.lit(0).cast("long")
    ranked = with_previous(counts, [key], [value], sums=["_c"]).withColumn("_a", F.coalesce("_before__c", zero))
    # A row per key: joined back to its distinct values.
    sizes = counts.groupBy(F.col(key).alias("_k")).agg(F.sum("_c").alias("_n"))
    ranked = ranked.join(sizes, F.col(key).eqNullSafe(F.col("_k")))
    div = lambda x, n: F.call_function("div", x, F.lit(n).cast("long"))
    holds = lambda i: (F.col("_a") <= i) & (i < F.col("_a") + F.col("_c"))
    at = lambda i: F.max(F.when(holds(i), F.col(value)))
    tenths = (F.col("_n") - 1) * 9
    low, over = div(tenths, 10), tenths % 10
    place = low + F.when((over > 5) | ((over == 5) & (low % 2 == 1)), 1).otherwise(0)
    out = ranked.groupBy(key).agg(F.min(value).alias("least"), F.max(value).alias("most"), at(div(F.col("_n") - 1, 2)).alias("_m1"), at(div(F.col("_n"), 2)).alias("_m2"), at(place).alias("p90"))
    return out.select(key, "least", "most", ((F.col("_m1") + F.col("_m2")) / 2).alias("median"), "p90")
