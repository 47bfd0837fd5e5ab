"""Attributes as known at event time.

Change rows become validity intervals [change, next change).  Intervals are
exploded into time buckets, events fall into one bucket each, and the two meet
in an equi-join on (entity, bucket) with half-open containment, so an event
finds at most one interval and nothing known later.  An entity's last interval
has no end and is not exploded: events from its start on meet it in a join by
entity alone, and only the others go on to the buckets.

Buckets adapt to the data: a bucket of the base width that holds more than
``VERSIONS_PER_BUCKET`` versions of its entity is split into 64 narrower ones,
those again where they are full, down to the microsecond if need be.  So an
entity that holds a third of all rows, or has all its versions in one hour,
spreads over many join keys, and no bucket brings many versions before its
events.  Where nothing is that full, as mostly, none of the splitting is
planned.  Successive change times of a split entity are found inside groups of
neighbouring buckets and stitched over one summary row per group, so no window
sees more than that of one entity.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewell.sources.shared import materialize

# Base bucket width: 2**45 microseconds, about 407 days; each level divides by 2**6.
BASE_BITS = 45
STEP_BITS = 6
VERSIONS_PER_BUCKET = 64
# A group of neighbouring buckets spans two levels: at most 64 * 64 full buckets.
GROUP_LEVELS = 2


def _width(level: int) -> int:
    return 1 << max(0, BASE_BITS - STEP_BITS * level)


def _long(n: int) -> Column:
    return F.lit(n).cast("long")


def _start(micros: Column, level: int) -> Column:
    """Where the bucket of an instant begins; rounding down before 1970 as well."""
    return micros - F.pmod(micros, _long(_width(level)))


def _full_buckets(per: DataFrame) -> list[DataFrame]:
    """Per level the buckets (_e, _b) to be split; as many levels as the data need."""
    out: list[DataFrame] = []
    inside = per.select("_e", "_from")
    # One change per entity and instant: a bucket of a microsecond is never full, so this ends.
    while _width(len(out)) > 1:
        level = len(out)
        counted = inside.withColumn("_b", _start(F.col("_from"), level)).groupBy("_e", "_b").agg(F.count(F.lit(1)).alias("_n"))
        full = counted.where(F.col("_n") > VERSIONS_PER_BUCKET).select("_e", "_b")
        if full.isEmpty():
            break
        full = materialize(full, "pit-full")
        out.append(full)
        inside = inside.withColumn("_b", _start(F.col("_from"), level)).join(full, ["_e", "_b"], "left_semi").drop("_b")
    return out


def _in_leaf(rows: DataFrame, at: str, full: list[DataFrame]) -> DataFrame:
    """``rows`` (_e, instant ``at``) with the level ``_l`` and start ``_b`` of the bucket that is not split."""
    rows = rows.withColumns({"_l": F.lit(0), "_b": _start(F.col(at), 0)})
    for level, buckets in enumerate(full, 1):
        split = buckets.withColumn("_split", F.lit(True))
        rows = rows.join(split, ["_e", "_b"], "left")
        deeper = F.col("_split").isNotNull() & (F.col("_l") == level - 1)
        rows = rows.withColumns({"_b": F.when(deeper, _start(F.col(at), level)).otherwise(F.col("_b")), "_l": F.when(deeper, F.lit(level)).otherwise(F.col("_l"))}).drop("_split")
    return rows


def _exploded(spans: DataFrame, full: list[DataFrame]) -> DataFrame:
    """``spans`` (_e, _from, last instant ``_last_in``) once per bucket they touch; a long span is cut into blocks of buckets first."""

    def starts(low: Column, high: Column, level: int) -> DataFrame:
        width = _width(level)
        first, last = _start(low, level), _start(high, level)
        block = width << 10
        spread = spans.withColumns({"_low": first, "_high": last}).withColumn("_block", F.explode(F.sequence(first - F.pmod(first, _long(block)), last - F.pmod(last, _long(block)), _long(block))))
        inside = F.sequence(F.greatest("_low", "_block"), F.least(F.col("_high"), F.col("_block") + _long(block - width)), _long(width))
        return spread.withColumn("_b", F.explode(inside)).drop("_low", "_high", "_block")

    spans = starts(F.col("_from"), F.col("_last_in"), 0)
    done = None
    for level, buckets in enumerate(full):
        spans = spans.join(buckets.withColumn("_split", F.lit(True)), ["_e", "_b"], "left")
        whole = spans.where(F.col("_split").isNull()).drop("_split").withColumn("_l", F.lit(level))
        done = whole if done is None else done.unionByName(whole)
        # Of a bucket that is split, the narrower ones between the span's own ends.
        end = F.col("_b") + _long(_width(level) - 1)
        spans = spans.where(F.col("_split").isNotNull()).withColumns({"_clip_a": F.greatest("_from", "_b"), "_clip_b": F.least(F.col("_last_in"), end)}).drop("_split", "_b")
        spans = starts(F.col("_clip_a"), F.col("_clip_b"), level + 1).drop("_clip_a", "_clip_b")
    last = spans.withColumn("_l", F.lit(len(full)))
    return last if done is None else done.unionByName(last)


def _intervals(per: DataFrame, full: list[DataFrame], state: str) -> DataFrame:
    """(_e, _from, _until, _rank): half-open validity intervals; the last of an entity has no end."""
    if not full:
        order = Window.partitionBy("_e").orderBy("_from")
        spans = per.withColumn("_until", F.lead("_from").over(order))
        return spans.withColumn("_rank", F.max("_rank").over(order.rowsBetween(Window.unboundedPreceding, 0))) if state == "highest" else spans
    deepest = None
    for level, buckets in enumerate(full, 1):
        d = buckets.select("_e", F.lit(level).alias("_d"))
        deepest = d if deepest is None else deepest.unionByName(d)
    deepest = deepest.groupBy("_e").agg(F.greatest(F.lit(0), F.max("_d") - GROUP_LEVELS).alias("_g"))
    rows = _in_leaf(per, "_from", full).join(deepest, "_e", "left")
    # Groups do not overlap: a bucket wider than the entity's group level is a group of its own.
    group = F.lit(0).cast("long")
    for level in range(len(full) + 1):
        group = F.when(F.least("_l", "_g") == level, _start(F.col("_from"), level)).otherwise(group)
    rows = rows.withColumn("_group", F.when(F.col("_g").isNotNull(), group)).drop("_l", "_b", "_g")
    inside = Window.partitionBy("_e", "_group").orderBy("_from")
    across = Window.partitionBy("_e").orderBy("_group")
    stitch = (
        rows.groupBy("_e", "_group")
        .agg(F.min("_from").alias("_first"), F.max("_rank").alias("_top"))
        .select("_e", "_group", F.lead("_first").over(across).alias("_after"), F.max("_top").over(across.rowsBetween(Window.unboundedPreceding, -1)).alias("_carry"))
    )
    spans = rows.withColumn("_next", F.lead("_from").over(inside))
    if state == "highest":
        spans = spans.withColumn("_rank", F.max("_rank").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    s, t = spans.alias("s"), stitch.alias("t")
    joined = s.join(t, (F.col("s._e") == F.col("t._e")) & F.col("s._group").eqNullSafe(F.col("t._group")))
    rank = F.greatest("s._rank", "t._carry") if state == "highest" else F.col("s._rank")
    return joined.select("s._e", "s._from", F.coalesce("s._next", "t._after").alias("_until"), rank.alias("_rank"))


@dataclass(frozen=True)
class Changes:
    """Rows that say from when on an entity has which ``rank`` columns.

    ``state="latest"``: the latest change is in force; ``"highest"``: the
    largest rank so far is, whenever it came.
    """

    rows: DataFrame
    time: str
    rank: tuple[str, ...]
    state: str = "latest"


def known_states(events: DataFrame, entity: str, event_time: str, changes: Sequence[Changes], final_prefix: str | None = None) -> DataFrame:
    """``events`` with the ``rank`` columns of each table of changes, as in force at ``event_time``.

    Of several changes of an entity at one instant the one with the largest
    ``rank`` (compared column by column) counts.  A change holds from its own
    instant on, inclusive.  With ``final_prefix`` the state that the whole
    table says is added too.  The events pass once over the entities, and those
    before the last change of a table over its buckets.

    Events before the first change, without entity, or without time have null
    values; every event row is kept once.  Changes without entity or time say
    nothing.  ``rank`` columns replace event columns of the same name.
    """
    names = [n for c in changes for n in c.rank]
    kept = [c for c in events.columns if c not in names]
    # The event's own columns travel as one value, so none of their names can clash.
    placed = events.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_event"), F.col(entity).alias("_e"), F.unix_micros(F.col(event_time)).alias("_t"))
    tables = []
    for i, c in enumerate(changes):
        per = (
            c.rows.where(F.col(entity).isNotNull() & F.col(c.time).isNotNull())
            .select(F.col(entity).alias("_e"), F.unix_micros(F.col(c.time)).alias("_from"), F.struct(*c.rank).alias("_rank"))
            .groupBy("_e", "_from")
            .agg(F.max("_rank").alias("_rank"))
        )
        # Read several times below.
        per = materialize(per, "pit-changes")
        tables.append((per, _full_buckets(per)))
        top = F.max("_rank") if c.state == "highest" else F.max_by("_rank", "_from")
        placed = placed.join(per.groupBy("_e").agg(F.max("_from").alias(f"_last{i}"), top.alias(f"_final{i}")), "_e", "left")
    # Divided below, by each table, into the events before its last change and the others.
    placed = materialize(placed, "pit-events")
    for i, (c, (per, full)) in enumerate(zip(changes, tables)):
        # From an entity's last change on its state is the final one, which the event has met already.
        before = F.coalesce(F.col("_t") < F.col(f"_last{i}"), F.lit(False))
        later = placed.where(~before).withColumn(f"_rank{i}", F.when(F.col("_t").isNotNull(), F.col(f"_final{i}")))
        spans = _exploded(_intervals(per, full, c.state).where(F.col("_until").isNotNull()).withColumn("_last_in", F.col("_until") - 1), full)
        spans = spans.select(F.col("_e").alias("_se"), F.col("_l").alias("_sl"), F.col("_b").alias("_sb"), "_from", "_until", F.col("_rank").alias(f"_rank{i}"))
        held = (F.col("_e") == F.col("_se")) & (F.col("_l") == F.col("_sl")) & (F.col("_b") == F.col("_sb")) & (F.col("_from") <= F.col("_t")) & (F.col("_t") < F.col("_until"))
        met = _in_leaf(placed.where(before).withColumn("_at", F.col("_t")), "_at", full).join(spans, held, "left")
        placed = met.select(*later.columns).unionByName(later)
    out = [F.col("_event").getField(n).alias(n) for n in kept]
    for i, c in enumerate(changes):
        out += [F.col(f"_rank{i}").getField(n).alias(n) for n in c.rank]
        if final_prefix is not None:
            out += [F.col(f"_final{i}").getField(n).alias(f"{final_prefix}{n}") for n in c.rank]
    return placed.select(*out)


def known_at(events: DataFrame, changes: DataFrame, entity: str, event_time: str, change_time: str, rank: Sequence[str], state: str = "latest", final_prefix: str | None = None) -> DataFrame:
    """:func:`known_states` for one table of changes."""
    return known_states(events, entity, event_time, [Changes(changes, change_time, tuple(rank), state)], final_prefix)
