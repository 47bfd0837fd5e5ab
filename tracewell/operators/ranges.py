"""Range conditions without nested loops."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewell.operators.ordered import hot_keys, one_window, with_previous


def active_per_day(spans: DataFrame, start: str, end: str, day: str, name: str) -> DataFrame:
    """How many spans (both ends inclusive) contain each day between the first start and the last end.

    Every span is +1 on its first day and -1 on the day after its last; a
    running sum over days replaces the range join, so the work is one
    aggregation and a window over the calendar.  Spans that lack an end or end
    before they start contain no day.
    """
    s = spans.where(F.col(start) <= F.col(end))
    steps = s.select(F.inline(F.array(F.struct(F.col(start).alias("_d"), F.lit(1).alias("_k")), F.struct(F.date_add(end, 1).alias("_d"), F.lit(-1).alias("_k"))))).groupBy("_d").agg(F.sum("_k").alias("_k"))
    calendar = s.agg(F.min(start).alias("_a"), F.max(end).alias("_b")).where(F.col("_a").isNotNull()).select(F.explode(F.sequence("_a", "_b")).alias("_d"))
    run = F.sum(F.coalesce("_k", F.lit(0).cast("long"))).over(Window.orderBy("_d"))
    return calendar.join(steps, "_d", "left").select(F.col("_d").alias(day), run.alias(name))


def count_within(left: DataFrame, key: str, value: str, right: DataFrame, other: str, tolerance: int, name: str) -> DataFrame:
    """Per left row, how many right values lie within +/- tolerance (integers).

    Right values are counted per distinct value first, and meet the left in
    three buckets of tolerance width: an equi-join with a residual test.
    """
    width = F.lit(int(tolerance))
    counts = right.where(F.col(other).isNotNull()).groupBy(F.col(other).alias("_w")).agg(F.count(F.lit(1)).alias("_n")).withColumn("_b", F.floor(F.col("_w") / width))
    near = left.select(key, F.col(value).alias("_v"), F.explode(F.sequence(F.floor(F.col(value) / width) - 1, F.floor(F.col(value) / width) + 1)).alias("_b"))
    got = near.join(counts, "_b").where(F.abs(F.col("_v") - F.col("_w")) <= width).groupBy(key).agg(F.sum("_n").alias(name))
    return left.select(key).join(got, key, "left").select(key, F.coalesce(name, F.lit(0).cast("long")).alias(name))


def missing_pairs(rows: DataFrame, key: str, ordinal: Column, block: int = 1024) -> DataFrame:
    """(key, i, j): the pairs i < j < n of each key's n rows of which at least one ordinal is not among them.

    Ordinals (counted from 0) are held per block of ``block`` of them, so no
    row or task has a whole key: a key's blocks meet pairwise by equi-join of
    (key, block), and a pair of blocks that lack nothing is never opened.  Every
    pair that is formed is in the result, or has i >= j within one block.
    """
    width = F.lit(int(block)).cast("long")
    ids = rows.select(F.col(key).alias("_key"), ordinal.cast("long").alias("_o"))
    sizes = ids.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"))
    held = ids.where(F.col("_o") >= 0).groupBy("_key", F.call_function("div", F.col("_o"), width).alias("_b")).agg(F.collect_set("_o").alias("_h"))
    last = F.call_function("div", F.col("_n") - 1, width)
    spans = sizes.select("_key", "_n", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("_b"))
    s, h = spans.alias("s"), held.alias("h")
    every = F.sequence(F.col("s._b") * width, F.least((F.col("s._b") + 1) * width, F.col("s._n")) - 1)
    full = s.join(h, F.col("s._key").eqNullSafe(F.col("h._key")) & (F.col("s._b") == F.col("h._b")), "left")
    blocks = full.select("s._key", "s._n", "s._b", every.alias("_every"), F.array_except(every, F.coalesce("h._h", F.array().cast("array<bigint>"))).alias("_lacks"))
    low = blocks.select("_key", "_every", "_lacks", F.explode(F.sequence(F.col("_b"), last)).alias("_to"))
    a, b = low.alias("a"), blocks.alias("b")
    met = a.join(b, F.col("a._key").eqNullSafe(F.col("b._key")) & (F.col("a._to") == F.col("b._b"))).where((F.size("a._lacks") > 0) | (F.size("b._lacks") > 0))
    firsts = met.select(F.col("a._key").alias(key), F.explode("a._every").alias("i"), "a._lacks", F.col("b._every").alias("_every"), F.col("b._lacks").alias("_other"))
    seconds = F.when(F.array_contains("_lacks", F.col("i")), F.col("_every")).otherwise(F.col("_other"))
    return firsts.select(key, "i", F.explode(seconds).alias("j")).where(F.col("i") < F.col("j"))


def touching_pairs(spans: DataFrame, key: str, low: Column, high: Column) -> DataFrame:
    """Per key with at least two spans: n_pairs of them, and n_agreeing that share a point (ends included).

    Two spans are apart exactly if one ends before the other starts, so the
    pairs that are apart are counted by one running sum over the key's distinct
    ends and starts; no pair is formed.  Spans lacking an end, or ending before
    they start, are left out.
    """
    s = spans.select(F.col(key).alias("_k"), low.alias("_a"), high.alias("_b")).where(F.col("_a") <= F.col("_b"))
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    marks = s.select("_k", F.inline(F.array(F.struct(F.col("_a").alias("_x"), one.alias("_starts"), none.alias("_ends")), F.struct(F.col("_b").alias("_x"), none.alias("_starts"), one.alias("_ends")))))
    # Spans bound the marks of a key, and are counted at less cost.
    if hot_keys(s, ["_k"]) is None:
        # At one place starts come before ends, which touch them; the order of equal marks does not matter.
        seen = one_window(marks, ["_k"], ["_x", "_ends"], sums=["_ends"])
    else:
        seen = with_previous(marks.groupBy("_k", "_x").agg(F.sum("_starts").alias("_starts"), F.sum("_ends").alias("_ends")), ["_k"], ["_x"], sums=["_ends"])
    out = seen.groupBy("_k").agg(F.sum("_starts").alias("_n"), F.sum(F.col("_starts") * F.coalesce("_before__ends", none)).alias("_apart")).where(F.col("_n") > 1)
    pairs = F.call_function("div", F.col("_n") * (F.col("_n") - 1), F.lit(2).cast("long"))
    return out.select(F.col("_k").alias(key), pairs.alias("n_pairs"), (pairs - F.col("_apart")).alias("n_agreeing"))


def nearest_one_to_one(left: DataFrame, right: DataFrame, group: str, left_key: str, right_key: str, position: str, tolerance: float, margin: float = 0.0) -> DataFrame:
    """(group, left_key, right_key, distance): greedy pairs of a group, nearest first, each row used once.

    Only pairs within ``tolerance`` are candidates.  A left row whose next
    unused candidate is less than ``margin`` further away is ambiguous and gets
    none.  Ties go to the smaller left key, then the smaller right key.  Groups
    are statements and columns of a page, so a task holds whole ones; rows
    without position take no part.
    """
    kinds = {f.name: f.dataType.simpleString() for f in left.schema.fields} | {f.name: f.dataType.simpleString() for f in right.schema.fields}
    schema = f"`{group}` {kinds[group]}, `{left_key}` {kinds[left_key]}, `{right_key}` {kinds[right_key]}, distance double"

    def assign(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        a, b = a.dropna(subset=[position]), b.dropna(subset=[position])
        far = sorted((abs(float(x) - float(y)), i, j) for i, x in zip(a[left_key], a[position]) for j, y in zip(b[right_key], b[position]) if abs(float(x) - float(y)) <= tolerance)
        of: dict = {}
        for distance, i, j in far:
            of.setdefault(i, []).append((distance, j))
        taken, paired, unclear = set(), {}, set()
        for distance, i, j in far:
            if i in paired or i in unclear or j in taken:
                continue
            if any(d - distance < margin for d, k in of[i] if k != j and k not in taken):
                unclear.add(i)
                continue
            paired[i] = (j, distance)
            taken.add(j)
        key = a[group].iloc[0] if len(a) else None
        return pd.DataFrame([(key, i, j, d) for i, (j, d) in paired.items()], columns=[group, left_key, right_key, "distance"])

    own = lambda df, key: df.select(group, key, position).groupBy(group)
    return own(left, left_key).cogroup(own(right, right_key)).applyInPandas(assign, schema)
