"""What changed between consecutive full snapshots.

Every row shrinks to three integers (snapshot ordinal, 64-bit key, 64-bit
content hash).  These compact rows are hash-bucketed by key; a bucket is
loaded into numpy arrays, sorted once, and each snapshot is compared with the
one before by ``searchsorted``.  Full values are fetched only for keys that
differ.  Buckets are sized from the row count, so a task holds a bounded
number of 24-byte entries whatever the table size is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# About 4 million compact rows (96 MB of arrays) are one bucket's share.
ROWS_PER_BUCKET = 4_000_000

KINDS = ("added", "removed", "changed")


def _differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All differences within one bucket: (ordinal of the later snapshot, key, kind code); nothing past the last delivery."""
    cols: list[list[np.ndarray]] = [[], [], []]
    deliveries = 0
    for b in batches:
        for have, name in zip(cols, ("_ord", "_key", "_hash")):
            have.append(b.column(name).to_numpy(zero_copy_only=False))
        if b.num_rows:
            deliveries = b.column("_of")[0].as_py()
    if not cols[0]:
        return
    order, key, content = (np.concatenate(c) for c in cols)
    content = content.view(np.uint64)
    by = np.lexsort((key, order))
    order, key, content = order[by], key[by], content[by]
    # Several contents of one key in one snapshot fold, independent of order, into one.
    first = np.flatnonzero(np.r_[True, (order[1:] != order[:-1]) | (key[1:] != key[:-1])])
    order, key, content = order[first], key[first], np.add.reduceat(content, first)
    last = int(order[-1])
    starts = np.searchsorted(order, np.arange(last + 2))
    # After the bucket's last snapshot its entries are gone from the next delivery, if there was one.
    for o in range(min(last + 1, deliveries - 1)):
        a, b = slice(starts[o], starts[o + 1]), None
        if o + 1 <= last:
            b = slice(starts[o + 1], starts[o + 2])
        before, after = key[a], key[b] if b else key[:0]
        if not len(before) and not len(after):
            continue
        at = np.searchsorted(before, after)
        found = np.zeros(len(after), bool)
        inside = at < len(before)
        found[inside] = before[at[inside]] == after[inside]
        added = after[~found]
        kept = np.flatnonzero(found)
        changed = after[kept][content[b][kept] != content[a][at[kept]]] if b else after
        back = np.searchsorted(after, before)
        there = np.zeros(len(before), bool)
        inside = back < len(after)
        there[inside] = after[back[inside]] == before[inside]
        removed = before[~there]
        keys = np.concatenate([added, removed, changed])
        if len(keys):
            codes = np.repeat(np.arange(3, dtype=np.int32), [len(added), len(removed), len(changed)])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), o + 1, np.int32)), pa.array(keys), pa.array(codes)], ["_ord", "_key", "_code"])
    return


def delivered(snapshots: DataFrame, snapshot_col: str) -> DataFrame:
    """(snapshot_no, _ord, _of): the delivered snapshot numbers with gapless ordinals and their number, one row per delivery."""
    numbers = snapshots.select(F.col(snapshot_col).alias("snapshot_no")).where(F.col(snapshot_col).isNotNull()).distinct()
    # One row per delivery, so one task orders and counts them all.
    at = Window.orderBy("snapshot_no")
    whole = at.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return numbers.select("snapshot_no", (F.row_number().over(at) - 1).cast("int").alias("_ord"), F.count(F.lit(1)).over(whole).cast("int").alias("_of"))


def snapshot_changes(snapshots: DataFrame, snapshot_col: str, key_col: str, content: Column) -> DataFrame:
    """Added, removed and changed keys from each delivered snapshot to the next.

    ``key_col`` is an integer key; ``content`` an expression whose equality
    decides whether a record changed.  Result: (snapshot_no, key, change_kind),
    snapshot_no being the later of the two.  The first snapshot gives nothing;
    numbers that were never delivered are skipped.  Rows without snapshot
    number or key are no listing entries.  Repeated entries of one snapshot
    count once; entries of one key with different contents in one snapshot are
    compared as a set.  An empty table gives an empty result.
    """
    spark = snapshots.sparkSession
    numbers = delivered(snapshots, snapshot_col)
    rows = snapshots.select(F.col(snapshot_col).alias("snapshot_no"), F.col(key_col).cast("long").alias("_key"), F.xxhash64(content).alias("_hash"))
    rows = rows.where(F.col("snapshot_no").isNotNull() & F.col("_key").isNotNull()).distinct()
    compact = rows.join(numbers, "snapshot_no").select("_ord", "_key", "_hash", "_of")
    buckets = max(spark.sparkContext.defaultParallelism, -(-snapshots.count() // ROWS_PER_BUCKET))
    found = compact.repartition(buckets, F.xxhash64("_key")).mapInArrow(_differences, "_ord int, _key long, _code int")
    kind = F.element_at(F.array(*[F.lit(k) for k in KINDS]), F.col("_code") + 1)
    return found.join(numbers, "_ord").select("snapshot_no", F.col("_key").alias("key"), kind.alias("change_kind"))


def change_values(changes: DataFrame, snapshots: DataFrame, snapshot_col: str, key_col: str, value: Column) -> DataFrame:
    """Full values before and after, fetched only for the differing keys: ``value`` is computed after the join that finds them.

    Result: (snapshot_no, key, change_kind, value_before, value_after); the
    smallest value stands for repeated entries.
    """
    numbers = delivered(snapshots, snapshot_col).drop("_of")
    wanted = changes.join(numbers, "snapshot_no")
    sides = wanted.select("key", F.explode(F.array(F.struct("_ord", F.lit(1).alias("_side"), F.col("_ord").alias("_at")), F.struct("_ord", F.lit(0).alias("_side"), (F.col("_ord") - 1).alias("_at")))).alias("s"))
    sides = sides.select("key", "s._ord", "s._side", "s._at")
    full = snapshots.withColumns({"_n": F.col(snapshot_col), "_k": F.col(key_col).cast("long")}).join(numbers.select(F.col("snapshot_no").alias("_n"), F.col("_ord").alias("_o")), "_n")
    held = full.join(sides.select(F.col("key").alias("_sk"), F.col("_ord").alias("_later"), "_side", F.col("_at").alias("_sa")), (F.col("_k") == F.col("_sk")) & (F.col("_o") == F.col("_sa")))
    held = held.select(F.col("_k").alias("key"), F.col("_later").alias("_ord"), "_side", value.alias("_value"))
    got = held.groupBy("key", "_ord").agg(F.min(F.when(F.col("_side") == 0, F.col("_value"))).alias("value_before"), F.min(F.when(F.col("_side") == 1, F.col("_value"))).alias("value_after"))
    return wanted.join(got, ["key", "_ord"], "left").select("snapshot_no", "key", "change_kind", "value_before", "value_after")
