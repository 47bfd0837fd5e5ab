"""Messages delivered more than once: keep exactly one copy of each.

1. Each row shrinks to a 256-bit identity, an order key and its time bucket.
   These compact rows are written partitioned by time bucket: the bucketed
   storage.
2. Screening.  The 64-bit prefixes are combined per map batch (a message that
   is a third of all rows leaves a map batch as one row) and sent to shards by
   prefix.  A shard goes through its time buckets in order and keeps nothing of
   a finished bucket but its Bloom filter.  A bucket's identities are tested
   against the filters of the buckets before it and against those kept from
   earlier batches; within the bucket a prefix that occurs twice is a repeat at
   once.  An identity that no filter knows is definitely new and is never
   looked at again.
3. Verification.  Possible repeats, and the buckets whose filters answered, are
   matched exactly (all 256 bits) in only those buckets' storage.

Filters are rows of their own (batch, shard, bucket, bits), kept beside the
storage: :class:`IdentityStore` screens a later batch against them without
reading what was stored, and opens only the buckets that answer.  Shards are
sized from the row count, so a filter and a bucket's share stay within a task's
memory at every table size.  A false positive costs one exact lookup, never a
wrong result; Bloom filters have no false negatives.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewell.sources.shared import materialize

# Compact rows for which one screening task is responsible (12 bytes each, plus filters).
ROWS_PER_SHARD = 2_000_000
# Time buckets: 2**42 microseconds, about 51 days.
BUCKET_BITS = 42
BLOOM_BITS_PER_KEY = 16
BLOOM_HASHES = 4
# Filters of at most this many bytes are tested many at once.
SMALL_FILTER = 1024
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)
NO_TIME = -1
# The batch of what is screened now; kept batches are numbered from 0.
_THIS = -1


def _places(h: np.ndarray, k: int, n_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """Byte and bit of the k-th probe of hashes in a filter of ``n_bytes`` (a power of two)."""
    p = (h * _ODD[k]) >> np.uint64(64 - (n_bytes * 8 - 1).bit_length())
    return (p >> np.uint64(3)).astype(np.int64), np.left_shift(np.uint8(1), (p & np.uint64(7)).astype(np.uint8))


class Bloom:
    """A Bloom filter over 64-bit hashes with vectorised insert and test."""

    def __init__(self, n: int = 0, bits: bytes | None = None) -> None:
        if bits is not None:
            self.bits = np.frombuffer(bits, np.uint8)
        else:
            self.bits = np.zeros(1 << max(3, (max(1, n) * BLOOM_BITS_PER_KEY - 1).bit_length() - 3), np.uint8)

    def add(self, h: np.ndarray) -> None:
        for k in range(BLOOM_HASHES):
            byte, bit = _places(h, k, len(self.bits))
            np.bitwise_or.at(self.bits, byte, bit)

    def maybe(self, h: np.ndarray) -> np.ndarray:
        """Places of the hashes that may have been added."""
        left = np.arange(len(h))
        for k in range(BLOOM_HASHES):
            byte, bit = _places(h[left], k, len(self.bits))
            left = left[(self.bits[byte] & bit) != 0]
        return left


class _Filters:
    """Filters of (batch, bucket); small ones of one size lie in one matrix, so that very many buckets cost few calls."""

    def __init__(self) -> None:
        self.large: list[tuple[tuple[int, int], Bloom]] = []
        self.small: dict[int, tuple[list[tuple[int, int]], np.ndarray]] = {}

    def add(self, name: tuple[int, int], bloom: Bloom) -> None:
        size = len(bloom.bits)
        if size > SMALL_FILTER:
            self.large.append((name, bloom))
            return
        names, m = self.small.get(size, ([], np.zeros((16, size), np.uint8)))
        if len(names) == len(m):
            m = np.concatenate([m, np.zeros_like(m)])
        m[len(names)] = bloom.bits
        names.append(name)
        self.small[size] = (names, m)

    def answers(self, h: np.ndarray) -> Iterator[tuple[tuple[int, int], np.ndarray]]:
        """((batch, bucket), places of the hashes it may hold) of each filter that answers."""
        for name, bloom in self.large:
            at = bloom.maybe(h)
            if len(at):
                yield name, at
        for size, (names, m) in self.small.items():
            for i in range(0, len(h), 4096):
                part = h[i : i + 4096]
                for j in range(0, len(names), 256):
                    there = np.ones((min(256, len(names) - j), len(part)), bool)
                    for k in range(BLOOM_HASHES):
                        byte, bit = _places(part, k, size)
                        there &= (m[j : min(j + 256, len(names)), byte] & bit) != 0
                    for f in np.flatnonzero(there.any(1)):
                        yield names[j + f], np.flatnonzero(there[f]) + i


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Map-side: one row per (bucket, prefix) of a batch, with its count."""
    for b in batches:
        tb = b.column("_tb").to_numpy(zero_copy_only=False).astype(np.int64)
        h = b.column("_h").to_numpy(zero_copy_only=False)
        by = np.lexsort((h, tb))
        tb, h = tb[by], h[by]
        first = np.flatnonzero(np.r_[True, (tb[1:] != tb[:-1]) | (h[1:] != h[:-1])]) if len(h) else np.zeros(0, np.int64)
        n = np.diff(np.r_[first, len(h)])
        yield pa.RecordBatch.from_arrays([pa.array(tb[first].astype(np.int32)), pa.array(h[first]), pa.array(np.minimum(n, 2).astype(np.int32))], ["_tb", "_h", "_n"])


_SCREENED = "_batch int, _shard int, _tb int, _h long, _bits binary"
_SCREENED_ARROW = pa.schema([("_batch", pa.int32()), ("_shard", pa.int32()), ("_tb", pa.int32()), ("_h", pa.int64()), ("_bits", pa.binary())])


def _screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shard by shard, kept filters first and then buckets in order: (batch, bucket, prefix) to look up, and each bucket's new filter."""
    filters, filters_of, here, parts = _Filters(), None, None, []

    def rows(batch: int, shard: int, tb: int, h: np.ndarray) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(h), 100_000):
            s = h[i : i + 100_000].view(np.int64)
            full = lambda v: pa.array(np.full(len(s), v, np.int32))  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays([full(batch), full(shard), full(tb), pa.array(s), pa.nulls(len(s), pa.binary())], schema=_SCREENED_ARROW)

    def finish() -> Iterator[pa.RecordBatch]:
        """Screen the bucket that is complete and make its filter."""
        shard, tb = here
        h = np.concatenate([p[0] for p in parts]).view(np.uint64)
        n = np.concatenate([p[1] for p in parts])
        by = np.argsort(h, kind="stable")
        h, n = h[by], n[by]
        first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
        look = np.add.reduceat(n, first) > 1
        h = h[first]
        for (batch, bucket), at in filters.answers(h):
            look[at] = True
            yield from rows(batch, shard, bucket, h[at])
        yield from rows(_THIS, shard, tb, h[look])
        bloom = Bloom(len(h))
        bloom.add(h)
        filters.add((_THIS, tb), bloom)
        one = lambda v: pa.array([v], pa.int32())
        yield pa.RecordBatch.from_arrays([one(_THIS), one(shard), one(tb), pa.nulls(1, pa.int64()), pa.array([bloom.bits.tobytes()], pa.binary())], schema=_SCREENED_ARROW)

    for b in batches:
        shard, tb, h, n = (b.column(c).to_numpy(zero_copy_only=False) for c in ("_shard", "_tb", "_h", "_n"))
        kept = n == 0
        edges = np.r_[np.flatnonzero(np.r_[True, (shard[1:] != shard[:-1]) | (tb[1:] != tb[:-1]) | (kept[1:] != kept[:-1])]), len(h)] if len(h) else np.zeros(1, np.int64)
        for i, j in zip(edges[:-1], edges[1:]):
            now = None if kept[i] else (int(shard[i]), int(tb[i]))
            if here is not None and now != here:
                yield from finish()
                here, parts = None, []
            if filters_of != shard[i]:
                filters, filters_of = _Filters(), shard[i]
            if kept[i]:
                bits, batch = b.column("_bits"), b.column("_batch")
                for k in range(i, j):
                    filters.add((batch[k].as_py(), int(tb[k])), Bloom(bits=bits[k].as_py()))
            else:
                here = now
                parts.append((h[i:j].astype(np.int64), n[i:j]))
    if here is not None:
        yield from finish()


def compact_identities(rows: DataFrame, identity: Sequence[Column], row_id: str, order: Sequence[Column], time: Column) -> DataFrame:
    """(_row, _id, _o0.., _tb, _h): what is stored of a message.  Rows whose identity is null throughout name none."""
    parts = []
    for c in identity:
        s = c.cast("string")
        parts += [F.coalesce(F.concat(F.length(s).cast("string"), F.lit(":"), s), F.lit("-"))]
    ident = F.unhex(F.sha2(F.concat(*parts), 256))
    known = F.greatest(*[c.isNotNull().cast("int") for c in identity]) == 1 if len(identity) > 1 else identity[0].isNotNull()
    compact = rows.where(known).select(
        F.col(row_id).alias("_row"),
        ident.alias("_id"),
        *[c.alias(f"_o{i}") for i, c in enumerate(order)],
        F.coalesce(F.shiftright(F.unix_micros(time), BUCKET_BITS).cast("int"), F.lit(NO_TIME)).alias("_tb"),
    )
    return compact.withColumn("_h", F.xxhash64("_id"))


def _tasks(spark: SparkSession, n_rows: int) -> int:
    return max(spark.sparkContext.defaultParallelism, -(-n_rows // ROWS_PER_SHARD))


def screen(compact: DataFrame, shards: int, kept: DataFrame | None = None) -> DataFrame:
    """(_batch, _shard, _tb, _h, _bits): prefixes to look up and where (bits null), and the new filters (prefix null).

    ``kept``: filters of earlier batches (_batch, _shard, _tb, _bits) under the
    same number of shards.  What is to be looked up in the batch itself has
    batch -1, as the new filters have.
    """
    prefixes = compact.select("_tb", "_h").mapInArrow(_combine, "_tb int, _h long, _n int")
    # The shard is taken from other bits of the prefix than the filters use.
    rows = prefixes.select(F.lit(_THIS).alias("_batch"), F.pmod(F.xxhash64("_h"), F.lit(shards)).cast("int").alias("_shard"), "_tb", "_h", "_n", F.lit(None).cast("binary").alias("_bits"))
    if kept is not None:
        rows = rows.unionByName(kept.select("_batch", "_shard", "_tb", F.lit(0).cast("long").alias("_h"), F.lit(0).alias("_n"), "_bits"))
    # Filters come before the rows of their shard.
    placed = rows.repartition(shards, "_shard").sortWithinPartitions("_shard", F.col("_n") > 0, "_tb")
    return placed.mapInArrow(_screen, _SCREENED)


def _surplus(found: DataFrame, n_order: int, row_id: str) -> DataFrame:
    """Of verified candidates (_row, _id, _o*, optional _held): all copies but the first; of a held identity all that are not held."""
    place = [F.struct(F.col(f"_o{i}").isNull(), F.col(f"_o{i}")) for i in range(n_order)]
    found = found.select("_row", "_id", "_held", F.struct(~F.col("_held"), *place, F.col("_row")).alias("_at"))
    stays = found.groupBy("_id").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    return found.join(stays, "_id").where(~F.col("_held") & (F.col("_at") != F.col("_first"))).select(F.col("_row").alias(row_id))


def superfluous(rows: DataFrame, identity: Sequence[Column], row_id: str, order: Sequence[Column], time: Column) -> DataFrame:
    """Ids of the rows that are surplus copies of a message.

    ``identity`` together names the message (null equals null; a row whose
    identity is null throughout names no message and is never a copy);
    ``order`` decides which copy stays: the smallest, nulls last, the row id
    breaking ties.  ``row_id`` is unique.  ``time`` only chooses storage
    buckets; rows without a time share one.  Result: (row_id).  An empty table
    gives an empty result.
    """
    tasks = _tasks(rows.sparkSession, rows.count())
    # Written by no more tasks than screen it, so that a bucket has few files; without a shuffle.
    store = materialize(compact_identities(rows, identity, row_id, order, time).coalesce(tasks), "identities", ("_tb",))
    # Written, so that its size is known to the join: where it is small the storage is not shuffled.
    screened = materialize(screen(store, tasks), "screened")
    look = screened.where(F.col("_bits").isNull()).select("_tb", "_h")
    found = store.join(look, ["_tb", "_h"], "left_semi").withColumn("_held", F.lit(False))
    return _surplus(found, len(order), row_id)


def first_deliveries(rows: DataFrame, identity: Sequence[Column], row_id: str, order: Sequence[Column], time: Column) -> DataFrame:
    """``rows`` without the surplus copies, each message exactly once."""
    return rows.join(superfluous(rows, identity, row_id, order, time), row_id, "left_anti")


class IdentityStore:
    """Identities of delivered messages, kept in time buckets with their Bloom filters, for one batch after another.

    ``path`` is a folder every executor reaches.  Batches are numbered from 0
    by the caller; a batch written again replaces its own files, so a failed
    one can be repeated.  ``shards`` is fixed for the life of the store: about
    one per ``ROWS_PER_SHARD`` messages it will hold.
    """

    def __init__(self, spark: SparkSession, path: str, shards: int) -> None:
        self.spark, self.path, self.shards = spark, path.rstrip("/"), shards

    def _kept(self, before: int, fields: str) -> DataFrame:
        return self.spark.read.schema(fields + ", _batch int").parquet(f"{self.path}/filters").where(F.col("_batch") < before)

    def surplus(self, batch_no: int, rows: DataFrame, identity: Sequence[Column], row_id: str, order: Sequence[Column], time: Column) -> DataFrame:
        """Store a batch and give the ids of its rows that are surplus.

        A row is surplus if its message is held from an earlier batch, or is
        not the first of its message in this one (as in :func:`superfluous`).
        Screening reads the kept filters, never the storage; of the storage
        only the buckets whose filters answered are opened.
        """
        compact = compact_identities(rows, identity, row_id, order, time)
        here = f"{self.path}/identities/_batch={batch_no}"
        compact.coalesce(_tasks(self.spark, rows.count())).write.mode("overwrite").partitionBy("_tb").parquet(here)
        kind = T.StructType([f for f in compact.schema.fields if f.name != "_tb"] + [T.StructField("_tb", T.IntegerType())])
        stored = self.spark.read.schema(kind).parquet(here)
        kept = self._kept(batch_no, "_shard int, _tb int, _bits binary") if batch_no > 0 else None
        screened = materialize(screen(stored, self.shards, kept), "screened")
        screened.where(F.col("_bits").isNotNull()).select("_shard", "_tb", "_bits").write.mode("overwrite").parquet(f"{self.path}/filters/_batch={batch_no}")
        look = screened.where(F.col("_bits").isNull())
        found = stored.join(look.where(F.col("_batch") == _THIS).select("_tb", "_h"), ["_tb", "_h"], "left_semi").withColumn("_held", F.lit(False))
        # One row per batch and bucket that answered.
        open_now = look.where(F.col("_batch") != _THIS).select("_batch", "_tb").distinct().collect()
        if open_now:
            paths = [f"{self.path}/identities/_batch={r['_batch']}/_tb={r['_tb']}" for r in open_now]
            wide = T.StructType([*kind.fields, T.StructField("_batch", T.IntegerType())])
            held = self.spark.read.schema(wide).option("basePath", f"{self.path}/identities").parquet(*paths)
            held = held.join(look.select("_batch", "_tb", "_h"), ["_batch", "_tb", "_h"], "left_semi").withColumn("_held", F.lit(True))
            found = found.unionByName(held.drop("_batch"))
        return _surplus(found, len(order), row_id)
