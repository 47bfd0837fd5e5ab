"""A mixture of sources at target shares of its tokens.

Documents of a source fall by hash into blocks of about ``BLOCK_TOKENS``.  A
source's quota is spent on its blocks in a seeded order, whole passes first,
and exactly: the last block is cut at document level.  A splitting tree then
divides every source's blocks among output shards: at each node the blocks of
the left half are one multivariate-hypergeometric draw from those of the node,
so every shard gets its exact number of blocks and together they get exactly
the quotas.  A node's draw depends on its place and the seed only, so each
task routes its blocks from the root to their shards by itself and nothing is
collected but one row per target source.  Blocks are disjoint; documents are shuffled
inside their shard.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewell.sources.shared import materialize

BLOCK_TOKENS = 1 << 16
# Blocks grow beyond BLOCK_TOKENS where the mixture would have more of them than this: a draw takes below 10^9.
MOST_BLOCKS = 1 << 28
SHARD_TOKENS = 1 << 22
SEED = 20_240_117
# More target sources than this are refused, since one row of each is collected.
MAX_SOURCES = 10_000
# Blocks whose running totals one task forms.
RUN = 1024
_NODE_MEMORY = 50_000


def source_key(c: Column) -> Column:
    """A source name without case, blanks, hyphens and underscores; null when nothing is left."""
    return F.nullif(F.regexp_replace(F.lower(c), r"[\s_\-]+", ""), F.lit(""))


class SplittingTree:
    """Which shard a source's block belongs to, by its rank among the source's used blocks."""

    def __init__(self, blocks: list[int], shards: int, seed: int) -> None:
        self.blocks, self.shards, self.seed, self.total = np.asarray(blocks, np.int64), shards, seed, int(sum(blocks))
        self.nodes: dict[tuple[int, int], np.ndarray] = {}

    def _before(self, shard: int) -> int:
        """Blocks that the shards before ``shard`` hold."""
        return self.total * shard // self.shards

    def _left(self, lo: int, mid: int, hi: int, here: np.ndarray) -> np.ndarray:
        got = self.nodes.get((lo, hi))
        if got is None:
            if len(self.nodes) > _NODE_MEMORY:
                self.nodes.clear()
            rng = np.random.default_rng((self.seed, lo, hi))
            got = self.nodes[lo, hi] = rng.multivariate_hypergeometric(here, self._before(mid) - self._before(lo), method="marginals")
        return got

    def shards_of(self, source: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The shard of each block, all blocks routed together: a node parts the blocks that reach it."""
        out = np.zeros(len(source), np.int32)
        todo = [(0, self.shards, self.blocks, np.arange(len(source)), np.asarray(rank, np.int64))]
        while todo:
            lo, hi, here, at, r = todo.pop()
            if hi - lo == 1:
                out[at] = lo
                continue
            mid = (lo + hi) // 2
            left = self._left(lo, mid, hi, here)
            limit = left[source[at]]
            low = r < limit
            if low.any():
                todo.append((lo, mid, left, at[low], r[low]))
            if not low.all():
                todo.append((mid, hi, here - left, at[~low], (r - limit)[~low]))
        return out


@functools.lru_cache(4)
def _tree(blocks: tuple[int, ...], shards: int, seed: int) -> SplittingTree:
    """One tree per process, so that batches share its draws."""
    return SplittingTree(list(blocks), shards, seed)


def _multiplier(seed: int, source: int, epoch: int, n: int) -> tuple[int, int]:
    """A seeded permutation b -> (a b + c) mod n of n blocks."""
    rng = np.random.default_rng((seed, source, epoch))
    a, c = int(rng.integers(1, n + 1)), int(rng.integers(0, n))
    while math.gcd(a, n) != 1:
        a += 1
    return a % n if n > 1 else 1, c


def _sharder(blocks: list[int], shards: int, seed: int) -> Callable:
    @F.pandas_udf("int")
    def shard(source: pd.Series, rank: pd.Series) -> pd.Series:
        return pd.Series(_tree(tuple(blocks), shards, seed).shards_of(source.to_numpy(), rank.to_numpy()))

    return shard


def _wanted(targets: DataFrame) -> DataFrame:
    """(_k, source, target_share, max_repeats): one row per source.

    Exact copies of a target row count once; rows of one source in several
    spellings add up their shares, under the smallest cap and spelling.
    """
    sound = targets.where((F.col("target_share") > 0) & (F.col("max_repeats") > 0)).select(source_key(F.col("source")).alias("_k"), "source", F.col("target_share").cast("double"), F.col("max_repeats").cast("int"))
    return sound.where(F.col("_k").isNotNull()).distinct().groupBy("_k").agg(F.min("source").alias("source"), F.sum("target_share").alias("target_share"), F.min("max_repeats").alias("max_repeats"))


def mix_sources(sizes: DataFrame, targets: DataFrame, seed: int = SEED, total_tokens: int | None = None) -> DataFrame:
    """The mixture: (shard_no, position, doc_id, source, repeat_no, n_tokens).

    ``sizes``: (doc_id, source, n_tokens) with source names in any spelling;
    ``targets``: (source, target_share, max_repeats), see :func:`_wanted` for
    repeated ones.  Without ``total_tokens`` the total is the largest at which
    every source that has tokens can give its share with no document used more
    than ``max_repeats`` times: shares are exact up to one document a source,
    and what larger sources have beyond theirs stays unused.  With it a source
    gives its share of that total, or, where its cap allows less, all it may,
    and stays under its share.  repeat_no counts the uses of a document from 0.
    A target source without tokens gives nothing and its share is divided among
    the others; documents of other sources, or of none, are not part of the
    mixture.
    """
    wanted = _wanted(targets)
    docs = sizes.select("doc_id", source_key(F.col("source")).alias("_k"), F.col("n_tokens").cast("long")).join(wanted.select("_k", "source"), "_k").drop("_k")
    docs = materialize(docs, "mix-sizes")
    totals = {r["source"]: (r["t"], r["n"]) for r in docs.groupBy("source").agg(F.sum("n_tokens").alias("t"), F.count(F.lit(1)).alias("n")).limit(MAX_SOURCES + 1).collect()}
    plan = [(r["source"], r["target_share"], r["max_repeats"]) for r in wanted.orderBy("source").limit(MAX_SOURCES + 1).collect()]
    if len(plan) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} target sources")
    plan = [p for p in plan if totals.get(p[0], (0, 0))[0]]
    empty = "shard_no int, position long, doc_id long, source string, repeat_no int, n_tokens long"
    if not plan:
        return sizes.sparkSession.createDataFrame([], empty)
    share = sum(p[1] for p in plan)
    total = min(r * totals[s][0] * share / w for s, w, r in plan) if total_tokens is None else total_tokens
    block_tokens = max(BLOCK_TOKENS, -(-int(total) // MOST_BLOCKS))
    rows, planned = [], 0
    for i, (s, w, r) in enumerate(plan):
        size, docs_n = totals[s]
        quota = min(int(total * w / share + 0.5), r * size)
        planned += quota
        n = max(1, min(docs_n, -(-size // block_tokens)))
        for e in range(-(-quota // size)):
            rows.append((i, s, e, n, quota, *_multiplier(seed, i, e, n)))
    spark = sizes.sparkSession
    passes = spark.createDataFrame(rows, "_i int, source string, repeat_no int, _n long, _quota long, _a long, _c long")

    blocked = docs.join(passes.select("source", "_n").distinct(), "source").withColumn("_block", F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.col("_n")))
    blocks = blocked.groupBy("source", "_block").agg(F.sum("n_tokens").alias("_t")).join(passes, "source")
    blocks = blocks.withColumn("_rank", F.col("repeat_no") * F.col("_n") + F.pmod(F.col("_a") * F.col("_block") + F.col("_c"), F.col("_n")))
    blocks = _running_total(blocks.withColumn("_run", F.call_function("div", F.col("_rank"), F.lit(RUN))))
    used = blocks.where(F.col("_start") < F.col("_quota")).select("_i", "source", "_block", "repeat_no", "_rank", (F.col("_quota") - F.col("_start")).alias("_may"), "_t")
    used = materialize(used, "mix-blocks")
    counts = {r["_i"]: r["n"] for r in used.groupBy("_i").agg((F.max("_rank") + 1).alias("n")).collect()}
    shards = max(1, -(-planned // SHARD_TOKENS))
    shard = _sharder([counts.get(i, 0) for i in range(len(plan))], shards, seed)
    placed = used.withColumn("shard_no", shard("_i", "_rank"))

    drawn = blocked.join(placed, ["source", "_block"])
    order = F.xxhash64(F.lit(seed + 1), "repeat_no", "doc_id")
    whole = drawn.where(F.col("_t") <= F.col("_may"))
    # At most one block a source is cut.
    cut = drawn.where(F.col("_t") > F.col("_may")).withColumn("_sum", F.sum("n_tokens").over(Window.partitionBy("source", "_block", "repeat_no").orderBy(order, "doc_id").rowsBetween(Window.unboundedPreceding, 0)))
    cut = cut.where(F.col("_sum") <= F.col("_may")).drop("_sum")
    at = Window.partitionBy("shard_no").orderBy(F.xxhash64(F.lit(seed + 2), "shard_no", "repeat_no", "doc_id"), "doc_id", "repeat_no")
    mixed = whole.unionByName(cut).withColumn("position", F.row_number().over(at).cast("long") - 1)
    return mixed.select("shard_no", "position", "doc_id", "source", "repeat_no", "n_tokens")


def _running_total(blocks: DataFrame) -> DataFrame:
    """``_start``: tokens of the source's blocks of lower rank, by runs of ranks and then inside them."""
    runs = blocks.groupBy("source", "_run").agg(F.sum("_t").alias("_rt"))
    before = Window.partitionBy("source").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("source", "_run", F.coalesce(F.sum("_rt").over(before), F.lit(0)).alias("_rs"))
    inside = Window.partitionBy("source", "_run").orderBy("_rank").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.join(runs, ["source", "_run"]).withColumn("_start", F.col("_rs") + F.coalesce(F.sum("_t").over(inside), F.lit(0)))


def share_report(mixed: DataFrame, targets: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """What each target source gave, one row per source.

    (source, target_share, actual_share, n_tokens, n_rows, n_documents,
    most_uses); with ``sizes``, the documents the mixture was made from, also
    unused_tokens: tokens of the source's documents that are not in it at all.
    """
    per = mixed.groupBy("source", "doc_id").agg(F.count(F.lit(1)).alias("_u"), F.sum("n_tokens").alias("_t"), F.max("n_tokens").alias("_o"))
    got = per.groupBy("source").agg(F.sum("_t").alias("n_tokens"), F.sum("_u").alias("n_rows"), F.count(F.lit(1)).alias("n_documents"), F.max("_u").alias("most_uses"), F.sum("_o").alias("_once"))
    zero = F.lit(0).cast("long")
    rows = targets.select(source_key(F.col("source")).alias("_k"), "source", "target_share").distinct().groupBy("_k").agg(F.min("source").alias("source"), F.sum("target_share").alias("target_share"))
    # A row per target source: one task adds them up.
    whole = Window.partitionBy(F.lit(1))
    out = rows.join(got.select(source_key(F.col("source")).alias("_k"), *[c for c in got.columns if c != "source"]), "_k", "left").withColumn("_all", F.sum("n_tokens").over(whole))
    columns = ["source", "target_share", F.round(F.coalesce("n_tokens", zero) / F.col("_all"), 6).alias("actual_share"), *[F.coalesce(c, zero).alias(c) for c in ("n_tokens", "n_rows", "n_documents", "most_uses")]]
    if sizes is not None:
        have = sizes.groupBy(source_key(F.col("source")).alias("_k")).agg(F.sum("n_tokens").alias("_have"))
        out = out.join(have, "_k", "left")
        columns.append((F.coalesce("_have", zero) - F.coalesce("_once", zero)).alias("unused_tokens"))
    return out.select(*columns)
