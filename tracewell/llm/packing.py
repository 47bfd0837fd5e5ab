"""Documents packed into containers of fixed capacity, neighbours together.

Each document's hashed word vector is projected to a few dimensions and its
direction there given a place on a Hilbert curve.  Documents are range-sorted by that key (ties,
such as copies, divided by id, so a hot key spreads over tasks) and each task
packs its stretch of the curve: items enter a window in curve order, the
window's largest go first, each into the open container it fills best.  A
document is divided only if it alone exceeds the capacity; then into full
pieces and a rest, and the rest is packed like any other item.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.llm.tokens import CHUNK_MEMORY, TokenCounter, slices, tokenizer_path
from tracewell.sources.shared import materialize

HASHED_DIMS = 1 << 16
CURVE_DIMS = 6
CURVE_BITS = 10
# Items that enter the packing together, and containers left open between windows: short stretches of
# the curve keep neighbours together, longer ones leave less room.
WINDOW = 512
OPEN_CONTAINERS = 64
# Items for which one task is responsible.
ITEMS_PER_TASK = 100_000
# More plans than this are refused, since every document is an item of each.
MAX_PLANS = 1000


def projection() -> np.ndarray:
    """The fixed random projection of hashed vectors to the curve's dimensions."""
    return np.random.default_rng(17).standard_normal((HASHED_DIMS, CURVE_DIMS)).astype(np.float32)


def hilbert_keys(cells: np.ndarray, bits: int = CURVE_BITS) -> np.ndarray:
    """Position on the Hilbert curve of integer cells (n x dims), by Gray-code transposition of the axes."""
    x = cells.astype(np.int64).T.copy()
    dims, q = len(x), 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(dims):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(high, p, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    t = np.zeros(x.shape[1], np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= t
    key = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


class _Chunks(dict):
    """Row by blank-divided chunk: the place of its hashed feature on the curve's axes; chunks with digits say nothing of a text's subject and share row 0."""

    def __init__(self, axes: np.ndarray) -> None:
        super().__init__()
        self.axes, self.rows = axes, [np.zeros(axes.shape[1], np.float32)]

    def __missing__(self, chunk: str) -> int:
        if any(map(str.isdigit, chunk)):
            return 0
        self.rows.append(self.axes[xxhash.xxh32_intdigest(chunk.lower().encode("utf-8", "replace")) % HASHED_DIMS])
        self[chunk] = len(self.rows) - 1
        return len(self.rows) - 1


def _placer(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, axes = TokenCounter(path), projection()
        chunks = _Chunks(axes)
        for b in slices(batches):
            texts = [t or "" for t in b.column(1).to_pylist()]
            tokens = [counter.count(t) for t in texts]
            if len(chunks) > CHUNK_MEMORY:
                chunks = _Chunks(axes)
            at, ends = [], [0]
            for t in texts:
                at.extend(map(chunks.__getitem__, t.split()))
                ends.append(len(at))
            ends = np.asarray(ends)
            v = np.zeros((len(texts), CURVE_DIMS), np.float32)
            if at:
                full = np.flatnonzero(ends[1:] > ends[:-1])
                v[full] = np.add.reduceat(np.asarray(chunks.rows, np.float32)[np.asarray(at)], ends[full])
            v /= np.maximum(np.sqrt((v * v).sum(1, keepdims=True)), 1e-9)
            cells = np.clip((v + 1) * (1 << (CURVE_BITS - 1)), 0, (1 << CURVE_BITS) - 1)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(tokens, pa.int64()), pa.array(hilbert_keys(cells))], ["doc_id", "n_tokens", "curve_key"])

    return run


def curve_places(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, curve_key) of whole texts; a text without words lies at the curve's middle cell."""
    rows = documents.select(F.col(id_col).cast("long"), F.col(text_col))
    return rows.mapInArrow(_placer(path or tokenizer_path()), "doc_id long, n_tokens long, curve_key long")


class _Packer:
    """Open containers of one capacity; best fit among them."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.room: list[tuple[int, int]] = []  # (room left, container), ascending
        self.items: dict[int, list] = {}
        self.next = 0

    def full(self, item) -> list:
        self.next += 1
        return [(self.next - 1, 0, *item)]

    def put(self, size: int, item) -> None:
        k = bisect_left(self.room, (size, -1))
        if k < len(self.room):
            left, c = self.room.pop(k)
        else:
            left, c = self.capacity, self.next
            self.next += 1
            self.items[c] = []
        self.items[c].append(item)
        insort(self.room, (left - size, c))

    def close(self, keep: int) -> list:
        """Rows of the containers that are closed: the fullest, all but ``keep``, and every full one."""
        n = max(len(self.room) - keep, bisect_left(self.room, (1, -1)) if keep else 0)
        out = []
        for _, c in self.room[:n]:
            out += [(c, slot, *item) for slot, item in enumerate(self.items.pop(c))]
        self.room = self.room[n:]
        return out


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    names = ["plan_id", "container_id", "slot", "doc_id", "piece_no", "token_from", "token_to"]
    plan, packer, window = None, None, []

    def rows(found: list) -> pa.RecordBatch:
        c = list(zip(*found)) if found else [[] for _ in range(6)]
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
        arrays = [pa.array(x, k) for x, k in zip(c, kinds)]
        # A container's number is unique over the tasks of a run.
        arrays[0] = pa.array([(part << 40) + x for x in c[0]], pa.int64())
        return pa.RecordBatch.from_arrays([pa.array([plan] * len(arrays[0]), pa.int32()), *arrays], names)

    def flush(keep: int) -> list:
        window.sort(key=lambda w: -w[0])
        for size, item in window:
            packer.put(size, item)
        window.clear()
        return packer.close(keep)

    for b in batches:
        done: list = []
        for p, capacity, doc, n in zip(*(b.column(c).to_pylist() for c in ("plan_id", "capacity_tokens", "doc_id", "n_tokens"))):
            if p != plan:
                if packer is not None:
                    yield rows(done + flush(0))
                    done = []
                plan, packer = p, _Packer(capacity)
            pieces = n // capacity if n > capacity else 0
            for k in range(pieces):
                done += packer.full((doc, k, k * capacity, (k + 1) * capacity))
                if len(done) >= 50_000:
                    yield rows(done)
                    done = []
            rest = n - pieces * capacity
            if rest or not pieces:
                window.append((rest, (doc, pieces, pieces * capacity, n)))
            if len(window) >= WINDOW:
                done += flush(OPEN_CONTAINERS)
        if done:
            yield rows(done)
    if packer is not None:
        yield rows(flush(0))


def pack_along_curve(places: DataFrame, plans: DataFrame) -> DataFrame:
    """Every document packed under every plan.

    ``places``: (doc_id, n_tokens, curve_key); ``plans``: (plan_id,
    capacity_tokens), at most ``MAX_PLANS`` of them; rows without an id or a
    capacity above 0 plan nothing, and of a repeated id the smallest capacity
    counts.  Result: (plan_id, container_id, slot, doc_id,
    piece_no, token_from, token_to): piece_no counts the pieces of a document
    from 0, token_to is exclusive.  Documents without tokens take a slot of no
    size.  Repeated ids are items of their own.  No document is dropped.
    """
    sound = plans.where((F.col("capacity_tokens") > 0) & F.col("plan_id").isNotNull())
    known = sound.groupBy(F.col("plan_id").cast("int").alias("plan_id")).agg(F.min("capacity_tokens").cast("long").alias("capacity_tokens")).orderBy("plan_id").limit(MAX_PLANS + 1).collect()
    if len(known) > MAX_PLANS:
        raise ValueError(f"more than {MAX_PLANS} plans")
    places = materialize(places.select("doc_id", "n_tokens", "curve_key"), "curve-places")
    each = F.array(*[F.struct(F.lit(r["plan_id"]).alias("plan_id"), F.lit(r["capacity_tokens"]).cast("long").alias("capacity_tokens")) for r in known])
    if not known:
        each = F.array().cast("array<struct<plan_id:int,capacity_tokens:bigint>>")
    items = places.select("*", F.inline(each))
    tasks = max(1, -(-places.count() * len(known) // ITEMS_PER_TASK))
    ordered = items.repartitionByRange(tasks, "plan_id", "curve_key", "doc_id").sortWithinPartitions("plan_id", "curve_key", "doc_id")
    return ordered.mapInArrow(_pack, "plan_id int, container_id long, slot int, doc_id long, piece_no int, token_from long, token_to long")


def fill_report(packed: DataFrame, plans: DataFrame) -> DataFrame:
    """(plan_id, capacity_tokens, n_containers, n_pieces, n_tokens, fill) per plan."""
    per = packed.groupBy("plan_id", "container_id").agg(F.sum(F.col("token_to") - F.col("token_from")).alias("_t"), F.count(F.lit(1)).alias("_p"))
    total = per.groupBy("plan_id").agg(F.count(F.lit(1)).alias("n_containers"), F.sum("_p").alias("n_pieces"), F.sum("_t").alias("n_tokens"))
    joined = total.join(plans.select("plan_id", "capacity_tokens"), "plan_id")
    return joined.select("plan_id", "capacity_tokens", "n_containers", "n_pieces", "n_tokens", F.round(F.col("n_tokens") / (F.col("n_containers") * F.col("capacity_tokens")), 4).alias("fill"))
