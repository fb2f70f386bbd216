"""Exact k-means on integer vectors with heap-ordered bounds.

Each kept vector's component x becomes floor(1024 * x). The vectors are packed into blocks, written once, dealt out by block
and kept by the executors. A block has one heap per cluster. A vector's entry in the heap of its cluster is its gap (distance to
the second nearest centroid less distance to its own) plus the drift that the cluster had gathered when the entry was made.
After a round the drift of cluster c grows by the way its centroid moved and by the longest way of any other
centroid: no gap in that heap can have shrunk by more. So entries above the drift keep their cluster unseen; those at or
below it are popped, their vectors are compared with all centroids in whole numbers, and new entries are pushed.

A round joins the blocks with their heaps (11 bytes a vector; the vectors do not move), writes the new heaps, and adds up
only what popped vectors took from one cluster to another: one row per task, then one row per component. The driver
holds the centroids and their sums, k times 64 numbers.

Kept are vectors with exactly ``dims`` components, none null, NaN or infinite. A component beyond 100,000 either way
would let squared distances leave a long; such vectors are not kept. Ties of distance go to the smaller
cluster number. A null id counts as the empty text in the hash and stays null; repeated rows are rows of their own (equal
hashes: the vector that is smaller component by component first). With fewer than ``k`` kept vectors there are as many
clusters; an empty table, or one without kept vectors, gives no rows. Other input columns are ignored.
"""

from __future__ import annotations

import hashlib
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

BLOCK = 2048
GROUPS = 32
SCALE = 1024
LARGEST = 100_000.0
#: More than rounding can add to sums of square roots below 2e9.
SLACK = 1e-5
BLOCKS = "block long, vec_ids array<long>, vectors binary"
STATE = "block long, heaps binary, moved array<long>"
RESULT = "vec_id long, cluster int, distance long"


def whole_numbers(column: pa.ListArray, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the vectors to keep, and their components as whole numbers."""
    column = column.cast(pa.large_list(pa.float64()))
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)  # null becomes NaN
    rows = np.flatnonzero((np.diff(offsets) == dims) & ~column.is_null().to_numpy(zero_copy_only=False))
    x = values[offsets[rows][:, None] + np.arange(dims)]
    good = (np.abs(x) <= LARGEST).all(axis=1)
    return rows[good], np.floor(x[good] * SCALE).astype(np.int32)


def blocks_of(vectors: DataFrame, vec_id: str, embedding: str, dims: int) -> DataFrame:
    """Blocks of at most ``BLOCK`` vectors, named by task and number; to be stored before use."""

    def pack(batches):
        task, number, ids, rows = TaskContext.get().partitionId() << 32, 0, [], np.zeros((0, dims), np.int32)
        for batch in batches:
            kept, x = whole_numbers(batch.column(1), dims)
            ids += batch.column(0).take(pa.array(kept)).to_pylist()
            rows = np.concatenate([rows, x])
            while len(ids) >= BLOCK:
                yield one(task + number, ids[:BLOCK], rows[:BLOCK])
                number, ids, rows = number + 1, ids[BLOCK:], rows[BLOCK:]
        if ids:
            yield one(task + number, ids, rows)

    def one(block, ids, rows):
        return pa.RecordBatch.from_arrays([pa.array([block]), pa.array([ids], pa.list_(pa.int64())), pa.array([rows.tobytes()])], names=["block", "vec_ids", "vectors"])

    return vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("x")).mapInArrow(pack, BLOCKS)


def first_centroids(blocks: DataFrame, k: int, dims: int, salt: str) -> list[list[int]]:
    """The vectors with the ``k`` smallest hashes; each block sends ``k`` rows at most."""

    def smallest(batches):
        for batch in batches:
            for ids, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = np.frombuffer(data, np.int32).reshape(-1, dims)
                hashed = sorted((hashlib.sha256(f"{salt}:{'' if v is None else v}".encode()).hexdigest(), rows[i].tolist()) for i, v in enumerate(ids))[:k]
                yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in hashed]), pa.array([x for _, x in hashed], pa.list_(pa.int64()))], names=["hash", "x"])

    rows = blocks.select("vec_ids", "vectors").mapInArrow(smallest, "hash string, x array<long>")
    return [list(r["x"]) for r in rows.orderBy("hash", "x").limit(k).collect()]


def squared(x: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    gap = x - centroid
    return np.einsum("ij,ij->i", gap, gap)


class Heaps:
    """One heap of (gap plus drift at entry, row) per cluster, for the rows of one block."""

    def __init__(self, heaps: list[list[tuple[float, int]]]):
        self.heaps = heaps

    @classmethod
    def of(cls, data: bytes, k: int) -> Heaps:
        sizes = np.frombuffer(data, np.int32, k)
        n = int(sizes.sum())
        keys = np.frombuffer(data, np.float64, n, 4 * k).tolist()
        rows = np.frombuffer(data, np.uint16, n, 4 * k + 8 * n).tolist()
        ends = np.cumsum(sizes)
        return cls([list(zip(keys[e - s : e], rows[e - s : e])) for s, e in zip(sizes, ends)])

    def data(self) -> bytes:
        entries = [e for h in self.heaps for e in h]
        keys, rows = np.array([e[0] for e in entries], np.float64), np.array([e[1] for e in entries], np.uint16)
        return np.array([len(h) for h in self.heaps], np.int32).tobytes() + keys.tobytes() + rows.tobytes()

    def expired(self, drift: np.ndarray) -> tuple[list[int], list[int]]:
        """Take out the rows whose gap may be gone, and the clusters they were in."""
        rows, left = [], []
        for c, heap in enumerate(self.heaps):
            limit = drift[c] + SLACK
            while heap and heap[0][0] <= limit:
                rows.append(heappop(heap)[1])
                left.append(c)
        return rows, left

    def rescan(self, rows: list[int], x: np.ndarray, centroids: np.ndarray, drift: np.ndarray) -> np.ndarray:
        """Put rows into the heaps of their nearest centroids, by exact squared distances."""
        exact = np.stack([squared(x[rows], c) for c in centroids], axis=1)
        near = exact.argmin(axis=1)  # the first of equal ones
        own = exact[np.arange(len(rows)), near]
        exact[np.arange(len(rows)), near] = np.iinfo(np.int64).max
        other = exact.min(axis=1)
        gap = np.sqrt(other.astype(np.float64)) - np.sqrt(own.astype(np.float64)) if len(centroids) > 1 else np.full(len(rows), np.inf)
        for key, row, c in zip((gap + drift[near]).tolist(), rows, near.tolist()):
            heappush(self.heaps[c], (key, row))
        return near

    def clusters(self, n: int) -> np.ndarray:
        out = np.zeros(n, np.int64)
        for c, heap in enumerate(self.heaps):
            out[[row for _, row in heap]] = c
        return out


def fresh_heaps(x: np.ndarray, centroids: np.ndarray, drift: np.ndarray) -> tuple[Heaps, np.ndarray]:
    state = Heaps([[] for _ in centroids])
    return state, state.rescan(list(range(len(x))), x, centroids, drift)


def advance(data: bytes | None, x: np.ndarray, centroids: np.ndarray, drift: np.ndarray) -> tuple[Heaps, np.ndarray]:
    """The heaps of a block after one assignment, and per cluster (count, sums) that came less what went."""
    k, dims = centroids.shape
    moved = np.zeros((k, dims + 1), np.int64)
    if data is None:
        state, near = fresh_heaps(x, centroids, drift)
        rows, left = np.arange(len(x)), None
    else:
        state = Heaps.of(data, k)
        rows, left = state.expired(drift)
        if not rows:
            return state, moved
        near = state.rescan(rows, x, centroids, drift)
        rows, left = np.array(rows), np.array(left)
    for c in range(k):
        came = rows[near == c] if left is None else rows[(near == c) & (left != c)]
        went = rows[:0] if left is None else rows[(left == c) & (near != c)]
        moved[c, 0] = len(came) - len(went)
        moved[c, 1:] = x[came].sum(axis=0) - x[went].sum(axis=0)
    return state, moved


def assign(blocks: DataFrame, state: DataFrame | None, parts: int, centroids: np.ndarray, drift: np.ndarray) -> DataFrame:
    """Heaps per block, and a row per task, with a negative number, that holds what moved."""
    k, dims = centroids.shape

    def run(batches):
        total = np.zeros((k, dims + 1), np.int64)
        for batch in batches:
            for i in range(len(batch)):
                x = np.frombuffer(batch.column(1)[i].as_py(), np.int32).reshape(-1, dims).astype(np.int64)
                heaps, moved = advance(batch.column(2)[i].as_py(), x, centroids, drift)
                total += moved
                yield row(batch.column(0)[i].as_py(), heaps.data(), None)
        if total.any():
            yield row(-1 - TaskContext.get().partitionId(), None, total.ravel().tolist())

    def row(block, heaps, moved):
        arrays = [pa.array([block], pa.int64()), pa.array([heaps], pa.binary()), pa.array([moved], pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(arrays, names=["block", "heaps", "moved"])

    return stored(with_heaps(blocks, state, parts).select("block", "vectors", "heaps").mapInArrow(run, STATE), "heaps")


def with_heaps(blocks: DataFrame, state: DataFrame | None, parts: int) -> DataFrame:
    """Blocks beside their heaps; only the heaps are shuffled."""
    if state is None:
        return blocks.withColumn("heaps", F.lit(None).cast("binary"))
    own = state.filter(F.col("block") >= 0).select("block", "heaps").repartition(parts, "block")
    return blocks.join(own.hint("shuffle_hash"), "block")


def total_moved(state: DataFrame, shape: tuple[int, int]) -> np.ndarray:
    """Sum of what moved in all tasks; the driver adds up ``GROUPS`` arrays at most."""

    def add(rows: pa.Table) -> pa.Table:
        moved = rows["moved"].combine_chunks().flatten().to_numpy().reshape(-1, shape[0] * shape[1])
        return pa.table({"moved": pa.array([moved.sum(axis=0)], pa.list_(pa.int64()))})

    parts = state.filter(F.col("block") < 0).select((F.col("block") % GROUPS).alias("part"), "moved")
    sums = parts.groupBy("part").applyInArrow(add, "moved array<long>").collect()
    return sum((np.array(r["moved"], np.int64).reshape(shape) for r in sums), np.zeros(shape, np.int64))


def moved_on(centroids: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Floor of the mean of every cluster that has vectors."""
    return np.where(sums[:, :1] > 0, sums[:, 1:] // np.maximum(sums[:, :1], 1), centroids)


def drifted(drift: np.ndarray, old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """By how much gaps in each heap may have shrunk since the first round."""
    way = np.sqrt(np.array([squared(n[None], o)[0] for n, o in zip(new, old)], np.float64))
    others = np.array([np.delete(way, c).max(initial=0.0) for c in range(len(way))])
    return drift + way + others


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, vec_id: str = "vec_id", embedding: str = "embedding", dims: int = 64, salt: str = "3") -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256 of each kept vector."""
    blocks = stored(blocks_of(vectors, vec_id, embedding, dims), "blocks")
    centroids = np.array(first_centroids(blocks, k, dims, salt), np.int64).reshape(-1, dims)
    if not len(centroids):
        return blocks.sparkSession.createDataFrame([], f"{RESULT}, cluster_inertia long, inertia long, centroid_sha256 string")
    parts = max(blocks.sparkSession.sparkContext.defaultParallelism, blocks.count() // 64)
    dealt = blocks.repartition(parts, "block").persist(StorageLevel.MEMORY_AND_DISK)
    drift, sums, state = np.zeros(len(centroids)), np.zeros((len(centroids), dims + 1), np.int64), None
    for _ in range(rounds):
        state = assign(dealt, state, parts, centroids, drift)
        sums = sums + total_moved(state, sums.shape)
        now = moved_on(centroids, sums)
        centroids, drift = now, drifted(drift, centroids, now)

    def last(batches):
        for batch in batches:
            for i in range(len(batch)):
                x = np.frombuffer(batch.column(2)[i].as_py(), np.int32).reshape(-1, dims).astype(np.int64)
                heaps, _ = advance(batch.column(3)[i].as_py(), x, centroids, drift)
                own = heaps.clusters(len(x))
                yield pa.RecordBatch.from_arrays([batch.column(1)[i].values, pa.array(own, pa.int32()), pa.array(squared(x, centroids[own]))], names=["vec_id", "cluster", "distance"])

    result = stored(with_heaps(dealt, state, parts).select("block", "vec_ids", "vectors", "heaps").mapInArrow(last, RESULT), "clusters")
    dealt.unpersist()
    inertia = dict.fromkeys(range(len(centroids)), 0) | {r["cluster"]: r["s"] for r in result.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    hashes = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]

    def of_cluster(values, kind):
        return F.array(*[F.lit(v).cast(kind) for v in values])[F.col("cluster")]

    return result.select(
        *result.columns, of_cluster([inertia[c] for c in range(len(centroids))], "long").alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"), of_cluster(hashes, "string").alias("centroid_sha256"))
