"""Exact centroid clustering (Lloyd's rounds) with heap-ordered bounds.

Vectors become whole numbers, floor(scale * component), so distances, sums and
centroids are exact and do not depend on how rows are dealt out.

Vectors are packed, in the tasks that read them, into blocks of bounded size. In
every block each cluster keeps a heap of its members. A member's entry is the
gap between a lower bound of its distance to any other centroid and an upper bound
of its distance to its own, plus the cluster's drift at that time. In each round
the drift of a cluster grows by the way of its own centroid and the longest way of
another, which is the most that any gap of its members can have shrunk. So the gap
of a member is still open as long as its entry is above the drift. Only members at
the top of the heap whose entry is not are popped, compared with all centroids in
whole numbers, and pushed again; the others are not looked at. Bounds are rounded
to the safe side, so a tie or a doubt is always an expired gap.

Blocks are written once, in buckets. A round reads them beside the heaps of the
round before, which are dealt into the same buckets, so no vector moves after the
first write; it writes the new heaps, and the change of the sums of each cluster,
of which only totals reach the driver. Every round is a written table, so a lost
executor repeats one task of it.

Defined results: vectors that are NULL, of another length, or that hold a NULL or
non-finite component take no part; a component of 131,072 or more in size stops the
run, as exact distances would leave 64 bits; repeated rows are members each; rows
without an id are members, but start a cluster only after all others; of equal
distances the smaller cluster number wins; a cluster without members keeps its
centroid; with fewer vectors than clusters there are as many clusters as vectors;
an empty table gives an empty result; other columns are not used.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epitally.llm.common import BucketedTables
from epitally.staging import stage

#: Components below this in size have squared distances of up to 64 places within 64 bits.
LARGEST = 1 << 17
#: More than the relative error of the bounds' few roundings.
_SAFE = 1e-12
#: Whole numbers up to here are exact as doubles.
_EXACT = 1 << 53


@dataclass(frozen=True)
class ClusterSpec:
    k: int = 8
    rounds: int = 10
    scale: int = 1024
    dims: int = 64
    seed: int = 3
    #: Vectors of a block at most.
    block: int = 4096
    #: Vectors of a bucket, about.
    bucket: int = 1 << 19


def whole_vector(vector: Column, spec: ClusterSpec) -> Column:
    """floor(scale * x) of each component; NULL for vectors that take no part."""
    usable = vector.isNotNull() & (F.size(vector) == spec.dims) & F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    fits = F.forall(vector, lambda x: F.abs(x.cast("double")) < LARGEST * 1024 / spec.scale)
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * spec.scale).cast("int"))
    return F.when(usable, F.when(fits, whole).otherwise(F.raise_error(F.lit("a vector has a component too large for exact distances"))))


def squared_distances(matrix: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows to all centroids."""
    largest = max(int(np.abs(matrix).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    if 4 * matrix.shape[1] * (largest + 1) ** 2 < _EXACT:
        rows, centres = matrix.astype(np.float64), centroids.astype(np.float64)
        squares = (rows * rows).sum(axis=1)[:, None] + (centres * centres).sum(axis=1)[None, :]
        return (squares - 2 * (rows @ centres.T)).astype(np.int64)
    wide = matrix.astype(np.int64)
    return np.stack([((wide - c) ** 2).sum(axis=1) for c in centroids], axis=1)


class GapHeap:
    """Members of one cluster in one block, those whose gap expires first on top. Stored as it is ordered."""

    def __init__(self, entries: np.ndarray, members: np.ndarray):
        self.entries, self.members, self._heap = entries, members, None

    def expired(self, drift: float) -> list[int]:
        """Pops the members whose gap the drift may have closed."""
        if not len(self.entries) or self.entries[0] > drift:
            return []
        heap, out = self._open(), []
        while heap and heap[0][0] <= drift:
            out.append(heapq.heappop(heap)[1])
        return out

    def push(self, entries: list[float], members: list[int]) -> None:
        heap = self._open()
        if len(members) > len(heap):
            heap.extend(zip(entries, members, strict=True))
            heapq.heapify(heap)
        else:
            for item in zip(entries, members, strict=True):
                heapq.heappush(heap, item)

    def _open(self) -> list[tuple[float, int]]:
        if self._heap is None:
            self._heap = list(zip(self.entries.tolist(), self.members.tolist(), strict=True))
        return self._heap

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        if self._heap is None:
            return self.entries, self.members
        return np.array([h[0] for h in self._heap], np.float64), np.array([h[1] for h in self._heap], np.int32)


class BlockState:
    """Clusters of a block's members and the heaps of their gaps."""

    def __init__(self, cluster: np.ndarray, heaps: list[GapHeap]):
        self.cluster, self.heaps = cluster, heaps

    @classmethod
    def empty(cls, n: int, k: int) -> BlockState:
        return cls(np.full(n, -1, np.int32), [GapHeap(np.zeros(0), np.zeros(0, np.int32)) for _ in range(k)])

    @classmethod
    def read(cls, cluster: bytes, sizes: list[int], entries: bytes, members: bytes) -> BlockState:
        ends = np.cumsum(sizes)[:-1]
        parts = zip(np.split(np.frombuffer(entries, np.float64), ends), np.split(np.frombuffer(members, np.int32), ends), strict=True)
        return cls(np.frombuffer(cluster, np.int32).copy(), [GapHeap(e, m) for e, m in parts])

    def columns(self) -> dict:
        arrays = [h.arrays() for h in self.heaps]
        return {
            "cluster": self.cluster.tobytes(),
            "sizes": [len(e) for e, _ in arrays],
            "entries": np.concatenate([e for e, _ in arrays]).tobytes(),
            "members": np.concatenate([m for _, m in arrays]).astype(np.int32).tobytes(),
        }

    def reassign(self, matrix: np.ndarray, centroids: np.ndarray, drift: list[float]) -> tuple[np.ndarray, np.ndarray]:
        """Rescans the members that are new or whose gap expired. Returns those that changed, and their old clusters."""
        rows = np.flatnonzero(self.cluster < 0)
        popped = [m for heap, d in zip(self.heaps, drift, strict=True) for m in heap.expired(d)]
        rows = np.concatenate([rows, np.array(popped, np.int64)]).astype(np.int64)
        if not len(rows):
            return rows, rows
        squares = squared_distances(matrix[rows], centroids)
        best = squares.argmin(axis=1)
        own = np.sqrt(squares[np.arange(len(rows)), best].astype(np.float64))
        squares[np.arange(len(rows)), best] = np.iinfo(np.int64).max
        other = np.sqrt(squares.min(axis=1).astype(np.float64)) if len(centroids) > 1 else np.full(len(rows), np.inf)
        at = np.array(drift)[best]
        entry = other - own + at
        entry -= _SAFE * (own + np.where(np.isinf(other), 0, other) + at + 1)
        for c in np.unique(best):
            here = best == c
            self.heaps[c].push(entry[here].tolist(), rows[here].tolist())
        old = self.cluster[rows]
        self.cluster[rows] = best
        return rows[old != best], old[old != best]


_BLOCK = "block long, ids array<long>, matrix binary"
_STATE = "block long, cluster binary, sizes array<long>, entries binary, members binary, changes array<long>"
_RESULT = "vec_id long, cluster int, distance long"


def _packer(spec: ClusterSpec):
    """One row for each block of up to ``spec.block`` vectors of a task."""

    def row(ids: list[pa.Array], rows: list[np.ndarray]) -> pa.RecordBatch:
        held = pa.concat_arrays(ids)
        return pa.RecordBatch.from_arrays(
            [pa.ListArray.from_arrays(pa.array([0, len(held)], pa.int32()), held), pa.array([np.concatenate(rows).tobytes()], pa.binary())],
            names=["ids", "matrix"],
        )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows, held = [], [], 0
        for batch in batches:
            low = 0
            while low < batch.num_rows:
                part = batch.slice(low, spec.block - held)
                ids.append(part.column("vec_id"))
                rows.append(part.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.int32))
                low, held = low + part.num_rows, held + part.num_rows
                if held == spec.block:
                    yield row(ids, rows)
                    ids, rows, held = [], [], 0
        if held:
            yield row(ids, rows)

    return pack


def _open_block(row: dict, spec: ClusterSpec, k: int) -> tuple[np.ndarray, BlockState]:
    matrix = np.frombuffer(row["matrix"], np.int32).reshape(-1, spec.dims)
    if row.get("cluster") is None:
        return matrix, BlockState.empty(len(matrix), k)
    return matrix, BlockState.read(row["cluster"], row["sizes"], row["entries"], row["members"])


def _round(spec: ClusterSpec, centroids: np.ndarray, drift: list[float]):
    """New heaps of each block, and by how much each cluster's sums and counts change."""
    k = len(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = batch.slice(i, 1).to_pylist()[0]
                matrix, state = _open_block(block, spec, k)
                moved, old = state.reassign(matrix, centroids, drift)
                changes = None
                if len(moved):
                    change = np.zeros((k, spec.dims + 1), np.int64)
                    wide, new = matrix[moved].astype(np.int64), state.cluster[moved]
                    for c in range(k):
                        for rows, sign in ((new == c, 1), (old == c, -1)):
                            change[c, :-1] += sign * wide[rows].sum(axis=0)
                            change[c, -1] += sign * np.count_nonzero(rows)
                    changes = change.ravel().tolist()
                columns = {"block": block["block"]} | state.columns() | {"changes": changes}
                kinds = (pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(columns.values(), kinds, strict=True)], names=list(columns))

    return run


def _last_round(spec: ClusterSpec, centroids: np.ndarray, drift: list[float]):
    """Each vector with its cluster and distance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = batch.slice(i, 1).to_pylist()[0]
                matrix, state = _open_block(block, spec, len(centroids))
                state.reassign(matrix, centroids, drift)
                away = matrix.astype(np.int64) - centroids[state.cluster]
                columns = [pa.array(block["ids"], pa.int64()), pa.array(state.cluster, pa.int32()), pa.array((away * away).sum(axis=1), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "cluster", "distance"])

    return run


def _starts(vectors: DataFrame, spec: ClusterSpec) -> list[list[int]]:
    """The vectors with the smallest hashes of seed and id, at most k."""
    hashed = F.sha2(F.concat(F.lit(f"{spec.seed}:"), F.col("vec_id").cast("string")), 256)
    return [list(r.vector) for r in vectors.orderBy(hashed.asc_nulls_last(), "vector").limit(spec.k).select("vector").collect()]


def _totals(state: DataFrame) -> dict[int, int]:
    """The change of each sum and count over all blocks, by its place; k * (dims + 1) numbers at most."""
    each = state.filter("changes IS NOT NULL").select(F.posexplode("changes").alias("place", "change"))
    return {r.place: int(r.total) for r in each.groupBy("place").agg(F.sum(F.col("change").cast("decimal(38,0)")).alias("total")).collect()}


def _drift(old: list[list[int]], new: list[list[int]], drift: list[float]) -> list[float]:
    """Adds to each cluster's drift the way of its centroid and the longest way of another."""
    ways = [sum((a - b) ** 2 for a, b in zip(x, y, strict=True)) ** 0.5 for x, y in zip(old, new, strict=True)]
    longest = [max((w for j, w in enumerate(ways) if j != c), default=0.0) for c in range(len(ways))]
    return [d + (w + m) * (1 + _SAFE) + _SAFE * d for d, w, m in zip(drift, ways, longest, strict=True)]


def cluster(rows: DataFrame, spec: ClusterSpec = ClusterSpec()) -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia and the cluster's centroid, of each vector of ``rows``.

    ``rows`` has vec_id and embedding.
    """
    spark = rows.sparkSession
    vectors = rows.select(F.col("vec_id").cast("long"), whole_vector(F.col("embedding"), spec).alias("vector")).filter("vector IS NOT NULL")
    centroids = _starts(vectors, spec)
    k = len(centroids)
    if not k:
        return spark.createDataFrame([], f"{_RESULT}, cluster_inertia long, inertia long, centroid array<long>")
    count = rows.count()
    wanted = max(-(-count // spec.bucket), min(-(-count // spec.block), spark.sparkContext.defaultParallelism))
    packed = vectors.mapInArrow(_packer(spec), "ids array<long>, matrix binary").select(F.monotonically_increasing_id().alias("block"), "*")
    with BucketedTables(spark, "block", wanted) as tables:
        # Blocks get their numbers in a written table, so that a repeated task cannot change them.
        blocks = tables.write(stage(packed, "cluster-packed"), "blocks", deal=True)
        state, drift = None, [0.0] * k
        sums = [[0] * (spec.dims + 1) for _ in range(k)]

        def beside(columns: list[str]) -> DataFrame:
            held = blocks.select(*columns)
            return held if state is None else held.join(state.drop("changes").hint("shuffle_hash"), "block")

        for _ in range(spec.rounds):
            step = beside(["block", "matrix"]).mapInArrow(_round(spec, np.array(centroids, np.int64), drift), _STATE)
            state = tables.write(step, "heaps")
            for place, change in _totals(state).items():
                sums[place // (spec.dims + 1)][place % (spec.dims + 1)] += change
            moved = [[s // total[-1] for s in total[:-1]] if total[-1] else old for total, old in zip(sums, centroids, strict=True)]
            if moved == centroids:  # every further round would be this one again
                break
            centroids, drift = moved, _drift(centroids, moved, drift)
        last = beside(["block", "ids", "matrix"]).mapInArrow(_last_round(spec, np.array(centroids, np.int64), drift), _RESULT)
        found = stage(last, "clustered")
    sums = {r.cluster: int(r.total) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    of = F.col("cluster") + 1
    return found.select(
        "*",
        F.element_at(F.array(*(F.lit(sums.get(c, 0)).cast("long") for c in range(k))), of).alias("cluster_inertia"),
        F.lit(sum(sums.values())).cast("long").alias("inertia"),
        F.element_at(F.array(*(F.array(*(F.lit(x).cast("long") for x in c)) for c in centroids)), of).alias("centroid"),
    )


def centroid_sha256(centroid: Column) -> Column:
    """Lower-case hex digest of the components as decimal numbers joined by commas."""
    return F.sha2(F.array_join(centroid.cast("array<string>"), ","), 256)
