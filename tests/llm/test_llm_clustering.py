import hashlib
import math
import random

import numpy as np
import pytest

from epitally.llm.clustering import BlockState, ClusterSpec, GapHeap, _drift, cluster, squared_distances

SCHEMA = "vec_id long, embedding array<float>, CLUSTER string, block string"
SPEC = ClusterSpec(k=4, rounds=6, dims=6, block=32, bucket=64)


def whole(data, spec):
    out = []
    for i, v, *_ in data:
        if v is not None and len(v) == spec.dims and all(x is not None and math.isfinite(x) for x in v):
            out.append((i, [math.floor(float(np.float32(x)) * spec.scale) for x in v]))
    return out


def brute(data, spec):
    """(vec_id, cluster, distance) of each vector, and the centroids, by plain rounds."""
    vectors = whole(data, spec)
    key = lambda iv: (iv[0] is None, hashlib.sha256(f"{spec.seed}:{iv[0]}".encode()).hexdigest() if iv[0] is not None else "", iv[1])
    centroids = [v for _, v in sorted(vectors, key=key)[: spec.k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))[::-1]

    for _ in range(spec.rounds):
        members = [[] for _ in centroids]
        for _, v in vectors:
            members[nearest(v)[0]].append(v)
        centroids = [[sum(x) // len(m) for x in zip(*m)] if m else c for m, c in zip(members, centroids)]
    return sorted(((i, *nearest(v)) for i, v in vectors), key=repr), centroids


def check(spark, data, spec=SPEC):
    found = cluster(spark.createDataFrame(data, SCHEMA).repartition(3), spec).collect()
    expected, centroids = brute(data, spec)
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in found), key=repr) == expected
    for r in found:
        assert list(r.centroid) == centroids[r.cluster]
        assert r.cluster_inertia == sum(d for _, c, d in expected if c == r.cluster)
        assert r.inertia == sum(d for _, _, d in expected)
    return found


def row(i, v):
    return (i, v, "x", "y")


def test_equal_to_plain_rounds_with_odd_rows(spark):
    rng = random.Random(4)
    data = [row(i, [rng.gauss(i % 5, 0.7) for _ in range(6)]) for i in range(200)]
    data += [row(i, data[7][1]) for i in range(200, 300)]  # a third are copies of one vector
    data += [row(400, None), row(401, [1.0] * 5), row(402, [None] + [1.0] * 5), row(403, [float("nan")] * 6), row(404, [float("-inf")] * 6), row(405, [])]
    data += [data[3], data[3], row(None, data[9][1]), row(-5, [0.0] * 6)]
    assert len(check(spark, data)) == 304


def test_ties_go_to_the_smaller_cluster(spark):
    # Whole steps apart, so that many vectors are as far from one centroid as from another.
    check(spark, [row(i, [float(i % 3), float(i // 3 % 3), 0.0, 0.0, 0.0, 0.0]) for i in range(27)])


def test_few_rows_and_none(spark):
    assert check(spark, []) == []
    assert check(spark, [row(1, [0.5] * 6)])[0].distance == 0
    check(spark, [row(i, [float(i)] * 6) for i in range(3)])
    check(spark, [row(i, [0.25] * 6) for i in range(9)])  # all clusters but one stay empty


def test_too_large_components_stop_the_run(spark):
    data = [row(i, [float(i)] * 6) for i in range(5)] + [row(9, [131072.0] * 6)]
    with pytest.raises(Exception, match="too large for exact distances"):
        cluster(spark.createDataFrame(data, SCHEMA), SPEC).collect()


def test_distances_are_exact_on_both_paths():
    rng = np.random.default_rng(0)
    for largest in (1000, 2**27 - 1):
        matrix, centroids = (rng.integers(-largest, largest, (n, 64), endpoint=True) for n in (20, 3))
        found = squared_distances(matrix.astype(np.int32), centroids)
        assert found.tolist() == [[sum((int(a) - int(b)) ** 2 for a, b in zip(v, c)) for c in centroids] for v in matrix]


def test_heap_pops_the_expired_only():
    heap = GapHeap(np.array([0.5, 2.0, 1.0]), np.array([4, 5, 6], np.int32))
    assert heap.expired(0.4) == [] and heap._heap is None
    assert heap.expired(1.0) == [4, 6]
    heap.push([0.1, 3.0], [7, 8])
    assert heap.expired(2.0) == [7, 5] and heap.arrays()[1].tolist() == [8]


def test_far_vectors_are_not_scanned_again(monkeypatch):
    rng = np.random.default_rng(1)
    matrix = np.concatenate([rng.normal(c, 40, (500, 6)) for c in (0, 3000, 9000)]).astype(np.int32)
    centroids = [matrix[0].tolist(), matrix[500].tolist(), matrix[1000].tolist()]
    scanned = []
    monkeypatch.setattr("epitally.llm.clustering.squared_distances", lambda m, c: scanned.append(len(m)) or squared_distances(m, c))
    state, drift = BlockState.empty(len(matrix), 3), [0.0] * 3
    for _ in range(5):
        before = len(scanned)
        state.reassign(matrix, np.array(centroids), drift)
        assert (state.cluster == squared_distances(matrix, np.array(centroids)).argmin(axis=1)).all()
        state = BlockState.read(**{k: v for k, v in state.columns().items()})
        moved = [(matrix[state.cluster == c].astype(np.int64).sum(axis=0) // (state.cluster == c).sum()).tolist() for c in range(3)]
        centroids, drift = moved, _drift(centroids, moved, drift)
    assert scanned[0] == 1500 and sum(scanned[before:]) == 0
