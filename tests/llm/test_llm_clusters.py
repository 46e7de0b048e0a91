"""Centroid clustering by an incremental distance matrix against plain rounds."""

import hashlib
import math
import random

import numpy as np
import pytest

from tests.conftest import rows
from tidemark.llm import centroids

INF, NAN = math.inf, math.nan


def brute(data, clusters, rounds, dimensions=64, scale=256, seed=2):
    """Distances from scratch in every round, in Python integers."""
    kept = [
        (i, [math.floor(scale * x) for x in v])
        for i, v in data
        if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)
    ]
    name = lambda i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    cents = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:clusters]]
    assign = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(cents))
    for _ in range(rounds):
        near = [assign(v)[1] for _, v in kept]
        for k in range(len(cents)):
            own = [v for (_, v), n in zip(kept, near) if n == k]
            if own:
                cents[k] = [sum(col) // len(own) for col in zip(*own)]
    out = []
    near = [assign(v) for _, v in kept]
    for (i, _), (d, k) in zip(kept, near):
        mark = hashlib.sha256(",".join(map(str, cents[k])).encode()).hexdigest()
        out.append((i, k, d, sum(x for x, j in near if j == k), sum(x for x, _ in near), mark))
    return sorted(out, key=str)


def vectors(spark, data):
    schema = "vec_id bigint, embedding array<float>, label int, v string, dots string, cluster string, distance string"
    return spark.createDataFrame([(i, v, 1, "x", "x", "x", "x") for i, v in data], schema)


def near(rng, centre, spread=0.1, d=64):
    return [float(np.float32(c + rng.gauss(0, spread))) for c in centre[:d]]


def blobs(n, seed=1, d=64):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.3) for _ in range(d)] for _ in range(6)]
    return [(i, near(rng, rng.choice(centres), d=d)) for i in range(n)]


@pytest.mark.parametrize("partitions", [1, 5])
def test_rounds_equal_plain_ones(spark, partitions):
    data = blobs(300)
    got = rows(centroids.clustered(vectors(spark, data).repartition(partitions), clusters=12))
    assert sorted(got, key=str) == brute(data, 12, 5)


def test_ties_copies_and_odd_vectors(spark):
    rng = random.Random(4)
    zero, one = [0.0] * 64, [1.0] + [0.0] * 63
    data = [(i, zero) for i in range(20)] + [(20 + i, one) for i in range(5)] + blobs(40, 3)
    data += [
        (None, near(rng, zero)), (7, near(rng, zero)), (7, near(rng, one)), (900, None), (901, []),
        (902, zero[:63]), (903, zero + [0.0]), (904, [None] + zero[1:]), (905, [NAN] + zero[1:]),
        (906, [INF] + zero[1:]), (907, [-INF] + zero[1:]), (908, [-x for x in one]), (909, [-0.001] * 64),
    ]
    got = rows(centroids.clustered(vectors(spark, data), clusters=15))
    assert sorted(got, key=str) == brute(data, 15, 5)


@pytest.mark.parametrize("n", [0, 1, 3])
def test_fewer_vectors_than_centroids(spark, n):
    data = blobs(n)
    got = rows(centroids.clustered(vectors(spark, data)))
    assert sorted(got, key=str) == brute(data, 40, 5)


def test_large_whole_components_stay_exact(spark):
    rng = random.Random(6)
    most = centroids.exact_below(64) // 256 - 1
    data = [(i, [float(np.float32(rng.uniform(-most, most))) for _ in range(64)]) for i in range(30)]
    # their sums would pass 2 ** 63, so only the distances are looked at
    state, _ = centroids.cluster_vectors(vectors(spark, data), clusters=4)
    got = rows(state.select("vec_id", "cluster", "distance"))
    assert sorted(got, key=str) == [r[:3] for r in brute(data, 4, 5)]


def test_components_beyond_exact_distances_fail(spark):
    data = [(1, [float(2**20)] + [0.0] * 63)]
    with pytest.raises(Exception, match="no exact distance"):
        rows(centroids.clustered(vectors(spark, data)))


def test_only_moved_components_are_touched():
    rng = np.random.default_rng(1)
    v = rng.integers(-300, 300, (50, 64))
    old = rng.integers(-300, 300, (5, 64))
    new = old.copy()
    new[1, 3] += 7
    new[4] = rng.integers(-300, 300, 64)
    assert (centroids.moved(v @ old.T, v, old, new) == v @ new.T).all()
    assert (centroids.moved(np.zeros((50, 5), np.int64), v, np.zeros_like(old), old) == v @ old.T).all()
    same = centroids.moved(v @ old.T, v, old, old)
    assert (same == v @ old.T).all()


def test_tables_of_earlier_rounds_are_gone(spark):
    from tidemark.plans import release

    release(spark)
    state, _ = centroids.cluster_vectors(vectors(spark, blobs(30)), clusters=3)
    assert state.count() == 30 and release(spark) == 1
