"""Clustering of vectors round centroids by an incrementally kept distance matrix.

Components become whole numbers, so every figure is exact. For each vector the table of
a round holds its dot products with all centroids. When centroids move, a dot product
changes by the vector's product with the move, and only components whose move is not
zero take part:

    v . new = v . old + sum of v[i] * (new[i] - old[i]) over i with new[i] != old[i]

Squared distances follow from it, |v|^2 - 2 v . c + |c|^2, and the nearest centroid is
found anew. The first table is the same update from centroids at zero. Centroids settle
component by component, so later rounds touch few of them; when none moves at all the
table stays as it is.

Each round reads and writes the table in place, without a shuffle of vectors, in the
folder of ``spark.checkpoint.dir``. A task adds up its vectors by cluster; what leaves it
is one row a cluster. The driver holds the centroids only: clusters times dimensions
numbers, whatever the number of vectors. A table is deleted once the next is written.

Defined cases: vectors that are null, of another length, or hold null, NaN or infinite
components have no row; fewer vectors than centroids give as many centroids as vectors;
rows that share a vec_id are vectors of their own, ordered by their components where
their order counts; a null vec_id hashes as an empty one; an empty table has an empty
result. Components too large for exact 64-bit distances (2 ** 27 and more after scaling,
in 64 dimensions) fail the query. Columns other than the id and the vector are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans import release, scratch_path

DIMENSIONS, CLUSTERS, ROUNDS, SCALE, SEED = 64, 40, 5, 256, 2

STATE = "vec_id {kind}, v array<bigint>, dots array<bigint>, cluster int, distance bigint"


def exact_below(dimensions: int) -> int:
    """Components of smaller magnitude have squared distances below 2 ** 63."""
    return 1 << (61 - (dimensions - 1).bit_length()) // 2


def whole_vectors(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): the usable vectors, floor(scale * x) for each component x."""
    x = F.col("embedding").cast("array<double>")
    sound = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    most = exact_below(dimensions)
    beyond = F.raise_error(F.lit(f"a component of {most} or more after scaling has no exact distance"))
    whole = F.transform(
        x,
        lambda c: F.when(F.abs(c) * scale < most, F.floor(c * scale)).otherwise(beyond.cast("long")),
    )
    usable = F.when((F.size("embedding") == dimensions) & sound, whole)
    return vectors.select("vec_id", usable.alias("v")).where("v is not null")


def first_centroids(whole: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The vectors whose seeded ids have the smallest hashes, in their order."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    chosen = whole.orderBy(F.sha2(named, 256), "v").limit(clusters).collect()
    return np.array([row["v"] for row in chosen], np.int64)


def _rows(column: pa.Array, width: int) -> np.ndarray:
    """A list column without nulls as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def _lists(matrix: np.ndarray) -> pa.Array:
    cuts = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(cuts), pa.array(matrix.ravel()))


def moved(dots: np.ndarray, v: np.ndarray, old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """The dot products after the centroids have moved."""
    dots = dots.copy()
    move = new - old
    for k in np.flatnonzero(move.any(axis=1)):
        at = np.flatnonzero(move[k])
        dots[:, k] += v[:, at] @ move[k, at]
    return dots


def nearest(dots: np.ndarray, v: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, squared distance) of each vector; the smaller number wins a tie."""
    far = (v * v).sum(axis=1)[:, None] - 2 * dots + (centroids * centroids).sum(axis=1)[None, :]
    best = far.argmin(axis=1)
    return best, far[np.arange(len(v)), best]


def _update(old: np.ndarray, new: np.ndarray):
    clusters, width = new.shape

    def update(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v = _rows(batch.column("v"), width)
            before = (
                _rows(batch.column("dots"), clusters)
                if "dots" in batch.schema.names
                else np.zeros((len(v), clusters), np.int64)
            )
            dots = moved(before, v, old, new)
            cluster, distance = nearest(dots, v, new)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    batch.column("v"),
                    _lists(dots),
                    pa.array(cluster.astype(np.int32)),
                    pa.array(distance),
                ],
                ["vec_id", "v", "dots", "cluster", "distance"],
            )

    return update


def _add_up(clusters: int, width: int):
    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sums = np.zeros(clusters, np.int64), np.zeros((clusters, width), np.int64)
        for batch in batches:
            cluster = batch.column("cluster").to_numpy()
            held += np.bincount(cluster, minlength=clusters)
            np.add.at(sums, cluster, _rows(batch.column("v"), width))
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(held[at]), _lists(sums[at])], ["cluster", "n", "sums"]
        )

    return add_up


def mean_vectors(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after their clusters' floored means; empty clusters keep theirs."""
    clusters, width = centroids.shape
    # one row a task and cluster, then one a cluster and component
    parts = state.select("cluster", "v").mapInArrow(
        _add_up(clusters, width), "cluster bigint, n bigint, sums array<bigint>"
    )
    totals = (
        parts.select("cluster", "n", F.posexplode("sums").alias("i", "x"))
        .groupBy("cluster", "i")
        .agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
    )
    out = centroids.copy()
    for row in totals.collect():  # clusters times dimensions
        out[row["cluster"], row["i"]] = row["x"] // row["n"]
    return out


def _written(df: DataFrame) -> tuple[DataFrame, str]:
    path = scratch_path(df.sparkSession, "matrix")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def cluster_vectors(
    vectors: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    seed: int = SEED,
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, v, dots, cluster, distance) of every usable vector, and the centroids."""
    state, path = _written(whole_vectors(vectors, dimensions, scale))
    kind = STATE.format(kind=state.schema["vec_id"].dataType.simpleString())
    centroids = first_centroids(state, clusters, seed)
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], kind), centroids
    old = np.zeros_like(centroids)
    for k in range(rounds + 1):
        if (centroids != old).any() or k == 0:
            last = path
            state, path = _written(state.mapInArrow(_update(old, centroids), kind))
            release(vectors.sparkSession, last)
        if k < rounds:
            old, centroids = centroids, mean_vectors(state, centroids)
    return state, centroids


def clustered(vectors: DataFrame, **settings) -> DataFrame:
    """Every usable vector with its cluster, the inertia and its centroid's fingerprint.

    vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256. The fingerprint
    is the SHA-256 of the centroid's components, written with commas between them.
    """
    state, centroids = cluster_vectors(vectors, **settings)
    marks = F.array(
        *(F.lit(hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for c in centroids.tolist())
    ).cast("array<string>")
    # one row a cluster, so the totals may be collected
    sums = {r["cluster"]: r["d"] for r in state.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    by_cluster = F.array(*(F.lit(sums.get(k, 0)) for k in range(len(centroids)))).cast("array<bigint>")
    return state.select(
        "vec_id",
        "cluster",
        "distance",
        F.get(by_cluster, "cluster").alias("cluster_inertia"),
        F.lit(sum(sums.values())).cast("long").alias("inertia"),
        F.get(marks, "cluster").alias("centroid_sha256"),
    )
