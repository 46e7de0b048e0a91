"""Near-duplicate vectors by spherical-cap filters.

A filter is a direction; a vector belongs to it if their inner product is at least
``cap``. Directions form a structured random product code: the space is turned at
random and cut into ``parts`` blocks, each block has a codebook of random unit
vectors, and a direction is one code word of every block. A vector's filters are
listed without looking at all directions: partial sums over the blocks are extended
only while the best remaining code words can still reach the cap.

Vectors that share a filter are compared in full, in double precision. A pair is
counted at its smallest common filter only, so each link is counted once. Filters
with many vectors are cut into slices, and slices meet two by two, so no task holds
more than two slices. A task returns counts and a forest of its links, never its
pairs.

The directions of one code are not independent: a vector may lie badly for all of
them. So there are several codes with a rotation of their own each, ``codes`` at least
and as many as a pair at the threshold needs to share a filter with the chance
``recall``: a code's chance is found by trial on random pairs. Cap and codebook
follow from the number of vectors: the caps are so narrow that a filter has about
``load`` of n random vectors, and the directions so many that two vectors at the
threshold share ``shared`` filters of a code on average; README has measured recall.

Copies of one vector, after scaling, are one class with a weight: unit vectors in one
cell of a grid of width ``GRID``, so that copies stay together whatever rounding their
scaling has left. A class is compared by one of its vectors. Members of a class link with
each other. For two classes the cosine of the compared ones decides, unless it is so near
to the threshold that the cells' width matters and a class has different vectors; then
all vectors of the two are compared.

Defined cases: a vector that is null, empty, zero or holds null or non-finite
components links with nothing; vectors of different lengths do not link; a null
vec_id has no links; rows with one vec_id and several vectors give a row each, all with
the links of all its vectors. Ids are whole numbers; others fail the query.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tidemark.llm.components import components
from tidemark.plans import durable

THRESHOLD = 0.9
CODES, SHARED, LOAD = 16, 1.0, 256
RECALL, TRIAL = 0.999, 2000  # of pairs at the threshold; random pairs that codes are tried on
LEAST_BOTH = 0.15
SLICE = 512  # vectors of one filter that one side of a task holds
SEED = 20240229
GRID = 2.0**-20


def cap_share(cap, dim: int):
    """Share of random directions at an inner product of ``cap`` or more."""
    cap = np.clip(cap, -1.0000001, 1.0000001)
    if dim == 1:
        return np.where(cap > 1, 0.0, np.where(cap > -1, 0.5, 1.0))
    angle = (np.arange(20_000) + 0.5) * (math.pi / 20_000)
    weight = np.sin(angle) ** (dim - 2)
    sums = np.concatenate([[0.0], np.cumsum(weight)]) / weight.sum()
    return np.interp(np.arccos(np.clip(cap, -1, 1)), np.linspace(0, math.pi, 20_001), sums)


def both_share(cap: float, dim: int, cosine: float) -> float:
    """Chance that a vector is in a cap which a vector at that cosine is in."""
    if dim == 1:
        return 1.0
    angle = (np.arange(2000) + 0.5) * (math.acos(cap) / 2000)
    weight = np.sin(angle) ** (dim - 2)
    across = math.sqrt(1 - cosine * cosine) * np.sin(angle)
    inside = cap_share((cap - cosine * np.cos(angle)) / across, dim - 1)
    return float((weight * inside).sum() / weight.sum())


def plan(
    n: int, dim: int, cosine: float = THRESHOLD, shared: float = SHARED, load: int = LOAD
) -> tuple[int, int, float]:
    """(parts, code words of a part, cap) for n vectors."""
    caps = np.linspace(0.0, 0.9999, 5000)
    shares = cap_share(caps, dim)
    share = min(0.05, max(load / max(n, 1), 1e-9))  # of vectors in a filter
    while True:
        # the narrowest cap with that share; wider if it would part near vectors
        cap = float(caps[max(np.searchsorted(-shares, -share, "right") - 1, 0)])
        both = both_share(cap, dim, cosine)
        if both >= LEAST_BOTH or cap == 0.0:
            break
        share *= 1.5
    filters = shared / max(both, 0.01) / float(cap_share(cap, dim))
    parts = 2 if filters <= 250_000 else 3 if filters <= 3e7 else 4
    parts = max(1, min(parts, dim // 2))
    return parts, max(4, math.ceil(filters ** (1 / parts))), cap


class Code:
    """The directions: a rotation and codebooks, the same wherever they are made."""

    def __init__(self, dim: int, parts: int, words: int, seed: int = SEED):
        rng = np.random.default_rng([seed, dim, parts, words])
        self.turn = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
        self.cuts = np.linspace(0, dim, parts + 1).astype(int)
        self.books = []
        for a, b in zip(self.cuts, self.cuts[1:]):
            book = rng.standard_normal((words, b - a))
            self.books.append(book / np.linalg.norm(book, axis=1, keepdims=True))
        self.words = words

    def filters(self, vectors: np.ndarray, cap: float) -> tuple[np.ndarray, np.ndarray]:
        """(row, filter) of all filters of unit vectors, rows ascending."""
        turned = vectors @ self.turn
        # blocks of a direction have length 1 / sqrt(parts)
        scores = [
            turned[:, a:b] @ book.T / math.sqrt(len(self.books))
            for a, b, book in zip(self.cuts, self.cuts[1:], self.books)
        ]
        best_after = np.zeros((len(scores) + 1, len(vectors)))
        for k in range(len(scores) - 1, -1, -1):
            best_after[k] = best_after[k + 1] + scores[k].max(axis=1)
        row = np.arange(len(vectors))
        filt, total = np.zeros(len(row), np.int64), np.zeros(len(row))
        for k, score in enumerate(scores):
            out = []
            # extend the kept beginnings by every word that can still reach the cap
            for at in range(0, len(row), 4096):
                r = row[at : at + 4096]
                grown = total[at : at + 4096, None] + score[r]
                i, word = np.nonzero(grown + best_after[k + 1][r][:, None] >= cap)
                out.append((r[i], filt[at + i] * self.words + word, grown[i, word]))
            if not out:
                break
            row, filt, total = (np.concatenate(x) for x in zip(*out))
        return row, filt




def pairs_at(cosine: float, dim: int, n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """n random pairs of unit vectors at that cosine."""
    rng = np.random.default_rng([seed, dim, n])
    a, e = rng.standard_normal((2, n, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    e -= (e * a).sum(axis=1, keepdims=True) * a
    e /= np.maximum(np.linalg.norm(e, axis=1, keepdims=True), 1e-300)
    return a, cosine * a + math.sqrt(1 - cosine * cosine) * e


def met(code: Code, cap: float, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs share a filter of the code."""
    one, two = (set(zip(*map(np.ndarray.tolist, code.filters(x, cap)))) for x in (a, b))
    out = np.zeros(len(a), bool)
    out[[r for r, _ in one & two]] = True
    return out


def codes_of(
    dim: int, parts: int, words: int, cap: float, cosine: float, least: int, recall: float
) -> list[Code]:
    """``least`` codes, or more if pairs at the threshold would be missed too often.

    Rotations are independent, so all codes miss a pair with the product of their
    chances.
    """
    out = [Code(dim, parts, words, SEED + k) for k in range(least)]
    if dim == 1 or recall <= 0:
        return out
    tried = out[:4]
    a, b = pairs_at(cosine, dim, TRIAL, SEED)
    cuts = np.array_split(np.arange(TRIAL), len(tried))
    found = sum(met(c, cap, a[i], b[i]).sum() for c, i in zip(tried, cuts)) / TRIAL
    missed = 1 - max(found, 1 / TRIAL)
    if missed > 0:
        more = math.ceil(math.log(1 - recall) / math.log(missed)) - least
        out += [Code(dim, parts, words, SEED + least + k) for k in range(more)]
    return out


def units(vectors: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, unit vectors) of the vectors that can link, by length of vector."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    offsets = vectors.offsets.to_numpy()
    flat = vectors.values.to_numpy(zero_copy_only=False).astype(np.float64)  # null: NaN
    size = np.diff(offsets)
    size[vectors.is_null().to_numpy(zero_copy_only=False)] = 0
    out = []
    for dim in np.unique(size[size > 0]):
        rows = np.flatnonzero(size == dim)
        x = flat[offsets[rows][:, None] + np.arange(dim)]
        peak = np.abs(x).max(axis=1)  # NaN if a component is
        good = np.isfinite(peak) & (peak > 0)
        x = x[good] / peak[good, None]
        out.append((rows[good], x / np.sqrt((x * x).sum(axis=1, keepdims=True))))
    return out


def padded(lists: pa.ChunkedArray) -> np.ndarray:
    """Lists of filters as rows of a matrix, padded by -1."""
    lists = lists.combine_chunks()
    offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
    size = np.diff(offsets)
    out = np.full((len(size), size.max()), -1, np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(offsets[0], offsets[-1]) - offsets[:-1][row]] = flat[offsets[0] : offsets[-1]]
    return out


def _filters_of(n: int, cosine: float, codes: int, shared: float, load: int, recall: float):
    made: dict[int, tuple[list[Code], float]] = {}

    def find(vectors: pa.Array) -> pa.Array:
        lists: list[np.ndarray | None] = [None] * len(vectors)
        for rows, x in units(vectors):
            dim = x.shape[1]
            if dim not in made:
                parts, words, cap = plan(n, dim, cosine, shared, load)
                made[dim] = codes_of(dim, parts, words, cap, cosine, codes, recall), cap
            own, cap = made[dim]
            span = own[0].words ** len(own[0].books)
            for start in range(0, len(rows), 1024):
                part = x[start : start + 1024]
                pairs = [code.filters(part, cap) for code in own]
                row = np.concatenate([r for r, _ in pairs])
                filt = np.concatenate([k * span + f for k, (_, f) in enumerate(pairs)])
                order = np.lexsort((filt, row))
                filt = filt[order]
                cuts = np.searchsorted(row[order], np.arange(len(part) + 1))
                for j, at in enumerate(rows[start : start + 1024]):
                    lists[at] = filt[cuts[j] : cuts[j + 1]]
        return pa.array(lists, pa.list_(pa.int64()))

    return find


def _first_shared(a: np.ndarray, b: np.ndarray, here: int) -> np.ndarray:
    """Whether no filter below ``here`` is in both rows, which are padded by -1."""
    low_a, low_b = np.where(a < here, a, -1), np.where((b < here) & (b >= 0), b, -2)
    out = np.ones(len(a), bool)
    for at in range(0, len(a), 4096):
        part = slice(at, at + 4096)
        same = low_a[part][:, :, None] == low_b[part][:, None, :]
        out[part] = ~same.any(axis=(1, 2))
    return out


def margin(dim: int, grid: float = GRID) -> float:
    """How far the cosines of two cells' vectors may lie from that of the compared ones."""
    return 2 * grid * math.sqrt(dim) + 1e-12


def _compare(cosine: float, grid: float):
    def links(table: pa.Table) -> pa.Table:
        here = table.column("filter")[0].as_py()
        left_part, right_part = (table.column(c)[0].as_py() for c in ("i", "j"))
        part = table.column("part").to_numpy()
        ids = table.column("class").to_numpy()
        weight = table.column("weight").to_numpy()
        mixed = table.column("mixed").to_numpy(zero_copy_only=False)
        vectors = table.column("embedding").combine_chunks()
        filters = padded(table.column("filters"))
        counts = np.zeros(len(ids), np.int64)
        up = np.arange(len(ids))
        edges, unsure = [], []

        def root(i):
            while up[i] != i:
                up[i] = up[up[i]]
                i = up[i]
            return i

        for rows, unit in units(table.column("embedding")):
            on_left, on_right = part[rows] == left_part, part[rows] == right_part
            left, right, x, y = rows[on_left], rows[on_right], unit[on_left], unit[on_right]
            if not len(left) or not len(right):
                continue
            scores = x @ y.T
            near = scores >= cosine
            if mixed[left].any() or mixed[right].any():
                wide = margin(x.shape[1], grid)
                open_ = np.abs(scores - cosine) <= wide
                open_ &= mixed[left][:, None] | mixed[right][None, :]
                near |= open_
            else:
                open_ = None
            a, b = np.nonzero(near)
            if left_part == right_part:
                a, b = a[a < b], b[a < b]
            once = _first_shared(filters[left[a]], filters[right[b]], here)
            a, b = a[once], b[once]
            if open_ is not None:
                asked = open_[a, b]
                unsure += zip(left[a[asked]].tolist(), right[b[asked]].tolist())
                a, b = a[~asked], b[~asked]
            a, b = left[a], right[b]
            np.add.at(counts, a, weight[b])
            np.add.at(counts, b, weight[a])
            for i, j in zip(a.tolist(), b.tolist()):
                p, q = root(i), root(j)
                if p != q:
                    up[q] = p
                    edges.append((int(ids[i]), int(ids[j])))
        some = np.flatnonzero(counts)
        told = len(some) + len(edges)
        sides = [
            pa.concat_arrays([pa.nulls(told, vectors.type), vectors.take(pa.array(x, pa.int64()))])
            for x in ([i for i, _ in unsure], [j for _, j in unsure])
        ]
        blank = [None] * len(unsure)
        return pa.table(
            {
                "a": pa.array([*ids[some].tolist(), *(a for a, _ in edges), *blank], pa.int64()),
                "b": pa.array([None] * len(some) + [b for _, b in edges] + blank, pa.int64()),
                "n": pa.array([*counts[some].tolist(), *[0] * len(edges), *blank], pa.int64()),
                "left": sides[0],
                "right": sides[1],
            }
        )

    return links


def cell(column: str, grid: float = GRID):
    """The grid cell of the unit vector, as whole numbers; null where there is none."""

    def find(vectors: pa.Array) -> pa.Array:
        cells: list[np.ndarray | None] = [None] * len(vectors)
        for rows, x in units(vectors):
            for at, own in zip(rows, np.rint(x / grid).astype(np.int32)):
                cells[at] = own
        return pa.array(cells, pa.list_(pa.int32()))

    return arrow_udf(find, "array<int>")(column)


def _cosines(cosine: float):
    def near(left: pa.Array, right: pa.Array) -> pa.Array:
        out = np.zeros(len(left), bool)
        one, two = dict(), dict()
        for own, column in ((one, left), (two, right)):
            for rows, unit in units(column):
                own.update(zip(rows.tolist(), unit))
        for k in one.keys() & two.keys():
            out[k] = one[k] @ two[k] >= cosine
        return pa.array(out)

    return near


def near_vectors(
    vectors: DataFrame,
    cosine: float = THRESHOLD,
    codes: int = CODES,
    shared: float = SHARED,
    load: int = LOAD,
    slice_rows: int = SLICE,
    recall: float = RECALL,
    grid: float = GRID,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per vector."""
    rows = durable(vectors.select("vec_id", "embedding"))
    usable = rows.where(
        "vec_id is not null and size(embedding) > 0"
        " and not exists(embedding, x -> x is null or isnan(x) or abs(x) = double('infinity'))"
        " and exists(embedding, x -> x != 0)"
    )
    # equal vectors first, so that a cell has a row for each different one
    members = durable(
        usable.groupBy("embedding")
        .agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("weight"))
        .withColumn("cell", cell("embedding", grid))
    )
    classes = durable(
        members.groupBy("cell").agg(
            F.min("id").alias("class"),
            F.sum("weight").alias("weight"),
            F.min("embedding").alias("embedding"),
            (F.min("embedding") != F.max("embedding")).alias("mixed"),
        )
    )
    n = classes.count()
    filters = arrow_udf(_filters_of(n, cosine, codes, shared, load, recall), "array<bigint>")
    # two classes may have one vec_id; they stay apart by their number of rows there
    listed = durable(classes.drop("cell").withColumn("filters", filters("embedding")))
    ids = listed.select("class", F.explode("filters").alias("filter"))
    sizes = (
        ids.groupBy("filter")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("filter", F.ceil(F.col("n") / F.lit(slice_rows)).alias("parts"))
    )
    placed = (
        listed.withColumn("filter", F.explode("filters"))
        .join(sizes, "filter")
        .withColumn("part", F.pmod(F.xxhash64("class", "embedding"), F.col("parts")))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumns({"i": F.least("part", "other"), "j": F.greatest("part", "other")})
        .select("filter", "i", "j", "part", "class", "weight", "mixed", "embedding", "filters")
    )
    kind = rows.schema["embedding"].dataType.simpleString()
    # by all three, or every slice of a filter would meet in the task of its join
    found = durable(
        placed.repartition("filter", "i", "j").groupBy("filter", "i", "j").applyInArrow(
            _compare(cosine, grid), f"a bigint, b bigint, n bigint, left {kind}, right {kind}"
        )
    )
    own_class = members.join(
        classes.select("cell", "class", F.col("embedding").alias("shown")), "cell"
    ).select("embedding", "id", F.col("weight").alias("own"), "class", "shown")
    # pairs of classes that their shown vectors cannot settle, vector by vector
    unsure = found.where("left is not null").select("left", "right").distinct()
    both = (
        unsure.join(_side(own_class, "a"), F.col("left") == F.col("a_shown"))
        .join(_side(own_class, "b"), F.col("right") == F.col("b_shown"))
        .where(arrow_udf(_cosines(cosine), "boolean")("a_vector", "b_vector"))
    )
    settled = durable(both.select("a_vector", "b_vector", "a_class", "b_class", "a_own", "b_own"))
    more = (
        settled.select(F.col("a_vector").alias("vector"), F.col("b_own").alias("n"))
        .unionByName(settled.select(F.col("b_vector").alias("vector"), F.col("a_own").alias("n")))
        .groupBy("vector")
        .agg(F.sum("n").alias("more"))
    )
    edges = found.where("b is not null").select("a", "b")
    edges = edges.unionByName(settled.select(F.col("a_class").alias("a"), F.col("b_class").alias("b")))
    counts = found.where("a is not null and b is null").groupBy("a").agg(F.sum("n").alias("n"))
    joined = components(edges)
    known = (
        classes.join(counts, F.col("class") == F.col("a"), "left")
        .join(joined, F.col("class") == F.col("id"), "left")
        .select(
            "cell",
            (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("component_id", "class").alias("component_id"),
        )
    )
    told = members.join(known, "cell").select(F.col("embedding").alias("vector"), "n_links", "component_id")
    told = told.join(more, "vector", "left")
    same = F.col("vec_id").isNotNull() & (F.col("embedding") == F.col("vector"))
    out = rows.join(told, same, "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id"))
    return out.select(
        "vec_id",
        (F.coalesce("n_links", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


def _side(members: DataFrame, name: str) -> DataFrame:
    return members.select(
        F.col("embedding").alias(f"{name}_vector"),
        F.col("own").alias(f"{name}_own"),
        F.col("class").alias(f"{name}_class"),
        F.col("shown").alias(f"{name}_shown"),
    )
