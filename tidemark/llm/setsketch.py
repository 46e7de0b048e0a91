"""Near-duplicate documents by SetSketch registers.

A document is the set of its shingles of ``width`` words, 3 if not given. Its sketch
has ``registers`` values:
each shingle draws a Poisson process of points, every point falls on one register,
and a register keeps the smallest point it has seen, on a logarithmic scale cut off
at both ends. Sketches of unions are the register-wise maxima, and two sets agree in
a register about as often as their elements coincide.

1. Copies of one set are one class, found by a fingerprint of the whole set.
2. The registers are cut into bands; classes that agree in all registers of a band
   meet in a bucket, and every member of a bucket is listed under its smallest one,
   its hub.
3. The members of a hub are dealt into groups of bounded size. In a group the
   likelihood of the registers of two sketches, given both set sizes, yields the
   similarity that they suggest; pairs that may reach the threshold are confirmed
   on the full sets, unless they are connected already.
4. A hub with several groups may miss links between them. Its members outside its
   largest component so far are held against all its groups in further groups.
5. Components of the confirmed links, smallest document first.

No pair of one bucket goes unexamined, whatever its size: it is confirmed, refuted
by its registers, or both documents are in one component already.

Defined cases: a null or empty text has no shingles and no links; a text of fewer words
than a shingle is one shingle; a null doc_id has no links; rows that share a doc_id give
a row each and are one document in links, which has the links of all its texts. Ids are
whole numbers; others fail the query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tidemark.llm.components import components
from tidemark.llm.scan import Block, blocks, mix, windows
from tidemark.plans import durable

WIDTH = 3
THRESHOLD_PCT = 85
REGISTERS = 192
MISSED = 3e-7  # chance that a pair at the threshold meets in no band
SCALE = 1.02  # of the registers' logarithm
LOWEST, HIGHEST = -600, 1400  # register values are cut off here
GROUP_ROWS, GROUP_SHINGLES = 400, 1_000_000  # of one group's documents
SIGMAS = 6  # how far below the threshold the likelihood may point

GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(block: Block, width: int = WIDTH) -> list[np.ndarray]:
    """The sorted 64-bit hashes of each text's distinct shingles."""
    words = block.words(lower=True)
    keys, at = windows(words, block.doc, width)
    n = len(block.offsets) - 1
    cuts = np.searchsorted(at, block.first)  # windows start at words
    counts = block.n_words
    out = []
    for i in range(n):
        if counts[i] >= width:
            out.append(np.unique(keys[cuts[i] : cuts[i + 1]]))
        elif counts[i]:
            mine = words[block.first[i] : block.first[i + 1]]
            key = np.full(1, counts[i], np.uint64)
            for k in range(len(mine)):
                key = mix(key * GOLDEN + mine[k : k + 1])
            out.append(key)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def registers_of(sets: list[np.ndarray], registers: int = REGISTERS) -> np.ndarray:
    """Register values of each set, one row a set; those of an empty set are LOWEST.

    Points of all sets are drawn round by round. A set's elements stop once their
    next point lies beyond a limit below which all its registers have a point.
    """
    sizes = np.array([len(s) for s in sets])
    least = np.full(len(sets) * registers, np.inf)
    if sizes.sum():
        owner = np.repeat(np.arange(len(sets)), sizes)
        state = np.concatenate(sets)
        time = np.zeros(len(state))
        # so many points a register on average that few sets need a second limit
        limit = np.where(sizes > 0, (np.log(registers) + 3) / np.maximum(sizes, 1), 0.0)
        waiting = []  # elements whose next point is beyond the limit
        while True:
            while len(state):
                state = mix(state + GOLDEN)
                chance = ((state >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
                time = time - np.log(chance) / registers
                slot = (mix(state ^ GOLDEN) % np.uint64(registers)).astype(np.int64)
                on = time <= limit[owner]
                np.minimum.at(least, owner[on] * registers + slot[on], time[on])
                off = ~on
                waiting.append((owner[off], state[off], time[off], slot[off]))
                owner, state, time = owner[on], state[on], time[on]
            open_ = np.isinf(least).reshape(len(sets), -1).any(axis=1) & (sizes > 0)
            if not open_.any():
                break
            owner, state, time, slot = (np.concatenate(x) for x in zip(*waiting))
            more = open_[owner]
            owner, state, time, slot = owner[more], state[more], time[more], slot[more]
            limit = np.where(open_, limit * 2, 0.0)
            on = time <= limit[owner]
            np.minimum.at(least, owner[on] * registers + slot[on], time[on])
            off = ~on
            waiting = [(owner[off], state[off], time[off], slot[off])]
            owner, state, time = owner[on], state[on], time[on]
    with np.errstate(divide="ignore"):
        value = np.floor(1 - np.log(least) / np.log(SCALE))
    return np.clip(value, LOWEST, HIGHEST).astype(np.int16).reshape(len(sets), registers)


def band_of(percent: int, registers: int = REGISTERS) -> int:
    """Registers of a band: as many as leave pairs at the threshold a chance of MISSED."""
    for band in range(registers, 1, -1):
        if (1 - (percent / 100) ** band) ** (registers // band) <= MISSED:
            return band
    return 1


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The registers of a union."""
    return np.maximum(a, b)


def _log_share(x: np.ndarray) -> np.ndarray:
    """Chance that one side's register is larger, from its own share of elements."""
    return -np.log1p(-x * (SCALE - 1) / SCALE) / np.log(SCALE)


def likely_similarity(one, size, many, sizes) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of one sketch with each of many."""
    above = (one > many).sum(axis=1)[:, None]
    below = (one < many).sum(axis=1)[:, None]
    equal = many.shape[1] - above - below
    u = (size / (size + sizes))[:, None]
    v = 1 - u
    grid = np.minimum(np.linspace(0.0, 1.0, 101)[None, :], np.minimum(u / v, v / u))
    up = np.maximum(_log_share(np.maximum(u - v * grid, 0)), 1e-12)
    down = np.maximum(_log_share(np.maximum(v - u * grid, 0)), 1e-12)
    rest = np.maximum(1 - up - down, 1e-12)
    score = above * np.log(up) + below * np.log(down) + equal * np.log(rest)
    return np.take_along_axis(grid, score.argmax(axis=1)[:, None], axis=1)[:, 0]


def _sketch_bands(sets: list[np.ndarray], registers: int, band: int):
    values = registers_of(sets, registers)
    n = registers // band
    keys = np.zeros((len(sets), n), np.uint64)
    for k in range(band):
        part = values[:, k : n * band : band].astype(np.int64).view(np.uint64)
        keys = mix(keys * GOLDEN + part + np.uint64(k + 1))
    return values, keys


def _listed(values: np.ndarray) -> pa.Array:
    """Rows of a matrix as an Arrow list array."""
    n, k = values.shape
    return pa.ListArray.from_arrays(
        pa.array(np.arange(n + 1, dtype=np.int32) * k), pa.array(values.reshape(-1))
    )


def _sketch(width: int, percent: int):
    band = band_of(percent)

    def sketch(text: pa.Array) -> pa.Array:
        sizes, prints, bands = [], [], []
        for _, data, offsets in blocks(text):
            sets = shingle_sets(Block(data, offsets), width)
            _, keys = _sketch_bands(sets, REGISTERS, band)
            sizes += [len(s) for s in sets]
            # two sums of mixed elements stand for the whole set
            prints += [
                (int(mix(s).sum(dtype=np.uint64)), int(mix(s ^ GOLDEN).sum(dtype=np.uint64)))
                for s in sets
            ]
            bands.append(keys.view(np.int64))
        two = np.array(prints, np.uint64).reshape(-1, 2).view(np.int64)
        keys = np.concatenate(bands) if bands else np.zeros((0, REGISTERS // band), np.int64)
        return pa.StructArray.from_arrays(
            [pa.array(sizes, pa.int64()), _listed(two), _listed(keys)],
            ["n_shingles", "print", "bands"],
        )

    return sketch


class _Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def confirmed_links(ids, sets, first: np.ndarray, percent: int, roots=None):
    """Links among the documents of a group that connect its components.

    Pairs with ``first`` set on neither side are left out. ``roots``: components
    known before.
    """
    n = len(ids)
    order = sorted(range(n), key=lambda i: ids[i])
    forest, seen = _Forest(n), {}
    if roots is not None:
        for i in order:
            forest.up[i] = forest.root(seen.setdefault(roots[i], i))
    sizes = np.array([len(s) for s in sets], np.int64)
    sketches = registers_of(sets)
    # the larger a set's share the closer its registers; the margin only saves work
    margin = percent / 100 - SIGMAS * np.sqrt(percent / 100 * (1 - percent / 100) / sketches.shape[1])
    out = []
    for place, i in enumerate(order):
        rest = np.array(order[place + 1 :], dtype=int)
        if not len(rest) or not sizes[i]:
            continue
        if not first[i]:
            rest = rest[first[rest]]
        small, large = np.minimum(sizes[rest], sizes[i]), np.maximum(sizes[rest], sizes[i])
        rest = rest[100 * small >= percent * large]
        mine = forest.root(i)
        rest = np.array([j for j in rest if forest.root(j) != mine], dtype=int)
        if not len(rest):
            continue
        rest = rest[likely_similarity(sketches[i], sizes[i], sketches[rest], sizes[rest]) >= margin]
        for j in rest:
            if forest.root(j) != forest.root(i) and _similar(sets[i], sets[j], percent):
                forest.up[forest.root(j)] = forest.root(i)
                out.append((ids[i], ids[j]))
    return out


def _group_links(width: int, percent: int):
    def links(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids = table.column("id").to_pylist()
        text = table.column("text").chunk(0) if table.num_rows else pa.array([], pa.binary())
        sets = [s for _, d, o in blocks(text) for s in shingle_sets(Block(d, o), width)]
        first = np.array(table.column("first").to_pylist(), bool)
        found = confirmed_links(ids, sets, first, percent, table.column("root").to_pylist())
        return pa.table(
            {
                "a": pa.array([a for a, _ in found], pa.int64()),
                "b": pa.array([b for _, b in found], pa.int64()),
            }
        )

    return links


def _deal(members: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Confirmed links of members (group columns, id, first, root)."""
    keys = [c for c in members.columns if c.startswith("g_")]
    return (
        members.join(docs, "id")
        .groupBy(*keys)
        .applyInArrow(_group_links(width, percent), "a bigint, b bigint")
    )


def near_duplicates(
    docs: DataFrame,
    percent: int = THRESHOLD_PCT,
    group_rows: int = GROUP_ROWS,
    group_shingles: int = GROUP_SHINGLES,
    width: int = WIDTH,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per document."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    sketch = arrow_udf(
        _sketch(width, percent), "n_shingles bigint, print array<bigint>, bands array<bigint>"
    )
    sketched = durable(
        docs.select(F.col("doc_id").alias("id"), sketch(text).alias("s")).select("id", "s.*")
    )
    real = sketched.where("id is not null and n_shingles > 0")
    # one class per distinct set; a document id that occurs twice joins its classes
    classes = real.groupBy("n_shingles", "print").agg(
        F.min("id").alias("class"), F.first("bands").alias("bands")
    )
    member = (
        real.select("id", "n_shingles", "print")
        .join(classes.select("n_shingles", "print", "class"), ["n_shingles", "print"])
        .select("id", "class", "n_shingles")
    )
    hubs = _hubs(classes)
    in_hub = durable(_sized(hubs, classes, group_rows, group_shingles))

    # the list of members grows with the corpus: a merge join at every size
    texts = durable(
        docs.select(F.col("doc_id").alias("id"), text.alias("text"))
        .join(in_hub.select("id").distinct().hint("merge"), "id", "left_semi")
        .withColumn("mark", F.xxhash64("text"))
        .dropDuplicates(["id", "mark"])
        .drop("mark")
    )
    dealt = in_hub.select(
        F.col("hub").alias("g_hub"),
        F.pmod(F.xxhash64("id"), F.col("groups")).alias("g_part"),
        "id",
    )
    # the hub itself is in each of its groups
    own = in_hub.where("id = hub").select(
        F.col("hub").alias("g_hub"),
        F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("g_part"),
        "id",
    )
    members = dealt.unionByName(own).distinct()
    found = durable(
        _deal(
            members.withColumns({"first": F.lit(True), "root": F.col("id")}), texts, width, percent
        )
    )
    copies = member.where("id != class").select(F.col("class").alias("a"), F.col("id").alias("b"))
    large = in_hub.where("groups > 1")
    links = found
    if not large.isEmpty():
        across = _across(large, components(found), texts, width, percent, group_rows)
        links = found.unionByName(durable(across))
    joined = components(links.unionByName(copies))
    out = (
        sketched.select("id", "n_shingles")
        .join(joined, "id", "left")
        .withColumn("component_id", F.coalesce("component_id", "id"))
    )
    return out.select(
        F.col("id").alias("doc_id"),
        "n_shingles",
        "component_id",
        F.expr("id <=> component_id").alias("kept"),
    )


def _hubs(classes: DataFrame) -> DataFrame:
    """(hub, id): members of each bucket under its smallest class; each pair once."""
    banded = classes.select(F.col("class").alias("id"), F.posexplode("bands").alias("band", "key"))
    least = (
        banded.groupBy("band", "key")
        .agg(F.min("id").alias("hub"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
    )
    return banded.join(least, ["band", "key"]).select("hub", "id").distinct()


def _sized(hubs: DataFrame, classes: DataFrame, rows: int, shingles: int) -> DataFrame:
    """(hub, id, groups): into how many groups the members of a hub are dealt."""
    with_size = hubs.join(classes.select(F.col("class").alias("id"), "n_shingles"), "id")
    groups = with_size.groupBy("hub").agg(
        F.ceil(
            F.greatest(
                F.count(F.lit(1)) / F.lit(rows), F.sum("n_shingles") / F.lit(shingles)
            )
        ).alias("groups")
    )
    return hubs.join(groups, "hub").select("hub", "id", "groups")


def _across(
    large: DataFrame, known: DataFrame, texts: DataFrame, width: int, percent: int, rows: int
) -> DataFrame:
    """Links between the groups of one hub: its smaller components against all."""
    member = large.join(known, "id", "left").withColumn(
        "root", F.coalesce("component_id", "id")
    )
    sizes = member.groupBy("hub", "root").agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy("hub").agg(
        F.max_by("root", F.struct("n", "root")).alias("main"),
        F.sum("n").alias("members"),
        F.max("n").alias("most"),
    )
    member = member.join(main.where("members > most"), "hub").withColumn(
        "minor_groups", F.ceil((F.col("members") - F.col("most")) / F.lit(rows))
    )
    at = F.xxhash64("id", F.lit(1))
    minor = member.where("root != main").select(
        F.col("hub").alias("g_hub"),
        F.pmod(at, F.col("minor_groups")).alias("g_minor"),
        F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("g_part"),
        "id",
        "root",
        F.lit(True).alias("first"),
    )
    every = member.select(
        F.col("hub").alias("g_hub"),
        F.explode(F.sequence(F.lit(0), F.col("minor_groups") - 1)).alias("g_minor"),
        F.pmod(F.xxhash64("id"), F.col("groups")).alias("g_part"),
        "id",
        "root",
        F.lit(False).alias("first"),
    )
    group = minor.unionByName(every).groupBy("g_hub", "g_minor", "g_part", "id", "root").agg(
        F.max("first").alias("first")
    )
    return _deal(group, texts, width, percent)
