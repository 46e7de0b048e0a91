"""Rows at given ranks of a total order, without sorting the table.

``ntile(k) over (order by value, key)`` is known once the last row of each of the first
k - 1 tiles is. Such border rows are selected by counting:

1. approximate quantile sketches of the values bracket each border: the wanted rank
   lies between two values whose ranks are certain to lie about it. A sketch of the
   keys cuts them into ``BINS`` bins of about equally many rows;
2. rows are counted in the gaps between brackets, and by value and bin inside them.
   Running counts give each border's exact value and bin, and its rank there;
3. the keys of the rows with this value in this bin are counted in order, and one is
   the border.

What is ordered are the counts inside brackets, a few times ``1 / ACCURACY`` of the
rows, and the keys of at most one row in ``BINS``: a value that a third of all rows
share is no more than that. All steps read the same rows; written over one shuffled
frame they share its shuffle, and nothing is stored.

The result is one small row, with which every row is labelled by comparison. Keys that
are neither numbers nor dates have no sketch; :func:`with_tiles` ranks their rows by a
distributed sort instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import ntile_bucket
from tidemark.plans.ranking import global_rank

Spot = tuple[float, Callable[[Column], Column]]  # share of the rows, exact rank of n rows

ACCURACY = 20_000  # of the sketches: ranks are known to one part in so many
BINS = 64
_MARGIN = 4.0 / ACCURACY  # how far on either side a bracket reaches


def sortable(df: DataFrame, *columns: str) -> bool:
    """Whether border rows can be selected by these columns."""
    return all(isinstance(df.schema[c].dataType, (T.NumericType, T.DateType)) for c in columns)


def _number(column: str, kind: T.DataType) -> str:
    """An order-preserving double, NULL first; two values may share it. As SQL, like all
    functions on arrays here: built call by call they take longer than they run."""
    x = f"unix_date(`{column}`)" if isinstance(kind, T.DateType) else f"`{column}`"
    return f"coalesce(cast({x} AS DOUBLE), double('-infinity'))"


def tile_ends(buckets: int) -> list[Spot]:
    """The last ranks, counted from 1, of all tiles but the last."""

    def end(i: int):
        return lambda n: F.floor(n / buckets) * i + F.least(n % buckets, F.lit(i))

    return [(i / buckets, end(i)) for i in range(1, buckets)]


def border_rows(rows: DataFrame, values: list[str], key: str, spots: list[Spot]) -> Column:
    """A scalar struct: for each of ``values`` a list of (i, value, key), the row at each
    of ``spots`` in ascending order of value and key, NULL first.

    Values and key are numbers or dates (:func:`sortable`), keys unique. A spot's rank may
    differ from its share of the rows by a few.
    """
    number = {v: _number(v, rows.schema[v].dataType) for v in (*values, key)}

    def sketch(column: str, shares: list[float]) -> Column:
        asked = ", ".join(f"{s!r}D" for s in shares)
        return F.expr(f"percentile_approx({number[column]}, array({asked}), {ACCURACY})")

    # 1. brackets of all borders of all values, and bins of keys, in one aggregation
    shares = sorted(share for share, _ in spots)
    lows = [max(0.0, s - _MARGIN) for s in shares]
    highs = [min(1.0, s + _MARGIN) for s in shares]
    marks = rows.agg(
        F.struct(
            F.count(F.lit(1)).alias("_n"),
            sketch(key, [b / BINS for b in range(1, BINS)]).alias("_bins"),
            # one sketch of each column: all lower ends, then all upper ones
            *(sketch(v, lows + highs).alias(f"_ends_{v}") for v in values),
        )
    ).scalar()
    marked = _attached(rows, marks)
    # a margin of few rows is no margin: then all rows are inside
    narrow = f"_n * {_MARGIN!r}D >= {2 * len(spots) + 12}"
    bin_of_key = f"if({narrow}, size(filter(_bins, b -> b < {number[key]})), 0)"

    # 2. counts of the gaps, and of each value and bin inside a bracket
    m = len(spots)
    # the least place of a bracket whose upper end is not below the value: it is inside if
    # the lower end is not above it (ends rise)
    spotted = marked.select(
        "*",
        *(
            F.expr(f"size(filter(slice(`_ends_{v}`, {m + 1}, {m}), h -> h < {number[v]}))").alias(f"_gap_{v}")
            for v in values
        ),
    )

    def cell_of(v: str) -> str:
        x, gap = number[v], f"`_gap_{v}`"
        inside = f"if({narrow}, {gap} < {m} AND get(`_ends_{v}`, {gap}) <= {x}, true)"
        own = ", ".join(f"'{o}', if({inside} AND '{o}' = '{v}', `{o}`, NULL)" for o in values)
        return (
            f"named_struct('name', '{v}', 'x', {x}, 'value', named_struct({own}), "
            f"'gap', if({inside}, NULL, {gap}), 'bin', if({inside}, {bin_of_key}, NULL))"
        )

    cell = ["name", "gap", "value", "bin"]
    counted = (
        spotted.select("_n", F.expr(f"inline(array({', '.join(map(cell_of, values))}))"))
        .groupBy(*cell)
        .agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("x"), F.max("_n").alias("rows"))
    )
    in_order = Window.partitionBy("name").orderBy(
        "x", *(F.col(f"value.{v}").asc_nulls_first() for v in values), "bin"
    )
    wanted = F.array(
        *(
            F.struct(F.lit(i).alias("i"), rank(F.col("rows")).cast("long").alias("at"))
            for i, (_, rank) in enumerate(spots, start=1)
        )
    )
    here = "filter(wanted, t -> t.at > upto - n AND t.at <= upto)"
    # a border between brackets would contradict the sketch's guarantee
    lost = F.raise_error(F.lit("a border lies outside its bracket")).cast("int")
    found = (
        counted.select(*cell, "n", wanted.alias("wanted"), F.sum("n").over(in_order).alias("upto"))
        .select(*cell, "n", "upto", F.expr(f"explode({here})").alias("t"))
        .agg(
            F.collect_list(
                F.struct(
                    "name",
                    F.when(F.col("gap").isNull(), F.col("t.i")).otherwise(lost).alias("i"),
                    "value",
                    "bin",
                    (F.col("t.at") - F.col("upto") + F.col("n")).alias("at"),
                )
            ).alias("_spots"),
        )
        .select(F.struct("_spots"))
        .scalar()
    )

    # 3. the keys of the rows in the borders' cells, in order
    owned = ", ".join(
        f"filter(_spots, s -> s.name = '{v}' AND s.value.`{v}` <=> `{v}` AND s.bin = {bin_of_key})"
        for v in values
    )
    by_key = Window.partitionBy("name", "i").orderBy(F.col("key").asc_nulls_first())
    last = (
        _attached(marked, found)
        .select(F.col(key).alias("key"), F.expr(f"inline(flatten(array({owned})))"))
        .groupBy("name", "i", "value", "at", "key")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("name", "i", "value", "at", "key", "n", F.sum("n").over(by_key).alias("upto"))
        .where("at <= upto and at > upto - n")
    )

    def listed(v: str) -> Column:
        return F.collect_list(
            F.when(F.col("name") == v, F.struct("i", F.col(f"value.{v}").alias("value"), "key"))
        )

    return last.agg(F.struct(*(listed(v).alias(v) for v in values))).scalar()


def _attached(rows: DataFrame, struct: Column) -> DataFrame:
    """The fields of a scalar struct as columns. Through a generator, since a projection
    would be merged with those after it and repeat the subquery in each use."""
    return rows.select("*", F.inline(F.array(struct)))


def is_after(border: str, value: str, key: str) -> str:
    """SQL of whether the row comes after a border row."""

    def higher(column: str, than: str) -> str:
        return f"coalesce(if({than} IS NULL, {column} IS NOT NULL, {column} > {than}), false)"

    tied = f"{border}.value <=> `{value}` AND {higher(f'`{key}`', f'{border}.key')}"
    return f"({higher(f'`{value}`', f'{border}.value')} OR {tied})"


def with_tiles(
    rows: DataFrame, tiles: dict[str, str], key: str, buckets: int, slices: int | None = None
) -> DataFrame:
    """Add NTILE columns: ``tiles`` gives for each the column it orders by, ascending,
    NULL first, ties broken by ``key``."""
    values = list(tiles.values())
    if sortable(rows, key, *values):

        borders = border_rows(rows, values, key, tile_ends(buckets))
        return _attached(rows, F.struct(borders.alias("_b"))).select(
            *rows.columns,
            *(
                F.expr(f"CAST(size(filter(_b.`{v}`, b -> {is_after('b', v, key)})) + 1 AS BIGINT)").alias(name)
                for name, v in tiles.items()
            ),
        )
    for name, v in tiles.items():
        ranked = global_rank(rows, [F.asc(v), F.asc(key)], "_rank", "_rows", slices)
        rows = ranked.withColumn(name, ntile_bucket(F.col("_rank"), F.col("_rows"), buckets)).drop(
            "_rank", "_rows"
        )
    return rows
