"""Connected components of a table of links, by rounds of joins.

Alternates large-star and small-star: every vertex hands its larger neighbours to
its smallest neighbour, then its smaller ones. Both keep the components and turn
them into stars around their smallest vertex in a number of rounds that grows with
the logarithm of a component's size. Links stay in Spark tables; each round is a
written table in the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans import durable


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    return (
        both.join(least, "a")
        .where("b > a")
        .select(F.col("m").alias("a"), "b")
        .where("a < b")
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """links: a < b."""
    least = links.groupBy("b").agg(F.min("a").alias("m"))
    return (
        links.join(least, "b")
        .select("m", F.explode(F.array("a", "b")).alias("v"))
        .where("m < v")
        .select(F.col("m").alias("a"), F.col("v").alias("b"))
        .distinct()
    )


def _print(links: DataFrame):
    row = links.select(
        F.count(F.lit(1)),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
    ).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """(id, component_id) of every vertex of links (a bigint, b bigint).

    component_id is the smallest vertex reachable. Links with a null end and
    links of a vertex to itself are left out; an empty table gives no rows.
    """
    now = durable(
        links.where("a is not null and b is not null and a != b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    seen = _print(now)
    while seen[0]:
        now = durable(_small_star(_large_star(now)))
        found = _print(now)
        if found == seen:
            break
        seen = found
    return (
        now.select(F.col("b").alias("id"), F.col("a").alias("component_id"))
        .unionByName(now.select(F.col("a").alias("id"), F.col("a").alias("component_id")).distinct())
    )
