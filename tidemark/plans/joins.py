from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_safe_join(
    left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner"
) -> DataFrame:
    """Equi-join in which a NULL key matches a NULL key.

    Group keys may be NULL; a plain join would lose that group. Spark still
    plans ``<=>`` as a hash or sort-merge equi-join.
    """
    if not keys:
        raise ValueError("a join needs at least one key")
    l, r = left.alias("l"), right.alias("r")
    match = reduce(
        lambda a, b: a & b, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
    )
    extra = [F.col(f"r.{c}") for c in right.columns if c not in keys]
    return l.join(r, match, how).select("l.*", *extra)
