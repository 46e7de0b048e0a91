"""Statistical column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Coefficients of formula 26.2.17 in Abramowitz and Stegun,
# "Handbook of Mathematical Functions" (upper tail of the normal distribution).
TAIL_SHIFT = 0.2316419
INV_SQRT_2PI = 0.3989422804014327
TAIL_COEFFICIENTS = (
    0.319381530,
    -0.356563782,
    1.781477937,
    -1.821255978,
    1.330274429,
)


def two_sided_p_value(z: Column) -> Column:
    """Two-sided p-value of a z-score (absolute error below 1.5e-7).

    Spark has no error function, so the tail is the published polynomial,
    evaluated by Horner's rule.
    """
    size = F.abs(z)
    t = F.lit(1.0) / (F.lit(1.0) + TAIL_SHIFT * size)
    poly = F.lit(0.0)
    for coefficient in reversed(TAIL_COEFFICIENTS):
        poly = (poly + F.lit(coefficient)) * t
    tail = INV_SQRT_2PI * F.exp(-size * size / 2.0) * poly
    return 2.0 * tail


def ntile_bucket(rank: Column, rows: Column, buckets: int) -> Column:
    """NTILE bucket of a 0-based ``rank`` among ``rows`` rows.

    The first ``rows mod buckets`` buckets hold one row more than the others;
    with fewer rows than buckets each row gets its own.
    """
    k = F.lit(buckets).cast("long")
    small = F.floor(rows / k)
    wide = rows % k
    in_wide = wide * (small + 1)
    bucket = F.when(
        rank < in_wide, F.floor(rank / (small + 1)) + 1
    ).otherwise(wide + F.floor((rank - in_wide) / F.greatest(small, F.lit(1))) + 1)
    return bucket.cast("long")
