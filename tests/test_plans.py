import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.functions import ntile_bucket, two_sided_p_value
from tidemark.plans import (
    date_series,
    dense,
    durable,
    exact_quantiles,
    global_rank,
    release,
    scratch_path,
    value_counts,
)
from tidemark.plans.durable import checkpoint_root


@pytest.mark.parametrize("slices", [None, 1, 3, 7])
def test_global_rank_is_the_sorted_position(spark, slices):
    values = [(i, (i * 37) % 11) for i in range(200)]
    df = spark.createDataFrame(values, "id BIGINT, v BIGINT").repartition(5)
    ranked = global_rank(df, [F.desc("v"), F.col("id")], slices=slices)
    got = {r["id"]: (r["rank"], r["rows"]) for r in ranked.collect()}
    order = sorted(values, key=lambda r: (-r[1], r[0]))
    assert got == {r[0]: (i, 200) for i, r in enumerate(order)}


def test_global_rank_splits_a_value_shared_by_most_rows(spark):
    df = spark.range(1000).select("id", F.lit(5).alias("v"))
    ranked = global_rank(df, [F.col("v"), F.col("id")], slices=6)
    assert {r["id"]: r["rank"] for r in ranked.collect()} == {i: i for i in range(1000)}


def test_global_rank_of_nothing(spark):
    empty = spark.createDataFrame([], "id BIGINT")
    assert rows(global_rank(empty, [F.col("id")])) == []


@pytest.mark.parametrize("n", [1, 3, 9, 10, 11, 23, 100])
@pytest.mark.parametrize("k", [5, 10])
def test_ntile_matches_sql(spark, n, k):
    got = (
        spark.range(n)
        .withColumn("rows", F.lit(n).cast("long"))
        .select("id", ntile_bucket(F.col("id"), F.col("rows"), k).alias("b"))
    )
    want = duckdb.execute(f"SELECT i, ntile({k}) OVER (ORDER BY i) FROM range({n}) t(i)")
    assert sorted(rows(got)) == sorted(want.fetchall())


@pytest.mark.parametrize("slices", [None, 2, 9])
def test_quantiles_match_linear_interpolation(spark, slices):
    rng = np.random.default_rng(3)
    data = [("a", float(x)) for x in rng.normal(size=101)]
    data += [("b", float(x)) for x in rng.integers(0, 4, size=500)]  # heavy ties
    data += [("c", 7.0), ("d", None), (None, 1.0), (None, 2.0)]
    df = spark.createDataFrame(data, "g STRING, x DOUBLE")
    probs = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    got = exact_quantiles(value_counts(df, ["g"], "x", slices), ["g"], "x", probs)
    found = {r["g"]: r for r in got.collect()}
    assert set(found) == {"a", "b", "c", None}
    for group, row in found.items():
        values = [x for g, x in data if g == group]
        assert row["n"] == len(values)
        for name, p in probs.items():
            assert row[name] == pytest.approx(np.quantile(values, p), abs=1e-12)


@pytest.mark.parametrize("slices", [None, 4])
def test_ungrouped_quantiles(spark, slices):
    df = spark.range(1, 929).select(F.col("id").cast("double").alias("x"))
    got = exact_quantiles(
        value_counts(df, [], "x", slices), [], "x", {"q1": 0.25, "md": 0.5, "q95": 0.95}
    )
    ((n, q1, md, q95),) = rows(got)
    assert (n, q1, md) == (928, 232.75, 464.5)
    assert q95 == pytest.approx(881.65)


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([], "x DOUBLE")
    got = exact_quantiles(value_counts(empty, [], "x"), [], "x", {"md": 0.5})
    assert rows(got) == [(None, None)]


def test_calendar_is_gap_free(make):
    df = make("m DATE, n INT", [("2024-01-01", 1), ("2024-04-01", 2)])
    got = rows(dense(df, "m", "month").orderBy("m").select(F.month("m"), "n"))
    assert got == [(1, 1), (2, None), (3, None), (4, 2)]


def test_date_series_includes_both_ends(spark):
    got = date_series(spark, "2024-01-01", "2024-03-01", "month")
    assert [str(r[0]) for r in got.collect()] == ["2024-01-01", "2024-02-01", "2024-03-01"]


def test_p_value_is_close_to_the_exact_normal_tail(spark):
    from math import erfc, sqrt

    zs = [0.0, 0.5, 1.96, -1.96, 3.3, 4.81]
    df = spark.createDataFrame([(z,) for z in zs], "z DOUBLE")
    for z, p in rows(df.select("z", two_sided_p_value(F.col("z")))):
        assert p == pytest.approx(erfc(abs(z) / sqrt(2)), abs=2e-7)


class FakeSession:
    """Only what the choice of the checkpoint folder looks at."""

    def __init__(self, named=None):
        self.named, self.conf = named, self

    def get(self, key, default):
        return self.named or default


def test_the_named_checkpoint_folder_is_used():
    assert checkpoint_root(FakeSession("hdfs://shared/ck")) == "hdfs://shared/ck"


def test_an_unnamed_folder_is_an_error():
    with pytest.raises(RuntimeError):
        checkpoint_root(FakeSession())


def test_released_tables_are_gone(spark):
    release(spark)
    kept = durable(spark.range(5))
    assert kept.count() == 5 and release(spark) == 1 and release(spark) == 0
    with pytest.raises(Exception, match="(?i)not exist|no such file|PATH_NOT_FOUND"):
        durable_again = spark.read.parquet(kept.inputFiles()[0])
        durable_again.count()


def test_quantiles_of_infinite_values(spark):
    inf = float("inf")
    df = spark.createDataFrame([(1.0,), (inf,), (inf,)], "x DOUBLE")
    got = exact_quantiles(value_counts(df, [], "x"), [], "x", {"lo": 0.0, "mid": 0.5, "hi": 1.0})
    assert rows(got.select("lo", "mid", "hi")) == [(1.0, inf, inf)]


def test_gaps_are_filled_in_one_reading(make):
    df = make("d DATE, n INT", [("2024-01-01", 1), ("2024-01-15", 2), ("2024-01-22", None)])
    filled = dense(df, "d", "week").orderBy("d")
    assert [r.n for r in filled.collect()] == [1, None, 2, None]
    later = dense(df, "d", "week", until="2024-02-05").orderBy("d")
    assert [str(r.d) for r in later.collect()][-2:] == ["2024-01-29", "2024-02-05"]
    assert filled._jdf.queryExecution().optimizedPlan().toString().count("LocalRelation") <= 1


def test_scratch_tables_lie_in_the_checkpoint_folder(spark):
    one, two = scratch_path(spark, "t"), scratch_path(spark, "t")
    assert one != two and one.startswith(checkpoint_root(spark).rstrip("/"))
