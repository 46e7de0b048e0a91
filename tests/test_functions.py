import duckdb
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark import functions as fn


def test_rounding_equals_an_engine_that_scales_first(spark):
    ties = [i / 1000 for i in range(-3005, 3005, 10)] + [1.005, 2.675, 1e9 + 0.125]
    df = spark.createDataFrame([(x,) for x in ties], "x DOUBLE")
    got = dict(rows(df.select("x", fn.round_to("x", 2))))
    want = dict(
        duckdb.execute("SELECT x, round(x, 2) FROM (SELECT unnest(?) AS x)", [ties]).fetchall()
    )
    assert got == want


def test_percent_of_nothing_is_null(spark):
    df = spark.createDataFrame([(1, 0), (1, 3)], "a INT, b INT")
    assert rows(df.select(fn.percent("a", "b"))) == [(None,), (33.33,)]


def test_money_sums_do_not_depend_on_order(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (1e9,), (-1e9,), (0.3,)], "x DOUBLE")
    total = df.repartition(3).agg(fn.as_double(fn.total_money("x"))).collect()[0][0]
    assert total == 0.6


def test_boundary_counts(make):
    df = make(
        "a TIMESTAMP_NTZ, b TIMESTAMP_NTZ",
        [
            ("2024-01-01 00:00:59", "2024-01-01 00:01:01"),
            ("2024-01-01 23:59:59", "2024-01-02 00:01:01"),
            ("2024-01-01 00:00:00", "2024-01-01 00:00:59"),
        ],
    )
    minutes = fn.epoch_minutes("b") - fn.epoch_minutes("a")
    assert rows(df.select(minutes, fn.day_gap("a", "b"))) == [(1, 0), (2, 1), (0, 0)]


def test_epoch_seconds_round_down_before_1970(make):
    df = make(
        "t TIMESTAMP_NTZ",
        [("1970-01-01 00:00:00.5",), ("1969-12-31 23:59:59.5",), ("2024-03-10 02:30:00",)],
    )
    assert rows(df.select(fn.epoch_seconds("t"))) == [(0,), (-1,), (1710037800,)]


def test_time_zone_of_the_session_does_not_matter(spark, make):
    df = make("t TIMESTAMP_NTZ", [("2024-03-10 02:30:00",)])
    columns = [fn.epoch_seconds("t"), fn.epoch_minutes("t"), F.day("t"), fn.week_of("t")]
    before = rows(df.select(*columns))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert rows(df.select(*columns)) == before
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize(
    "ts, monday, sunday",
    [
        ("2024-01-01", "2024-01-01", "2024-01-07"),
        ("2024-01-07", "2024-01-01", "2024-01-07"),
        ("2024-01-08", "2024-01-08", "2024-01-14"),
    ],
)
def test_weeks(make, ts, monday, sunday):
    df = make("t DATE", [(ts,)])
    got = rows(df.select(fn.week_of("t").cast("string"), fn.week_ending_sunday("t").cast("string")))
    assert got == [(monday, sunday)]


def test_period_gaps(make):
    df = make("a DATE, b DATE", [("2023-11-01", "2024-02-01")])
    got = rows(df.select(*[fn.period_gap("a", "b", g) for g in ("month", "quarter", "day")]))
    assert got == [(3, 1, 92)]


def test_unknown_grain_is_refused(make):
    with pytest.raises(ValueError):
        fn.period_of("t", "fortnight")
