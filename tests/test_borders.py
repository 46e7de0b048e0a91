"""Tile borders against SQL's NTILE, with ties and with brackets narrower than the table."""

import random
from datetime import date, timedelta

import duckdb
import pytest

from tests.conftest import SMALL, rows
from tests.test_executed_plans import executions
from tidemark.operators import customers
from tidemark.plans import borders, with_tiles
from workload import roles
from workload.suite import QUERIES

SHAPES = {
    "distinct": lambda rng, i: i * 7 % 30011,
    "few": lambda rng, i: rng.randint(0, 3),
    "hot": lambda rng, i: 500 if rng.random() < 0.4 else rng.randint(0, 1000),
    "one": lambda rng, i: 5,
    "nulls": lambda rng, i: None if rng.random() < 0.3 else rng.randint(0, 100),
}


def ntile_of(data, k):
    con = duckdb.connect()
    con.execute("CREATE TABLE t (id BIGINT, v BIGINT)")
    columns = [[d[0] for d in data], [d[1] for d in data]]
    con.execute("INSERT INTO t SELECT unnest(?::BIGINT[]), unnest(?::BIGINT[])", columns)
    return con.execute(f"SELECT id, ntile({k}) OVER (ORDER BY v NULLS FIRST, id) FROM t").fetchall()


@pytest.mark.parametrize("n", [0, 1, 3, 9, 10, 11, 200])
@pytest.mark.parametrize("shape", ["few", "one", "nulls"])
def test_small_tables(spark, n, shape):
    rng = random.Random(n)
    data = [(i * 31 % 1009, SHAPES[shape](rng, i)) for i in range(n)]
    df = spark.createDataFrame(data, "id BIGINT, v BIGINT")
    got = rows(with_tiles(df, {"t": "v"}, "id", 10).select("id", "t"))
    assert sorted(got) == sorted(ntile_of(data, 10))


@pytest.mark.parametrize("partitions", [1, 16])
@pytest.mark.parametrize("shape", SHAPES)
def test_brackets_and_bins(spark, monkeypatch, shape, partitions):
    # coarse sketches, so that brackets are narrow already for this many rows
    monkeypatch.setattr(borders, "ACCURACY", 1000)
    monkeypatch.setattr(borders, "_MARGIN", 0.004)
    monkeypatch.setattr(borders, "BINS", 8)
    rng = random.Random(5)
    data = [(i * 7919 % 100003 - 40000, SHAPES[shape](rng, i)) for i in range(20_000)]
    df = spark.createDataFrame(data, "id BIGINT, v BIGINT").repartition(partitions)
    assert 20_000 * borders._MARGIN > 2 * 9 + 12
    got = rows(with_tiles(df, {"t": "v"}, "id", 10).select("id", "t"))
    assert sorted(got) == sorted(ntile_of(data, 10))


def test_dates_and_several_columns_at_once(spark):
    rng = random.Random(1)
    data = [(i, date(2024, 1, 1) + timedelta(rng.randint(0, 5)), float(rng.randint(0, 9))) for i in range(97)]
    df = spark.createDataFrame(data, "id BIGINT, d DATE, x DOUBLE")
    got = rows(with_tiles(df, {"r": "d", "m": "x"}, "id", 5).select("id", "r", "m"))
    want = {}
    for name, at in (("r", 1), ("m", 2)):
        for place, row in enumerate(sorted(data, key=lambda z: (z[at], z[0]))):
            # 97 = 2 tiles of 20 and 3 of 19
            want.setdefault(row[0], {})[name] = place // 20 + 1 if place < 40 else (place - 40) // 19 + 3
    assert sorted(got) == sorted((k, v["r"], v["m"]) for k, v in want.items())


def test_text_keys_are_ranked_by_a_sort(spark):
    data = [(f"u{i:03d}", i % 7) for i in range(50)]
    df = spark.createDataFrame(data, "id STRING, v BIGINT")
    got = rows(with_tiles(df, {"t": "v"}, "id", 5).select("id", "t"))
    ranked = sorted(data, key=lambda r: (r[1], r[0]))
    assert sorted(got) == sorted((r[0], i // 10 + 1) for i, r in enumerate(ranked))


@pytest.mark.parametrize("text", [False, True])
def test_concentration_by_borders_and_by_ranks_agree(spark, text):
    rng = random.Random(2)
    for n in (1, 7, 20, 21, 100, 333):
        data = [(i, float(rng.choice([1, 2, 5, 5, 5, 40, rng.randint(1, 99)]))) for i in range(n)]
        df = spark.createDataFrame(data, "customer_id BIGINT, revenue DOUBLE")
        if text:
            df = df.selectExpr("lpad(string(customer_id), 4, '0') AS customer_id", "revenue")
        con = duckdb.connect()
        con.execute("CREATE TABLE t (k BIGINT, v DOUBLE)")
        con.executemany("INSERT INTO t VALUES (?, ?)", data)
        want = con.execute("""
            SELECT round(100 * sum(v) FILTER (WHERE d = 1) / sum(v), 2),
                   round(100 * sum(v) FILTER (WHERE p <= 0.15) / sum(v), 2),
                   round(100 * sum(v) FILTER (WHERE d <= 2) / sum(v), 2)
            FROM (SELECT v, ntile(10) OVER (ORDER BY v DESC, k) AS d,
                         percent_rank() OVER (ORDER BY v DESC) AS p FROM t)""").fetchall()
        assert rows(customers.concentration(df)) == want


@pytest.mark.parametrize("name", ["q20_rfm", "q20_rfm_segments", "e19_rfm_profile", "q23_pareto", "e12_concentration"])
def test_nothing_is_written(spark, name):
    before = executions(spark)
    df = QUERIES[name](spark, SMALL)
    df.collect()
    ran = [plan for k, plan in executions(spark).items() if k not in before]
    assert len(ran) == 1 and "Insert" not in ran[0]  # one plan, all of it lazy


def test_one_reading_of_the_orders(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = customers.rfm(roles.orders(spark, SMALL))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("FileScan") == 1
