"""Retail lines, data tests, summaries, profiles, sources and sinks."""

import json
import math
import random
import re
from datetime import datetime
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.conftest import by, dicts, rows
from tests.test_executed_plans import executions
from tidemark.functions import total
from tidemark.operators import checks, models, profile, retail, summary
from tidemark.sources import (
    clean_invoice_lines,
    clean_purchases,
    preview,
    read_table,
    union_sheets,
    write_table,
)

LINES = (
    "invoice STRING, stock_code STRING, quantity INT, invoice_ts TIMESTAMP_NTZ, "
    "price DOUBLE, customer_id INT, country STRING, is_cancellation BOOLEAN"
)


@pytest.fixture
def lines(make):
    t = "2024-01-01"
    return make(
        LINES,
        [
            ("1", "a", 2, t, 1.125, 7, "UK", False),
            ("1", "a", 2, t, 1.125, 7, "UK", False),  # an exact copy is kept
            ("2", "a", 1, t, 5.0, 7, "UK", False),
            ("3", "b", 1, t, 10.0, 8, "UK", False),
            ("C3", "b", -1, t, 10.0, 8, "UK", True),
            ("4", "b", 1, t, 10.0, None, "UK", False),
            ("5", "b", 0, t, 10.0, 9, "UK", False),
            ("6", "b", 1, t, -3.0, 9, "FR", False),
        ],
    )


def test_repeat_concentration(lines):
    assert rows(retail.repeat_concentration(lines)) == [
        ("1", 1, 50.0, 10.0, 51.28),
        ("2", 1, 50.0, 10.0, 48.72),  # 9.50 rounds to 10
    ]
    assert rows(retail.customer_repeat(lines)) == [(2, 1, 50.0, 20.0)]


def test_cancelled_and_guest_lines(lines):
    assert rows(retail.cancel_revenue(lines)) == [(-10.0, 27.0)]
    ((n, _, _, cancelled, guests),) = rows(retail.retail_overview(lines))
    assert (n, cancelled, guests) == (8, 1, 1)
    assert clean_purchases(lines).count() == 4


# ---------------------------------------------------------------- data tests


def test_keys_are_compared_as_columns(make):
    df = make("a STRING, b STRING", [("1", "23"), ("12", "3"), ("9", None), ("9", None)])
    assert rows(checks.unique_key(df, ["a", "b"])) == [("9", None, 2)]


def test_null_handling_of_the_column_tests(make):
    df = make("k BIGINT", [(1,), (1,), (2,), (None,), (None,)])
    assert rows(checks.unique(df, "k")) == [(1, 2)]
    assert checks.not_null(df, "k").count() == 2
    assert rows(checks.accepted_values(df, "k", [1])) == [(2, 1)]
    parent = make("k BIGINT", [(1,)])
    assert rows(checks.relationships(df, parent, "k")) == [(2, 1)]


def test_funnel_must_fall_strictly(make):
    df = make(
        "pos INT, event_name STRING, sessions BIGINT",
        [(1, "a", 10), (2, "b", 10), (3, "c", 4)],
    )
    assert rows(checks.monotonic(df, "pos", "sessions", "event_name")) == [("a", 10, 10)]


def test_golden_rows(make):
    df = make("k STRING, x DOUBLE", [("a", 1.0), ("b", 2.0), (None, 3.0)])
    want = make("k STRING, x DOUBLE", [("a", 1.0), ("b", 2.5), ("c", None), (None, 3.0)])
    got = sorted(rows(checks.assert_golden(df, want, ["k"])))
    assert got == [("b", "x", 2.5, 2.0), ("c", "x", None, None)]


def test_ranges(make):
    df = make("x INT", [(0,), (5,), (11,), (None,)])
    got = rows(checks.range_check(df, {"x": (1, 10)}))
    assert got == [("x", 3, 1, 1, 2, "FAIL")]
    assert rows(checks.range_check(df, {"x": (None, 99)}))[0][-1] == "PASS"


def test_reconciliation_and_claims(make):
    one, two = make("v DOUBLE", [(1.0,)]), make("v DOUBLE", [(2.0,)])
    got = rows(
        checks.reconcile([checks.equal_totals("e", one, two), checks.at_most("m", one, two)])
    )
    assert [(r[0], r[3]) for r in got] == [("e", "FAIL"), ("m", "PASS")]
    claims = make(
        "metric STRING, published DOUBLE", [("drop", 54.0), ("repeat", 3.46), ("fidelity", 99.6)]
    )
    metrics = make("metric STRING, value DOUBLE", [("drop", 77.79), ("repeat", 3.46)])
    verdicts = {r[0]: r[3] for r in rows(checks.claim_check(claims, metrics))}
    assert verdicts == {
        "drop": "MISMATCH",
        "repeat": "REPRODUCED",
        "fidelity": "NOT-CHECKABLE",
    }


def test_children_before_their_parent_are_counted(make):
    parent = make("k BIGINT, born DATE", [(1, "2024-01-05"), (2, "2024-01-01")])
    child = make(
        "k BIGINT, t TIMESTAMP_NTZ",
        [(1, "2024-01-04"), (1, "2024-01-04 10:00:00"), (1, "2024-01-05"), (2, "2024-01-01")],
    )
    assert rows(checks.late_parents(parent, child, "k", "born", "t")) == [(2,)]


# ------------------------------------------------------------------ summaries


@pytest.mark.parametrize("partitions", [1, 200])
def test_money_is_exact_beyond_thirteen_digits(spark, partitions):
    amounts = [900_000_000_000.01, 800_000_000_000.02] + [0.01] * 998
    data = [("2024-01-01 10:00:00", x) for x in amounts]
    df = spark.createDataFrame(data, "t STRING, amount DOUBLE").selectExpr("cast(t AS timestamp_ntz) AS t", "amount")
    df = df.repartition(partitions)
    assert rows(summary.weekly_resample(df, "t").select("revenue")) == [(1_700_000_000_010.01,)]
    held = df.selectExpr("'a' AS s", "amount")
    (got,) = dicts(summary.metric_by_segment(held, "amount", "s", money=True))
    assert got["total"] == 1_700_000_000_010.01
    cents = spark.range(0, 1000, 1, partitions).select(F.lit(999_999_999_999.99).alias("x"))
    assert rows(cents.agg(total("x", money=True))) == [(999_999_999_999_990.0,)]


@pytest.mark.parametrize("scale", [1.0, 1e-9, 1e9, 1e14])
def test_other_sums_do_not_depend_on_the_order(spark, scale):
    rng = random.Random(8)
    values = [rng.uniform(-1, 3) * scale for _ in range(5000)]
    want = math.fsum(values)
    got = set()
    for seed, partitions in ((1, 1), (2, 16), (3, 200)):
        random.Random(seed).shuffle(values)
        df = spark.createDataFrame([(x,) for x in values], "x DOUBLE").repartition(partitions)
        got.add(df.agg(total("x")).first()[0])
    (only,) = got
    assert only == pytest.approx(want, rel=1e-12 if scale < 1e-6 else 1e-15)


def test_whole_sums_keep_all_digits(spark):
    df = spark.createDataFrame([(float(2**53),), (1.0,), (1.0,), (-0.25,), (0.25,)], "x DOUBLE").repartition(3)
    assert rows(df.agg(total("x"))) == [(9.007199254740994e15,)]
    assert rows(df.limit(0).agg(total("x"))) == [(None,)]


def test_a_million_segments_need_no_single_task(spark):
    """Each shuffle of the plan is by segment, except that of one row per task."""
    df = spark.range(0, 200_000, 1, 8).select(F.xxhash64("id").alias("g"), F.lit(1.0).alias("x"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = summary.metric_by_segment(df, "x", "g")
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "Window" not in plan and plan.count("Range (") == 1 and "ReusedExchange" in plan
    single = plan.split("Exchange SinglePartition")[1:]
    assert len(single) == 1 and "HashAggregate(keys=[]" in single[0].split("\n")[1]
    assert got.agg(F.count("n"), F.max("share_pct"), F.max("gap")).first() == (200_000, 0.0, 1.0)


def test_metric_by_segment(make):
    df = make("g STRING, x DOUBLE", [("a", 1.0), ("a", 3.0), ("b", 4.0), ("b", None)])
    got = rows(summary.metric_by_segment(df, "x", "g"))
    assert got == [
        ("a", 2, 2.0, 4.0, 50.0, -25.0, 2.0),
        ("b", 1, 4.0, 4.0, 50.0, 50.0, 2.0),
    ]


def test_composition(make):
    df = make("c STRING, d STRING", [("x", "p"), ("x", "p"), ("x", "q"), ("y", "q")])
    assert rows(summary.composition(df, "c", "d")) == [
        ("x", "p", 2, 66.67),
        ("x", "q", 1, 33.33),
        ("y", "q", 1, 100.0),
    ]


def test_dataset_summary(make):
    df = make("k BIGINT", [(1,), (1,), (2,)])
    got = rows(summary.dataset_summary({"t": df}, {"keys": (df, "k")}))
    assert got == [("t", 3), ("keys", 2)]


def test_weeks_end_on_sunday_and_are_gap_free(make):
    df = make(
        "t TIMESTAMP_NTZ, x DOUBLE",
        [("2024-01-01", 10.0), ("2024-01-07 23:59:59", 10.0), ("2024-01-15", 30.0)],
    )
    got = rows(profile.weekly_trend(df, "t", "x"))
    assert [(str(r[0]), *r[1:]) for r in got] == [
        ("2024-01-07", 20.0, 2, 10.0, 0.0, 0.0, 0.0),
        ("2024-01-14", 0.0, 0, 0.0, -100.0, -100.0, -100.0),
        ("2024-01-21", 30.0, 1, 30.0, 0.0, 0.0, 0.0),
    ]
    resampled = rows(summary.weekly_resample(df.withColumnRenamed("x", "amount"), "t"))
    assert [(r[3], r[4]) for r in resampled] == [(None, False), (-100.0, False), (None, True)]


def test_change_from_a_negative_week(make):
    df = make("t DATE, x DOUBLE", [("2024-01-01", -15201.699), ("2024-01-08", 34179.3)])
    got = rows(profile.weekly_trend(df, "t", "x"))
    assert got[1][4] == -324.8  # a published figure


@pytest.mark.parametrize("log10", [False, True])
def test_histogram_matches_numpy(spark, log10):
    rng = np.random.default_rng(2)
    x = np.round(rng.lognormal(3, 0.6, 500), 2)
    df = spark.createDataFrame([(float(v),) for v in x], "x DOUBLE")
    got = rows(summary.histogram(df, "x", 40, log10))
    counts, edges = np.histogram(np.log10(x) if log10 else x, bins=40)
    assert [r[3] for r in got] == counts.tolist()
    assert got[-1][2] == pytest.approx(edges[-1], abs=1e-4)


def test_histogram_of_equal_values(make):
    got = rows(summary.histogram(make("x DOUBLE", [(5.0,), (5.0,)]), "x", 4))
    assert [r[3] for r in got] == [2, 0, 0, 0]


# ------------------------------------------------------------------- profiles


def test_numeric_profile_of_a_published_column(spark):
    got = rows(profile.profile_numeric(spark.range(1, 929).toDF("order_id"), ["order_id"]))
    assert got == [
        ("order_id", 928, 464.5, 464.5, 268.0348, 232.75, 696.25, 881.65, 0.0, 0.0)
    ]


def test_numeric_profile_matches_pandas(spark):
    rng = np.random.default_rng(4)
    frame = pd.DataFrame({"a": rng.lognormal(1, 1, 400), "b": rng.normal(size=400)})
    frame.loc[::7, "b"] = None
    df = spark.createDataFrame(
        [(float(a), None if pd.isna(b) else float(b)) for a, b in frame.values],
        "a DOUBLE, b DOUBLE",
    )
    got = by(profile.profile_numeric(df, ["a", "b"], slices=3), "column_name")
    for c in ("a", "b"):
        s = frame[c].dropna()
        assert got[c]["n"] == len(s)
        assert got[c]["std"] == pytest.approx(s.std(), abs=1e-4)
        assert got[c]["skew"] == pytest.approx(s.skew(), abs=1e-4)
        q1, q3 = s.quantile(0.25), s.quantile(0.75)
        out = ((s < q1 - 1.5 * (q3 - q1)) | (s > q3 + 1.5 * (q3 - q1))).mean() * 100
        assert got[c]["outlier_pct"] == pytest.approx(out, abs=0.0501)
        assert got[c]["p95"] == pytest.approx(s.quantile(0.95), abs=1e-4)


def test_quality(make):
    df = make("a INT, b STRING", [(1, "x"), (1, "x"), (2, "x"), (None, "x")])
    got = {(r[0], r[1]): r[2:] for r in rows(profile.profile_quality(df))}
    assert got[("duplicate_rows", None)] == (1, 25.0)
    assert got[("nulls", "a")] == (1, 25.0)
    assert got[("constant", "a")][0] == 0 and got[("constant", "b")][0] == 1


def test_copies_of_rows_of_any_kind(spark):
    nan = float("nan")
    schema = "a INT, b INT, x DOUBLE, l ARRAY<INT>, s STRUCT<p: INT, q: INT>"
    data = [
        (1, None, nan, [1, None], (1, None)),
        (1, None, nan, [1, None], (1, None)),  # a copy
        (None, 1, nan, [1, None], (1, None)),
        (1, None, nan, [None, 1], (1, None)),  # meets the first by its hash, and is no copy
        (1, None, nan, [1, None], (None, 1)),
        (1, None, 0.0, [], None),
        (1, None, -0.0, [], None),  # a copy
        (1, None, None, [], None),
        (1, None, None, None, None),
        (None, None, None, None, None),
        (None, None, None, None, None),  # a copy
    ]
    df = spark.createDataFrame(data, schema)
    alike = df.groupBy(*df.columns).count().count()
    got = {(r[0], r[1]): r[2:] for r in rows(profile.profile_quality(df))}
    assert got[("duplicate_rows", None)] == (len(data) - alike, 27.3) == (3, 27.3)
    assert rows(profile.profile_quality(df.limit(0)))[0][2] == 0


@pytest.mark.parametrize("most", [100_000, 0])
def test_meeting_hashes_are_confirmed(spark, monkeypatch, most):
    monkeypatch.setattr(profile, "MET_BROADCAST", most)  # by broadcast, and by a join
    monkeypatch.setattr(
        profile, "row_hashes", lambda df: [(F.col("k") % 3).alias("h1"), F.lit(0).cast("long").alias("h2")]
    )
    df = spark.range(100).selectExpr("id DIV 2 AS k", "'x' AS row")
    got = {(r[0], r[1]): r[2:] for r in rows(profile.profile_quality(df))}
    assert got[("duplicate_rows", None)] == (50, 50.0)


def test_rows_without_copies_are_not_moved(spark):
    before = executions(spark)
    df = spark.range(1000).select("id", F.repeat(F.lit("wide"), 100).alias("wide_text"))
    rows(profile.profile_quality(df))
    for plan in (p for k, p in executions(spark).items() if k not in before):
        for line in plan.split("\n"):
            assert not ("hashpartitioning" in line and "wide_text" in line)


def test_categorical_and_correlation(make):
    df = make("c STRING, x DOUBLE, y DOUBLE", [("p", 1.0, 2.0), ("p", 2.0, 4.0), ("q", 3.0, 6.0)])
    assert rows(profile.profile_categorical(df, ["c"], top=1)) == [("c", 2, "p", 2, 66.7)]
    assert rows(profile.profile_corr(df, ["x", "y"])) == [("x", "y", 1.0)]
    assert rows(profile.profile_schema(df.select("c", "x"))) == [
        (1, "c", "string", 3),
        (2, "x", "double", 3),
    ]


def test_findings_read_their_source_once(spark, tmp_path):
    """Twice where rows meet by their hashes."""
    path = str(tmp_path / "source")
    day = F.lit("2024-01-01").cast("date")
    clean = spark.range(400).select(
        "id", (F.col("id") % 7).cast("double").alias("x"),
        F.when(F.col("id") % 9 > 0, F.col("id") % 3).cast("string").alias("g"),
        F.date_add(day, (F.col("id") % 90).cast("int")).alias("t"),
    )
    for df, readings in ((clean, 1), (clean.union(clean.limit(3)), 2)):
        df.write.mode("overwrite").parquet(path)
        before = executions(spark)
        found = profile.profile_findings(spark.read.parquet(path), ["x"], ["g"], "x", ["g"], "t")
        kinds = {r.kind for r in found.collect()}
        assert ("duplicates" in kinds) == (readings == 2)
        ran = [p for k, p in executions(spark).items() if k not in before]
        assert sum(f"file:{path}]" in p for p in ran) == readings  # jobs that read it
        for plan in ran:
            scans = {x for x in plan.split("\n\n") if "Scan parquet" in x and f"file:{path}]" in x}
            assert len(scans) <= 2 and "Expand" not in plan  # of the plan before and after


def test_findings_of_columns_without_values(spark):
    df = spark.createDataFrame([(None, None, None)] * 3, "x DOUBLE, g STRING, t DATE")
    got = by(profile.profile_findings(df, ["x"], ["g"], "x", ["g"], "t"), "kind")
    assert got["nulls"]["value"] == 100.0 and got["duplicates"]["value"] == 2
    assert set(got) == {"nulls", "duplicates"}
    assert rows(profile.profile_findings(df.limit(0), ["x"], ["g"], "x", ["g"], "t")) == []
    assert "weekly_jump" not in by(profile.profile_findings(df, [], []), "kind")


def test_findings_blame_the_flagged_week(make):
    flat = [(f"2024-0{m}-{d:02d}", 10.0, "a") for m in (1, 2) for d in (1, 8, 15, 22)]
    df = make("t DATE, x DOUBLE, g STRING", flat + [("2024-03-04", 100.0, "b")])
    got = by(profile.profile_findings(df, ["x"], ["g"], "x", ["g"], "t"), "kind")
    assert got["weekly_jump"]["detail"] == "flow"  # an empty week came before
    assert got["segment_gap"]["value"] == 10.0
    assert got["outliers"]["value"] == 11.1
    assert got["skew"]["detail"] == "right"
    assert "nulls" not in got and "cardinality" not in got


def test_findings_move_row_hashes_on_their_own(spark):
    """Once, by hash; only counted numbers are put in order."""
    before = executions(spark)
    df = spark.range(1000).selectExpr("id % 7 AS x", "id % 3 AS g", "date_add(DATE'2024-01-01', int(id % 90)) AS t", "id")
    rows(profile.profile_findings(df, ["x"], ["id", "g"], "x", ["g"], "t"))
    dealt = [
        (kind, re.findall(r"(\w+)#", keys))
        for plan in (p for k, p in executions(spark).items() if k not in before)
        for kind, keys in re.findall(r"(hash|range)partitioning\((.*)\)", plan)
    ]
    assert ("hash", ["h1", "h2"]) in dealt
    assert all(keys == ["h1", "h2"] for _, keys in dealt if "h1" in keys)
    assert {tuple(keys) for kind, keys in dealt if kind == "range"} == {("column_name", "x")}


def test_findings_of_columns_with_any_name(make):
    """Also columns in several parts, and limits that all columns meet."""
    df = make(
        "h1 DOUBLE, week DATE, n STRING, kind STRING",
        [(1.0, "2024-01-01", "a", None), (3.0, "2024-01-02", None, None), (5.0, "2024-01-08", "a", "k"),
         (None, "2024-01-09", "b", "k"), (8.0, "2024-01-10", "a", "k"), (8.0, "2024-01-10", "a", "k")],
    )
    limits = {"null_share_pct": 0, "cardinality": 1, "outlier_share_pct": 101, "skew": 9}
    found = profile.profile_findings(df, ["h1"], ["n", "kind"], "h1", ["n", "kind"], "week", limits)
    assert sorted(rows(found), key=str) == [
        ("INFO", "cardinality", "n", 2.0, None),
        ("INFO", "segment_gap", "kind", 3.5, None),
        ("INFO", "segment_gap", "n", 1.8333, None),
        ("WARN", "duplicates", "rows", 1.0, None),
        ("WARN", "nulls", "h1", 16.7, None),
        ("WARN", "nulls", "kind", 33.3, None),
        ("WARN", "nulls", "n", 16.7, None),
        ("WARN", "weekly_jump", "2024-01-14", 425.0, "behaviour"),
    ]
    counted = profile.profile_findings(df, [], [], ts="week", thresholds={"null_share_pct": 50})
    assert sorted(rows(counted), key=str) == [
        ("WARN", "duplicates", "rows", 1.0, None),
        ("WARN", "weekly_jump", "2024-01-14", 100.0, "flow"),
    ]


# ---------------------------------------------------------- sources and sinks


RAW = (
    "Invoice STRING, StockCode STRING, Description STRING, Quantity STRING, "
    "InvoiceDate STRING, Price STRING, Customer STRING, Country STRING"
)


def raw(make, *cells):
    return make(RAW, list(cells)).withColumnRenamed("Customer", "Customer ID")


def test_cleaning_turns_malformed_cells_into_null(make):
    sheet = raw(
        make,
        ("489434", "85048", "BALL", "12", "40148.322916667", "6.95", "13085", "UK"),
        ("C489449", "22087", "BUNTING", "-12.0", "n/a", "", "17850.0", "Australia"),
        ("489435", "x", "y", "many", None, "1e2", None, "UK"),
    )
    got = rows(clean_invoice_lines(sheet))
    assert got[0] == (
        "489434", "85048", 12, datetime(2009, 12, 1, 7, 45, 0, 28), 6.95, 13085, "UK", False,
    )
    assert got[1][2:] == (-12, None, None, 17850, "Australia", True)
    assert got[2][2:6] == (None, None, 100.0, None)


def test_cleaning_ignores_the_session_time_zone(spark, make):
    # 2:30 on the night clocks went forward in New York
    sheet = raw(make, ("1", "a", "", "1", "40250.104166666664", "1", "1", "UK"))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert rows(clean_invoice_lines(sheet))[0][3] == datetime(2010, 3, 13, 2, 30)
        later = raw(make, ("1", "a", "", "1", "40251.104166666664", "1", "1", "UK"))
        assert rows(clean_invoice_lines(later))[0][3] == datetime(2010, 3, 14, 2, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_union_keeps_duplicates(make):
    sheet = raw(make, ("1", "a", "", "1", "40000", "1", "1", "UK"))
    assert union_sheets(sheet, sheet).count() == 2
    with pytest.raises(ValueError):
        union_sheets()


def test_parquet_is_zstd(spark, lines, tmp_path):
    path = str(tmp_path / "lines")
    write_table(lines, path)
    assert sorted(rows(read_table(spark, path)), key=str) == sorted(rows(lines), key=str)
    part = next(Path(path).glob("*.parquet"))
    assert pq.ParquetFile(part).metadata.row_group(0).column(0).compression == "ZSTD"


def test_csv_round_trip_reads_dates(spark, make, tmp_path):
    df = make("m DATE, x DOUBLE, s STRING", [("2024-01-01", 1.5, "a,b"), ("2024-02-01", None, "c")])
    path = str(tmp_path / "mart")
    models.write_mart(df, path, "csv")
    assert sorted(rows(read_table(spark, path, "csv", df.schema))) == sorted(rows(df))
    with pytest.raises(ValueError):
        read_table(spark, path, "csv")


def test_json_writes_nan_as_null(spark, tmp_path):
    df = spark.createDataFrame([("a", float("nan")), ("b", 1.0)], "k STRING, x DOUBLE")
    path = str(tmp_path / "metrics")
    write_table(df.coalesce(1), path, "json")
    text = "".join(p.read_text() for p in Path(path).glob("*.json"))
    assert [json.loads(line).get("x") for line in text.splitlines()] == [None, 1.0]


def test_a_failing_run_leaves_the_old_mart(spark, make, tmp_path):
    path = str(tmp_path / "mart")
    good = make("k BIGINT, x DOUBLE", [(1, 1.0), (2, 2.0)])
    models.write_mart(good, path)
    bad = good.withColumn("x", F.raise_error(F.lit("broken on purpose")).cast("double"))
    with pytest.raises(Exception, match="broken on purpose"):
        models.write_mart(bad, path)
    assert sorted(rows(read_table(spark, path))) == [(1, 1.0), (2, 2.0)]
    # a mart may be built from itself
    models.write_mart(read_table(spark, path).withColumn("x", F.col("x") + 1), path)
    assert sorted(rows(spark.read.parquet(path))) == [(1, 2.0), (2, 3.0)]
    assert [p.name for p in tmp_path.iterdir()] == ["mart"]


def test_models_become_views_and_tables_by_config(spark, make, tmp_path):
    source = {"rows": [(1, 1.0), (2, 2.0)]}
    wanted = {
        "stg_x": lambda s: make("k BIGINT, x DOUBLE", source["rows"]),
        "fct_x": lambda s: s.table("stg_x").agg(F.sum("x").alias("total")),
    }
    config = {"stg": "view", "fct": "table"}

    def kinds():
        return {t.name: t.isTemporary for t in spark.catalog.listTables() if t.name in wanted}

    try:
        built = models.materialise(spark, wanted, config, f"file:{tmp_path}")
        assert kinds() == {"stg_x": True, "fct_x": False}
        assert rows(built["fct_x"]) == [(3.0,)]
        first = list((tmp_path / "fct_x").iterdir())
        source["rows"] = [(1, 5.0)]
        models.materialise(spark, wanted, config, f"file:{tmp_path}")
        assert rows(spark.table("fct_x")) == [(5.0,)]
        (second,) = (tmp_path / "fct_x").iterdir()  # one version stays
        assert second not in first
        broken = {"fct_x": lambda s: s.table("stg_x").select(F.raise_error(F.lit("broken")).alias("total"))}
        with pytest.raises(Exception, match="broken"):
            models.materialise(spark, broken, config, f"file:{tmp_path}")
        assert rows(spark.table("fct_x")) == [(5.0,)] and list((tmp_path / "fct_x").iterdir()) == [second]
        # another schema, and a layer of another kind
        wider = {"fct_x": lambda s: s.table("stg_x")}
        assert rows(models.materialise(spark, wider, config, f"file:{tmp_path}")["fct_x"]) == [(1, 5.0)]
        models.materialise(spark, {"fct_x": wanted["stg_x"]}, {"fct_x": "view"}, f"file:{tmp_path}")
        assert kinds()["fct_x"]
        models.materialise(spark, wanted, {"stg": "view", "fct_x": "table"}, f"file:{tmp_path}")
        assert not kinds()["fct_x"] and rows(spark.table("fct_x")) == [(5.0,)]
    finally:
        for name in wanted:
            spark.catalog.dropTempView(name)
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    with pytest.raises(ValueError):
        models.materialise(spark, wanted, {"stg": "view"}, f"file:{tmp_path}")


def test_mart_can_be_partitioned(spark, make, tmp_path):
    df = make("m DATE, x DOUBLE", [("2024-01-01", 1.0), ("2024-02-01", 2.0)])
    path = str(tmp_path / "mart")
    models.write_mart(df, path, partition_by=["m"])
    assert read_table(spark, path).where(F.col("m") == "2024-02-01").count() == 1


def test_preview_is_a_top_n(spark):
    df = preview(spark.range(100).orderBy(F.desc("id")), 3)
    assert [r[0] for r in rows(df)] == [99, 98, 97]
    assert "TakeOrdered" in df._jdf.queryExecution().executedPlan().toString()


def test_unknown_format_is_refused(spark):
    with pytest.raises(ValueError):
        read_table(spark, "/tmp/x", "xlsx")


def test_staging_adds_the_event_date(make):
    df = make(
        "event_id BIGINT, user_id BIGINT, session_id BIGINT, event_time TIMESTAMP_NTZ, event_name STRING",
        [(1, 1, 1, "2024-01-01 23:59:59", "x")],
    )
    assert str(dicts(models.stg_events(df))[0]["event_date"]) == "2024-01-01"
