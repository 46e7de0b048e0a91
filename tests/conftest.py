import sys
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make(spark):
    """make("user_id BIGINT, d DATE", [(1, "2024-01-01")]) with text dates."""

    def build(schema, rows):
        fields = [f.strip().split() for f in schema.split(",")]
        kinds = [kind.upper() for _, kind in fields]

        def cell(value, kind):
            if value is None:
                return None
            if kind == "DATE":
                return date.fromisoformat(value)
            if kind == "TIMESTAMP_NTZ":
                return datetime.fromisoformat(value)
            return value

        data = [tuple(cell(v, k) for v, k in zip(row, kinds)) for row in rows]
        return spark.createDataFrame(data, schema)

    return build


def rows(df):
    return [tuple(r) for r in df.collect()]


def dicts(df):
    return [r.asDict() for r in df.collect()]


def by(df, key):
    return {r[key]: r.asDict() for r in df.collect()}
