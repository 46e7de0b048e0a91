"""Run queries next to their SQL twins: python -m workload.check FOLDER [NAME...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from workload.oracle import oracle_sql
from workload.suite import QUERIES


def open_oracle(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _plain(value):
    if value is None or value != value:
        return None
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def normalised(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(
        ([_plain(row[i]) for i in order] for row in rows), key=lambda r: [str(v) for v in r]
    )


def compare(df, con, name: str):
    """None when the results agree, else a description of the first difference."""
    got = normalised(df.columns, [tuple(r) for r in df.collect()])
    con.execute(oracle_sql()[name])
    columns = [c[0] for c in con.description]
    want = normalised(columns, con.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} != {len(want[1])}"
    for g, w in zip(got[1], want[1]):
        if g != w:
            return f"{got[0]}\n   spark {g}\n   sql   {w}"
    types = {type(v) for row in got[1] + want[1] for v in row}
    if any(t.__name__ == "Decimal" for t in types):
        return "a decimal column; results must be double or bigint"
    if not got[1]:
        return "EMPTY"
    return None


def session(cpus: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidemark")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(folder: str, names: list[str]) -> int:
    spark, con = session(), open_oracle(folder)
    bad = 0
    for name in names or list(QUERIES):
        begun = time.time()
        try:
            problem = compare(QUERIES[name](spark, folder), con, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok':4} {name} {time.time() - begun:.2f}s", problem or "")
    missing = QUERIES.keys() ^ oracle_sql().keys()
    print(f"{bad} of {len(names or QUERIES)} differ; without a twin: {sorted(missing)}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
