"""CSV and JSON as others write and read them."""

import csv
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.sources import read_table, write_table

CELLS = ['x "q" y', "a,b", "line\nbreak", "", None, "  padded ", "'", '"', "\\", "ü"]


def test_text_comes_back_from_csv(spark, tmp_path):
    df = spark.createDataFrame(list(enumerate(CELLS)), "id BIGINT, t STRING")
    write_table(df, str(tmp_path / "t"), "csv")
    got = read_table(spark, str(tmp_path / "t"), "csv", df.schema, multi_line=True)
    assert sorted(rows(got)) == list(enumerate(CELLS))


def test_other_readers_take_our_csv(spark, tmp_path):
    df = spark.createDataFrame(list(enumerate(CELLS)), "id BIGINT, t STRING").coalesce(1)
    write_table(df, str(tmp_path / "t"), "csv")
    file = next(Path(tmp_path / "t").glob("part-*"))
    with file.open(newline="") as f:
        got = [(int(r["id"]), r["t"]) for r in csv.DictReader(f)]
    assert sorted(got) == [(i, c or "") for i, c in enumerate(CELLS)]


def test_columns_go_by_the_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text('b,extra,a\n"two ""2""",x,1\n,y,3\n')
    got = read_table(spark, str(tmp_path), "csv", "a INT, b STRING")
    assert rows(got) == [(1, 'two "2"'), (3, None)]
    with pytest.raises(ValueError, match="no columns"):
        read_table(spark, str(tmp_path), "csv", "a INT, c STRING")


def test_files_with_different_headers_fail(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,x\n")
    (tmp_path / "b.csv").write_text("b,a\ny,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        rows(read_table(spark, str(tmp_path), "csv", "a INT, b STRING"))


def test_bad_records_fail(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\nseven,x\n")
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST|cannot"):
        rows(read_table(spark, str(tmp_path), "csv", "a INT, b STRING"))


def test_json_has_neither_nan_nor_infinity(spark, tmp_path):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame(
        [(1, nan, [1.0, inf], {"k": -inf}, (nan, "x")), (2, 2.5, None, None, None)],
        "id INT, x DOUBLE, a ARRAY<DOUBLE>, m MAP<STRING, FLOAT>, s STRUCT<y: DOUBLE, z: STRING>",
    )
    write_table(df.coalesce(1), str(tmp_path / "j"), "json")
    text = next(Path(tmp_path / "j").glob("part-*")).read_text()

    def reject(word):
        raise AssertionError(word)

    first, second = (json.loads(line, parse_constant=reject) for line in text.splitlines())
    assert first == {"id": 1, "a": [1.0, None], "m": {"k": None}, "s": {"z": "x"}}
    assert second == {"id": 2, "x": 2.5}
    back = read_table(spark, str(tmp_path / "j"), "json", df.schema)
    assert back.where(F.col("x").isNull()).count() == 1
