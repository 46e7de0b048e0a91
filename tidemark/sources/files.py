"""Parquet, CSV and JSON in and out."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FORMATS = ("parquet", "csv", "json")

# quotes are doubled inside quoted cells, and blanks belong to their cell
_CSV = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
# what an empty cell without quotes is read as; "" with quotes is the empty text
_NO_CELL = "\x00"


def read_table(
    spark: SparkSession,
    path: str,
    format: str = "parquet",
    schema: T.StructType | str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """A table from files. CSV and JSON need a schema: inferring one would scan
    the data an extra time and guess dates. A CSV cell that is a single NUL character
    is read as NULL.

    CSV columns are found by the header's names, whatever their order; an empty cell
    is NULL and a quoted empty one the empty text; a record that does not fit the
    schema fails the query. ``multi_line`` allows line breaks inside quoted cells, at
    the price that a file is read by one task.
    """
    if format not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}, not {format!r}")
    if format != "parquet" and schema is None:
        raise ValueError(f"reading {format} needs a schema")
    if format == "csv":
        return _read_csv(spark, path, schema, multi_line)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.format(format).load(path)


def _read_csv(spark: SparkSession, path: str, schema, multi_line: bool) -> DataFrame:
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    options = {**_CSV, "multiLine": str(multi_line).lower()}
    header = spark.read.options(**options).csv(path).columns
    missing = [f.name for f in schema if f.name not in header]
    if missing:
        raise ValueError(f"no columns {missing} in the header of {path}: {header}")
    kinds = {f.name: f.dataType for f in schema}
    in_file = T.StructType([T.StructField(c, kinds.get(c, T.StringType())) for c in header])
    return (
        # every file must have this header
        spark.read.options(**options, nullValue=_NO_CELL, mode="FAILFAST", enforceSchema="false")
        .schema(in_file)
        .csv(path)
        .select(*(f.name for f in schema))
    )


def _without_nan(value: Column, kind: T.DataType) -> Column:
    """NaN and infinite numbers as NULL, at any depth."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _without_nan(x, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform_values(value, lambda k, x: _without_nan(x, kind.valueType))
    if isinstance(kind, T.StructType):
        fields = [_without_nan(value[f.name], f.dataType).alias(f.name) for f in kind]
        return F.when(value.isNotNull(), F.struct(*fields))
    return value


def write_table(
    df: DataFrame,
    path: str,
    format: str = "parquet",
    partition_by: list[str] | None = None,
    mode: str = "overwrite",
) -> None:
    """Write a table: parquet with zstd, CSV with a header, or JSON lines.

    JSON has no NaN and no infinity; they are written as null there, nested or not.
    """
    if format not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}, not {format!r}")
    if format == "json":
        df = df.select(
            *[_without_nan(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields]
        )
    writer = df.write.mode(mode)
    if format == "parquet":
        writer = writer.option("compression", "zstd")
    if format == "csv":
        writer = writer.options(**_CSV)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.format(format).save(path)


def replace_table(
    df: DataFrame, path: str, format: str = "parquet", partition_by: list[str] | None = None
) -> None:
    """Write a table beside ``path`` and put it in its place when it is whole.

    A write that fails leaves the old table as it was, and ``df`` may read it. Two renames
    separate old and new; on file systems whose renames copy they are not instant.
    """
    spark = df.sparkSession
    mark = uuid.uuid4().hex
    fresh, old = f"{path.rstrip('/')}.new-{mark}", f"{path.rstrip('/')}.old-{mark}"
    try:
        write_table(df, fresh, format, partition_by)
        files, (target, new, kept) = _hadoop(spark, path, fresh, old)
        had = files.exists(target)
        if had and not files.rename(target, kept):
            raise OSError(f"cannot move {path} away")
        if not files.rename(new, target):
            if had:
                files.rename(kept, target)
            raise OSError(f"cannot move {fresh} to {path}")
    except BaseException:
        remove(spark, fresh)
        raise
    remove(spark, old)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder if it is there."""
    files, (target,) = _hadoop(spark, path)
    files.delete(target, True)


def _hadoop(spark: SparkSession, *paths: str):
    """The file system of the first path, and all of them as its paths."""
    named = [spark._jvm.org.apache.hadoop.fs.Path(p) for p in paths]
    return named[0].getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), named


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` rows; on a sorted frame Spark plans a distributed top-n."""
    return df.limit(n)
