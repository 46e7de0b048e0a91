"""Cutting lineage through reliable shared storage.

Ranking and exact quantiles read one range-partitioned frame several times and
need every reading to see the same partition borders, also after an executor
is lost. The frame is therefore written to the shared folder the cluster names
in ``spark.checkpoint.dir``. Results are lazy and read these tables, so a caller
who is done with them calls :func:`release`.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
_written: list[str] = []


def checkpoint_root(spark: SparkSession) -> str:
    """The folder the session names; settings are read, never changed."""
    named = spark.conf.get(SETTING, None)
    if not named:
        raise RuntimeError(f"set {SETTING} to a folder that every executor can reach")
    return named


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for a written table, next to the checkpoints."""
    path = f"{checkpoint_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def release(spark: SparkSession, *paths: str) -> int:
    """Delete the tables written so far by this process, or those at ``paths`` only.

    Returns how many there were. Frames that read them cannot be computed any more.
    """
    gone = [p for p in _written if p in paths] if paths else list(_written)
    count = len(gone)
    for path in gone:
        _written.remove(path)
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        files.delete(where, True)
    return count


def written() -> list[str]:
    """The tables of this process that are not released, oldest first."""
    return list(_written)


def durable(df: DataFrame) -> DataFrame:
    """``df`` written once as a table in the checkpoint folder, and read back.

    Unlike an RDD checkpoint the table is compressed and columnar, so the
    readings that follow prune columns and skip row groups.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
