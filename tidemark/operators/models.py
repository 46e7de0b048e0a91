"""Staging views and marts, by path and by name in the catalog."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import day
from tidemark.operators.funnel import funnel
from tidemark.operators.retention import nday_retention
from tidemark.operators.subscriptions import mrr
from tidemark.sources.files import remove, replace_table, write_table


def stg_users(raw: DataFrame) -> DataFrame:
    return raw.select(
        "user_id", "signup_date", "channel", "country", "device", "ab_variant"
    )


def stg_events(raw: DataFrame) -> DataFrame:
    return raw.select(
        "event_id",
        "user_id",
        "session_id",
        "event_time",
        day("event_time").alias("event_date"),
        "event_name",
    )


def stg_subscriptions(raw: DataFrame) -> DataFrame:
    return raw.select("sub_id", "user_id", "started_at", "plan", F.col("amount"))


def fct_funnel(events: DataFrame, steps: list[str]) -> DataFrame:
    return funnel(events, steps)


def fct_retention(
    users: DataFrame, events: DataFrame, days=(1, 7, 30), grain: str = "month"
) -> DataFrame:
    return nday_retention(users, events, days, grain, ts="event_date")


def fct_mrr(subscriptions: DataFrame, end_month: str) -> DataFrame:
    return mrr(subscriptions, end_month)


def write_mart(
    mart: DataFrame, path: str, format: str = "parquet", partition_by=None
) -> None:
    """Materialise a mart as files. A run that fails leaves the old mart in place."""
    replace_table(mart, path, format, partition_by)


KINDS = ("view", "table")


def materialise(
    spark: SparkSession,
    models: dict[str, Callable[[SparkSession], DataFrame]],
    config: dict[str, str],
    folder: str,
) -> dict[str, DataFrame]:
    """Build models in their order and register each by name, as its config says.

    ``config`` gives ``view`` or ``table`` for a model or for a layer, the part of its
    name before the first underscore. A model is a function of the session, and finds
    those before it by name. A view is a temporary one. A table is written as Parquet to a
    folder of its own below ``folder``; only then the catalog's table is pointed to it, so
    a run that fails leaves the old one, and the old files go last.
    """
    kinds = {name: config.get(name, config.get(name.split("_")[0])) for name in models}
    if wrong := {name: kind for name, kind in kinds.items() if kind not in KINDS}:
        raise ValueError(f"neither {' nor '.join(KINDS)}: {wrong}")
    for name, build in models.items():
        df = build(spark)
        if kinds[name] == "view":
            spark.sql(f"DROP TABLE IF EXISTS {name}") if _is_table(spark, name) else None
            df.createOrReplaceTempView(name)
        else:
            _put_table(spark, name, df, f"{folder.rstrip('/')}/{name}")
    return {name: spark.table(name) for name in models}


def _is_table(spark: SparkSession, name: str) -> bool:
    return any(t.name == name and not t.isTemporary for t in spark.catalog.listTables(pattern=name))


def _put_table(spark: SparkSession, name: str, df: DataFrame, folder: str) -> None:
    fresh = f"{folder}/{uuid.uuid4().hex}"
    try:
        write_table(df, fresh)
    except BaseException:
        remove(spark, fresh)
        raise
    spark.catalog.dropTempView(name)  # it would hide the table
    old = None
    if _is_table(spark, name):
        detail = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
        old = detail["Location"]
        if spark.table(name).schema == spark.read.parquet(fresh).schema:
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{fresh}'")
            spark.catalog.refreshTable(name)
        else:  # other columns need another entry
            spark.sql(f"DROP TABLE {name}")
    if not _is_table(spark, name):
        spark.catalog.createTable(name, path=fresh, source="parquet")
    if old:
        remove(spark, old)
