"""The analytics tables as views over the given benchmark tables.

Each function takes (spark, folder) and returns the columns an operator expects.
``workload/oracle.py`` defines the same views in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import read_table

# The given tables' columns. Stating them saves the job that
# would read the parquet footers for each table of each query.
SCHEMAS = {
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
    "c_mktsegment STRING",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
    "value DOUBLE, props STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
    "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
    "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, "
    "o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
}

STEPS = ["signup", "view", "click", "purchase"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_table(spark, f"{folder}/{name}.parquet", schema=SCHEMAS[name])


def events(spark, folder) -> DataFrame:
    """One session per user and calendar day."""
    day_no = F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date"))
    return table(spark, folder, "events").select(
        "event_id",
        "user_id",
        (F.col("user_id") * 100000 + day_no).cast("long").alias("session_id"),
        F.col("ts").alias("event_time"),
        F.col("event_type").alias("event_name"),
    )


def nullable_events(spark, folder) -> DataFrame:
    """The same with anonymous and undated events among them."""
    return events(spark, folder).withColumns(
        {
            "user_id": F.when(F.col("event_id") % 97 >= 9, F.col("user_id")),
            "event_time": F.when(F.col("event_id") % 89 >= 5, F.col("event_time")),
        }
    )


def _traits(spark, folder) -> DataFrame:
    key = F.col("c_custkey")
    device = F.when(key % 3 == 0, "ios").when(key % 3 == 1, "android").otherwise("web")
    nation = table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country")
    )
    return (
        table(spark, folder, "customer")
        .join(nation, "c_nationkey")
        .select(
            key.alias("user_id"),
            F.col("c_mktsegment").alias("channel"),
            "country",
            device.alias("device"),
            F.when(key % 2 == 0, "control").otherwise("treatment").alias("ab_variant"),
        )
    )


def signups(spark, folder) -> DataFrame:
    """Event users and the day of their first signup event."""
    return (
        table(spark, folder, "events")
        .where(F.col("event_type") == "signup")
        .groupBy("user_id")
        .agg(F.min(F.to_date("ts")).alias("signup_date"))
    )


def users(spark, folder) -> DataFrame:
    """Signed-up event users with their traits."""
    return signups(spark, folder).join(_traits(spark, folder), "user_id").select(
        "user_id", "signup_date", "channel", "country", "device", "ab_variant"
    )


def buyers(spark, folder) -> DataFrame:
    """Ordering customers, signed up on the day of their first order of any status."""
    return (
        table(spark, folder, "orders")
        .groupBy(F.col("o_custkey").alias("user_id"))
        .agg(F.min(F.to_date("o_orderdate")).alias("signup_date"))
    )


def customers(spark, folder) -> DataFrame:
    """Ordering customers with their traits."""
    return buyers(spark, folder).join(_traits(spark, folder), "user_id").select(
        "user_id", "signup_date", "channel", "country", "device", "ab_variant"
    )


def all_orders(spark, folder) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("order_ts"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderpriority").alias("product_category"),
        F.col("o_orderstatus").alias("status"),
    )


def orders(spark, folder) -> DataFrame:
    """Finished orders; some customers have none."""
    return all_orders(spark, folder).where(F.col("status") == "F").drop("status")


def subs(spark, folder) -> DataFrame:
    """At most one subscription per customer: the first urgent order."""
    urgent = all_orders(spark, folder).where(F.col("product_category") == "1-URGENT")
    return (
        urgent.groupBy("user_id")
        .agg(
            F.min_by(
                F.struct("order_id", "order_ts", "amount"),
                F.struct("order_ts", "order_id"),
            ).alias("first")
        )
        .select(
            F.col("first.order_id").alias("sub_id"),
            "user_id",
            F.col("first.order_ts").alias("started_at"),
            F.when(F.col("first.order_id") % 4 == 0, "annual")
            .otherwise("monthly")
            .alias("plan"),
            F.col("first.amount").alias("amount"),
        )
    )


def cancels(spark, folder) -> DataFrame:
    """The last returned shipment of a subscription's order, if after its start."""
    returned = (
        table(spark, folder, "lineitem")
        .where(F.col("l_returnflag") == "R")
        .groupBy(F.col("l_orderkey").alias("sub_id"))
        .agg(F.max("l_shipdate").alias("cancelled_at"))
    )
    return (
        subs(spark, folder)
        .join(returned, "sub_id")
        .where(F.col("cancelled_at") > F.col("started_at"))
        .select("sub_id", "cancelled_at")
    )


def refunds(spark, folder) -> DataFrame:
    """An order is refunded in full when all its lines came back, by half when
    most of them did."""
    back = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("order_id"))
        .agg(
            F.count_if(F.col("l_returnflag") == "R").alias("back"),
            F.count(F.lit(1)).alias("lines"),
        )
        .where("2 * back > lines")
    )
    price = F.col("amount")
    return (
        all_orders(spark, folder)
        .join(back, "order_id")
        .select(
            F.col("order_id").alias("refund_id"),
            "order_id",
            F.date_add(F.to_date("order_ts"), 10).alias("refunded_at"),
            F.when(F.col("back") == F.col("lines"), price)
            .otherwise(F.floor(price * 50.0) / 100.0)
            .alias("amount"),
        )
    )


def _priced_lines(spark, folder, country: bool = True) -> DataFrame:
    placed = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate"
    )
    if country:
        # the smaller join first: customers meet orders, not lines
        traits = _traits(spark, folder).select(
            F.col("user_id").alias("o_custkey"), "country"
        )
        placed = placed.join(traits, "o_custkey")
    return (
        table(spark, folder, "lineitem")
        .select(
            "l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
            "l_extendedprice", "l_returnflag",
        )
        .join(placed, "l_orderkey")
    )


def lines(spark, folder, country: bool = True) -> DataFrame:
    """Invoice lines; returned ones are cancellations, every fifth customer is
    a guest. Without ``country`` only lines and orders are read."""
    back = F.col("l_returnflag") == "R"
    units = F.col("l_quantity").cast("int")
    place = ["country"] if country else []
    return _priced_lines(spark, folder, country).select(
        F.concat(F.when(back, "C").otherwise(""), F.col("l_orderkey").cast("string")).alias(
            "invoice"
        ),
        F.col("l_partkey").cast("string").alias("stock_code"),
        F.when(back, -units).otherwise(units).alias("quantity"),
        F.col("o_orderdate").alias("invoice_ts"),
        F.col("l_extendedprice").alias("price"),
        F.when(F.col("o_custkey") % 5 != 0, F.col("o_custkey")).alias("customer_id"),
        *place,
        back.alias("is_cancellation"),
    )


def raw_lines(spark, folder) -> DataFrame:
    """The same lines as a text sheet with serial dates and malformed cells."""
    back = F.col("l_returnflag") == "R"
    key = F.col("l_orderkey")
    units = F.col("l_quantity").cast("int")
    serial = F.datediff(F.to_date("o_orderdate"), F.lit("1970-01-01").cast("date")) + 25569
    fraction = F.lpad((F.col("l_linenumber") * 123456789 % 1000000000).cast("string"), 9, "0")
    return _priced_lines(spark, folder).select(
        F.concat(F.when(back, "C").otherwise(""), key.cast("string")).alias("Invoice"),
        F.col("l_partkey").cast("string").alias("StockCode"),
        F.concat(F.lit("PART "), F.col("l_partkey").cast("string")).alias("Description"),
        F.when(key % 97 == 0, "n/a")
        .otherwise(F.when(back, -units).otherwise(units).cast("string"))
        .alias("Quantity"),
        F.when(key % 103 == 0, "yesterday")
        .otherwise(F.concat(serial.cast("string"), F.lit("."), fraction))
        .alias("InvoiceDate"),
        F.when(key % 101 == 0, "")
        .otherwise(F.col("l_extendedprice").cast("decimal(18,2)").cast("string"))
        .alias("Price"),
        F.when(key % 107 == 0, "x")
        .when(F.col("o_custkey") % 5 != 0, F.col("o_custkey").cast("string"))
        .alias("Customer ID"),
        F.col("country").alias("Country"),
    )


def log(spark, folder) -> DataFrame:
    """An application log in text: arm flags and outcomes in mixed spelling."""
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    flag = (
        F.when(key % 6 == 0, "true")
        .when(key % 6 == 2, "YES")
        .when(key % 6 == 4, " 1 ")
        .when(key % 6 == 1, "false")
        .when(key % 6 == 3, "no")
        .otherwise("0")
    )
    outcome = (
        F.when(status == "O", "")
        .when((status == "F") & (key % 4 == 0), "offer")
        .when(status == "F", "Interview ")
        .otherwise("none")
    )
    return table(spark, folder, "orders").select(
        F.to_date("o_orderdate").cast("string").alias("date"),
        F.col("o_orderpriority").alias("segment"),
        flag.alias("link_used"),
        outcome.alias("outcome"),
    )
