"""Invoice lines: repeat customers, concentration, cancellations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import percent, round_to, total_units, units
from tidemark.sources.invoices import clean_purchases


def line_units() -> Column:
    """Quantity times unit price in ten-thousandths; unit prices may have more
    than two decimals."""
    return F.col("quantity").cast("long") * units("price", 4)


def line_total(kept: Column | None = None) -> Column:
    """Exact sum of line values, of the ``kept`` lines if given."""
    value = line_units() if kept is None else F.when(kept, line_units()).otherwise(0)
    return total_units(value, 4)


def customer_revenue(lines: DataFrame) -> DataFrame:
    """Purchase lines folded to invoices, then to customers."""
    invoices = (
        clean_purchases(lines)
        .groupBy("customer_id", "invoice")
        .agg(line_total().alias("revenue"))
    )
    return invoices.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("revenue").alias("revenue")
    )


def repeat_concentration(lines: DataFrame) -> DataFrame:
    """Share of customers and of revenue by number of orders."""
    n = F.col("orders")
    bucket = (
        F.when(n == 1, "1")
        .when(n == 2, "2")
        .when(n <= 5, "3-5")
        .when(n <= 10, "6-10")
        .otherwise("11+")
    )
    everything = Window.partitionBy()  # five buckets
    return (
        customer_revenue(lines)
        .groupBy(bucket.alias("bucket"))
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.sum("revenue").alias("total"),
            F.min("orders").alias("_first"),
        )
        .withColumns(
            {
                "_customers": F.sum("customers").over(everything),
                "_total": F.sum("total").over(everything),
            }
        )
        .orderBy("_first")
        .select(
            "bucket",
            "customers",
            percent("customers", "_customers", 2).alias("customer_share_pct"),
            round_to("total", 0).alias("revenue"),
            percent("total", "_total", 2).alias("revenue_share_pct"),
        )
    )


def retail_overview(lines: DataFrame) -> DataFrame:
    return lines.agg(
        F.count(F.lit(1)).alias("lines"),
        F.min("invoice_ts").alias("min_ts"),
        F.max("invoice_ts").alias("max_ts"),
        F.count_if("is_cancellation").alias("cancellations"),
        F.count_if(F.col("customer_id").isNull()).alias("guest_lines"),
    )


def customer_repeat(lines: DataFrame) -> DataFrame:
    customers = F.count(F.lit(1))
    repeat = F.count_if(F.col("orders") >= 2)
    return customer_revenue(lines).agg(
        customers.alias("customers"),
        repeat.alias("repeat_customers"),
        percent(repeat, customers, 2).alias("repeat_pct"),
        round_to(F.sum("revenue"), 0).alias("revenue"),
    )


def cancel_revenue(lines: DataFrame) -> DataFrame:
    """Value of cancelled lines against all other lines."""
    off = line_total(F.col("is_cancellation"))
    on = line_total(~F.col("is_cancellation"))
    return lines.agg(
        round_to(off, 0).alias("cancel_revenue"), round_to(on, 0).alias("gross_revenue")
    )
