"""Cleaning raw invoice sheets into the invoice-line table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: spreadsheet serial day of 1970-01-01.
SERIAL_DAY_OF_EPOCH = 25569
SECONDS_PER_DAY = 86400


def union_sheets(*sheets: DataFrame) -> DataFrame:
    """All rows of sheets with the same columns, duplicates kept."""
    if not sheets:
        raise ValueError("no sheets given")
    return reduce(lambda a, b: a.unionByName(b), sheets)


def _whole(cell: str, kind: str) -> Column:
    """A cell as a whole number; NULL when malformed. Spreadsheets also write 12
    as 12.0; halves go to the even neighbour."""
    number = F.col(cell).try_cast("double")
    return F.coalesce(F.col(cell).try_cast(kind), F.rint(number).try_cast(kind))


def _serial_timestamp(cell: str) -> Column:
    """Spreadsheet serial day as a zone-less UTC timestamp, to the nearest
    microsecond (a tie goes to the even one)."""
    seconds = (F.col(cell).try_cast("double") - SERIAL_DAY_OF_EPOCH) * SECONDS_PER_DAY
    micros = F.rint(seconds * 1e6).cast("long")
    # plain arithmetic on the zone-less clock: the session time zone plays no part
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.expr("INTERVAL '0.000001' SECOND") * micros


def clean_invoice_lines(raw: DataFrame) -> DataFrame:
    """All-text invoice sheets as typed lines.

    A malformed cell becomes NULL instead of failing the job, the description
    is dropped, and an invoice number starting with C marks a cancellation.
    """
    return raw.select(
        F.col("Invoice").alias("invoice"),
        F.col("StockCode").alias("stock_code"),
        _whole("Quantity", "int").alias("quantity"),
        _serial_timestamp("InvoiceDate").alias("invoice_ts"),
        F.col("Price").try_cast("double").alias("price"),
        _whole("Customer ID", "bigint").alias("customer_id"),
        F.col("Country").alias("country"),
        F.col("Invoice").startswith("C").alias("is_cancellation"),
    )


def clean_purchases(lines: DataFrame) -> DataFrame:
    """Lines that are purchases of a known customer."""
    return lines.where(
        F.col("customer_id").isNotNull()
        & ~F.col("is_cancellation")
        & (F.col("quantity") > 0)
        & (F.col("price") > 0)
    )
