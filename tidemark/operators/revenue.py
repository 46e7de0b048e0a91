"""Revenue by day, month, cohort, channel and category."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import (
    as_double,
    day,
    month_of,
    percent,
    period_gap,
    period_of,
    round_to,
    total_money,
    units,
)
from tidemark.plans import exact_quantiles, null_safe_join, value_counts


def revenue_per_user(
    orders: DataFrame, user: str = "user_id", amount: str = "amount"
) -> DataFrame:
    """Orders folded to one exact decimal total per buyer."""
    return orders.groupBy(F.col(user).alias("user_id")).agg(
        total_money(amount).alias("revenue")
    )


def ltv_by_cohort(
    users: DataFrame,
    orders: DataFrame,
    grain: str = "month",
    user: str = "user_id",
    signup: str = "signup_date",
    amount: str = "amount",
) -> DataFrame:
    """Lifetime revenue and revenue per user by signup cohort; users without
    orders count with zero."""
    base = users.select(
        F.col(user).alias("user_id"), period_of(signup, grain).alias("cohort")
    )
    return (
        base.join(revenue_per_user(orders, user, amount), "user_id", "left")
        .groupBy("cohort")
        .agg(
            F.count(F.lit(1)).alias("users"),
            as_double(F.coalesce(F.sum("revenue"), F.lit(0))).alias("total"),
        )
        .select(
            "cohort",
            "users",
            round_to("total", 2).alias("revenue"),
            round_to(F.col("total") / F.col("users"), 2).alias("ltv_per_user"),
        )
        .orderBy("cohort")
    )


def top_n_per_group(
    totals: DataFrame, group: str, item: str, measure: str = "revenue", n: int = 3
) -> DataFrame:
    """The ``n`` rows of each group with the largest measure, ranked 1..n.

    Ties are broken by the item. Spark keeps only ``n`` rows per group and map
    task before the shuffle, so a group holding most rows stays cheap.
    """
    best = Window.partitionBy(group).orderBy(F.desc(measure), item)
    return (
        totals.withColumn("rnk", F.row_number().over(best).cast("long"))
        .where(F.col("rnk") <= n)
        .select(group, item, round_to(measure, 2).alias(measure), "rnk")
        .orderBy(group, "rnk")
    )


def category_revenue_by_dimension(
    users: DataFrame,
    orders: DataFrame,
    dimension: str = "country",
    category: str = "product_category",
    user: str = "user_id",
    amount: str = "amount",
) -> DataFrame:
    """Revenue per (user dimension, order category), summed per user first."""
    spent = orders.groupBy(user, category).agg(total_money(amount).alias("revenue"))
    return (
        spent.join(users.select(user, dimension), user)
        .groupBy(dimension, category)
        .agg(F.sum("revenue").alias("revenue"))
    )


def top_categories(
    users: DataFrame,
    orders: DataFrame,
    n: int = 3,
    dimension: str = "country",
    category: str = "product_category",
) -> DataFrame:
    totals = category_revenue_by_dimension(users, orders, dimension, category)
    return top_n_per_group(totals, dimension, category, "revenue", n)


def top_users(
    users: DataFrame,
    orders: DataFrame,
    n: int = 2,
    dimension: str = "country",
    user: str = "user_id",
) -> DataFrame:
    """Highest-revenue users of each group; users without orders count as zero."""
    totals = (
        users.select(user, dimension)
        .join(revenue_per_user(orders, user), user, "left")
        .select(
            dimension,
            user,
            F.coalesce("revenue", F.lit(Decimal("0.00"))).alias("revenue"),
        )
    )
    return top_n_per_group(totals, dimension, user, "revenue", n)


def daily_revenue(
    orders: DataFrame,
    ts: str = "order_ts",
    amount: str = "amount",
    by: list[str] | None = None,
) -> DataFrame:
    return orders.groupBy(*(by or []), day(ts).alias("d")).agg(
        total_money(amount).alias("revenue")
    )


def running_total(
    orders: DataFrame,
    ts: str = "order_ts",
    amount: str = "amount",
    by: list[str] | None = None,
) -> DataFrame:
    """Daily revenue and its cumulative sum (window over one row per day, for each
    group ``by``)."""
    by = by or []
    upto = (
        Window.partitionBy(*by)
        .orderBy("d")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        daily_revenue(orders, ts, amount, by)
        .select(
            *by,
            "d",
            round_to("revenue", 2).alias("daily_revenue"),
            round_to(F.sum("revenue").over(upto), 2).alias("cumulative"),
        )
        .orderBy(*by, "d")
    )


def attribution(
    users: DataFrame,
    orders: DataFrame,
    by: str = "channel",
    user: str = "user_id",
    ts: str = "order_ts",
    order_id: str = "order_id",
    amount: str = "amount",
) -> DataFrame:
    """Lifetime against first-order revenue per channel.

    Both come from one aggregation per user; the earliest order is the one with
    the smallest (time, order id). Users without orders contribute nothing.
    """
    per_user = orders.groupBy(user).agg(
        total_money(amount).alias("lifetime"),
        F.min_by(amount, F.struct(ts, order_id)).alias("first"),
    )
    return (
        users.select(user, by)
        .join(per_user, user, "left")
        .groupBy(by)
        .agg(
            round_to(F.sum("lifetime"), 2).alias("lifetime_revenue"),
            round_to(total_money("first"), 2).alias("first_touch_revenue"),
        )
        .orderBy(F.desc_nulls_last("lifetime_revenue"), by)
    )


def _listed(column: str, values: list | None) -> Column:
    """The column; a value that a pivot's list lacks fails the query."""
    if not values:
        return F.col(column)
    known = F.col(column).isin(*values)
    failed = F.raise_error(
        F.concat(F.lit(f"{column} not listed: "), F.coalesce(F.col(column).cast("string"), F.lit("NULL")))
    )
    return F.when(known, F.col(column)).otherwise(failed.cast("string")).alias(column)


def pivot_revenue(
    orders: DataFrame,
    values: list[str] | None = None,
    category: str = "product_category",
    ts: str = "order_ts",
    amount: str = "amount",
) -> DataFrame:
    """Month by category revenue; NULL where a category sold nothing.

    Without ``values`` Spark runs one extra job to find the categories; with them a
    category not listed fails the query.
    """
    per_month = orders.select(
        month_of(ts).alias("month"),
        _listed(category, values),
        units(amount).cast("decimal(20,0)").alias("_cents"),
    ).groupBy("month")
    wide = (
        per_month.pivot(category, values) if values else per_month.pivot(category)
    ).agg(F.sum("_cents"))
    return wide.select(
        "month",
        *[(as_double(F.col(f"`{c}`")) / 100.0).alias(c) for c in wide.columns[1:]],
    ).orderBy("month")


def distribution(
    orders: DataFrame,
    by: str = "product_category",
    amount: str = "amount",
    probs: dict[str, float] | None = None,
    approximate: int | None = None,
    slices: int | None = None,
) -> DataFrame:
    """Count, interpolated quantiles and total per category.

    Quantiles are exact. ``approximate`` asks for a sketch instead, with a rank
    error of one in that many rows, in a single pass over the orders.
    """
    probs = probs or {"median_amount": 0.5, "p90": 0.9, "p99": 0.99}
    if approximate:
        sketch = F.percentile_approx(amount, list(probs.values()), approximate)
        return (
            orders.where(F.col(amount).isNotNull())
            .groupBy(by)
            .agg(
                F.count(F.lit(1)).alias("orders"),
                sketch.alias("_q"),
                round_to(total_money(amount), 2).alias("total_revenue"),
            )
            .select(
                by,
                "orders",
                *[round_to(F.col("_q")[i], 2).alias(n) for i, n in enumerate(probs)],
                "total_revenue",
            )
            .orderBy(F.desc("total_revenue"), by)
        )
    counts = value_counts(orders, [by], amount, slices)
    totals = counts.groupBy(by).agg(
        # as decimals: a frequent value times its count may exceed a long
        (
            F.sum(
                F.col("n").cast("decimal(18,0)") * units(amount).cast("decimal(18,0)")
            )
            * Decimal("0.01")
        ).alias("total")
    )
    quantiles = exact_quantiles(counts, [by], amount, probs)
    return (
        null_safe_join(quantiles, totals, [by])
        .select(
            by,
            F.col("n").alias("orders"),
            *[round_to(name, 2).alias(name) for name in probs],
            round_to("total", 2).alias("total_revenue"),
        )
        .orderBy(F.desc("total_revenue"), by)
    )


def revenue_triangle(
    users: DataFrame,
    orders: DataFrame,
    grain: str = "month",
    user: str = "user_id",
    signup: str = "signup_date",
    ts: str = "order_ts",
    amount: str = "amount",
) -> DataFrame:
    """Revenue by signup cohort and periods since signup.

    Revenue is rounded to cents before it is indexed to period 0 and cumulated.
    Cohorts without any revenue in period 0 have no index and are left out. LTV
    divides by the whole cohort, buyers or not.
    """
    cohorts = users.select(
        F.col(user).alias("user_id"), period_of(signup, grain).alias("cohort")
    )
    sizes = cohorts.groupBy("cohort").agg(F.count(F.lit(1)).alias("cohort_users"))
    spent = orders.groupBy(
        F.col(user).alias("user_id"), period_of(ts, grain).alias("paid_in")
    ).agg(total_money(amount).alias("amt"))
    cells = (
        spent.join(cohorts, "user_id")
        .withColumn("period", period_gap("cohort", "paid_in", grain))
        .groupBy("cohort", "period")
        .agg(
            # spent has one row per user and period
            F.count(F.lit(1)).alias("paying_users"),
            round_to(F.sum("amt"), 2).alias("revenue"),
        )
    )
    cohort = Window.partitionBy("cohort")
    upto = cohort.orderBy("period").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    start = F.max(F.when(F.col("period") == 0, F.col("revenue"))).over(cohort)
    return (
        cells.withColumns(
            {
                "_start": start,
                "cum_revenue": round_to(
                    F.sum(F.col("revenue").cast("decimal(28,2)")).over(upto), 2
                ),
            }
        )
        .where(F.col("_start").isNotNull())
        .join(sizes, "cohort")
        .select(
            "cohort",
            "period",
            "paying_users",
            "revenue",
            percent("revenue", "_start", 1).alias("pct_of_period0"),
            "cum_revenue",
            round_to(F.col("cum_revenue") / F.col("cohort_users"), 2).alias(
                "ltv_per_user"
            ),
        )
        .orderBy("cohort", "period")
    )


def triangle_matrix(triangle: DataFrame, periods: list[int] | None = None) -> DataFrame:
    """The triangle as a cohort by period matrix, zero where nothing was paid.

    With ``periods`` a period not listed fails the query; without, all are found.
    """
    rows = triangle.select("cohort", _listed("period", periods), "revenue").groupBy("cohort")
    wide = rows.pivot("period", periods) if periods else rows.pivot("period")
    matrix = wide.agg(F.max("revenue")).fillna(0.0)  # one row per cell
    return matrix.select(
        "cohort", *[F.col(f"`{c}`").alias(f"m{c}") for c in matrix.columns[1:]]
    ).orderBy("cohort")


def rank_pivot(
    top: DataFrame, group: str, measure: str = "revenue", n: int = 3
) -> DataFrame:
    """Top-n rows of each group side by side: rank_1 .. rank_n."""
    wide = top.groupBy(group).pivot("rnk", list(range(1, n + 1))).agg(F.max(measure))
    return wide.select(
        group, *[F.col(f"`{i}`").alias(f"rank_{i}") for i in range(1, n + 1)]
    ).orderBy(group)


def net_revenue(
    orders: DataFrame,
    refunds: DataFrame,
    by: str = "month",
    order_id: str = "order_id",
    ts: str = "order_ts",
    amount: str = "amount",
) -> DataFrame:
    """Gross, refunded and net revenue with the refund rate by amount, per order
    month (``by="month"``) or per order column (e.g. ``product_category``)."""
    key, name = (month_of(ts), "m") if by == "month" else (F.col(by), by)
    # an order may be refunded in parts
    back = refunds.groupBy(order_id).agg(as_double(total_money("amount")).alias("_back"))
    sums = (
        orders.select(order_id, key.alias(name), F.col(amount).alias("_paid"))
        .join(back, order_id, "left")
        .groupBy(name)
        .agg(
            total_money("_paid").alias("paid"),
            F.coalesce(total_money("_back"), F.lit(0)).alias("back"),
        )
    )
    return sums.select(
        name,
        round_to("paid", 2).alias("gross"),
        round_to("back", 2).alias("refunded"),
        round_to(F.col("paid") - F.col("back"), 2).alias("net"),
        percent("back", "paid", 2).alias("refund_rate_pct"),
    ).orderBy(name)


def average_order_value(orders: DataFrame, amount: str = "amount") -> DataFrame:
    total = total_money(amount)
    return orders.agg(
        F.count(F.lit(1)).alias("orders"),
        round_to(total, 2).alias("revenue"),
        round_to(as_double(total) / F.count(F.lit(1)), 2).alias("aov"),
    )


def revenue_per_active_user(
    orders: DataFrame,
    activity: DataFrame,
    start: str,
    end: str,
    user: str = "user_id",
    order_ts: str = "order_ts",
    activity_ts: str = "event_time",
    amount: str = "amount",
) -> DataFrame:
    """ARPU over the days from ``start`` to ``end`` inclusive: revenue of the
    window by the users active in it. The window is part of the answer."""
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    paid = orders.where(day(order_ts).between(first, last))
    active = activity.where(day(activity_ts).between(first, last))
    users = active.agg(F.countDistinct(user)).scalar()
    return (
        paid.agg(total_money(amount).alias("_revenue"))
        .withColumn("active_users", users)
        .select(
            first.alias("window_start"),
            last.alias("window_end"),
            round_to("_revenue", 2).alias("revenue"),
            "active_users",
            round_to(
                as_double("_revenue") / F.nullif(F.col("active_users"), F.lit(0)), 2
            ).alias("arpu"),
        )
    )


def refund_rate_by_orders(
    orders: DataFrame, refunds: DataFrame, order_id: str = "order_id"
) -> DataFrame:
    """Share of orders with a refund (the rate by amount is in net_revenue)."""
    refunded = refunds.select(order_id).distinct().withColumn("_refunded", F.lit(1))
    return (
        orders.select(order_id)
        .join(refunded, order_id, "left")
        .agg(
            F.count(F.lit(1)).alias("paid_orders"),
            F.count("_refunded").alias("refunded_orders"),
        )
        .withColumn(
            "refund_rate_orders_pct", percent("refunded_orders", "paid_orders", 2)
        )
    )
