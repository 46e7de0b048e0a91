"""Buyers: repeat purchase, RFM segments, concentration, conversion."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import (
    as_double,
    day,
    day_gap,
    ntile_bucket,
    percent,
    round_to,
    total_money,
)
from tidemark.operators.sessions import long_form
from tidemark.plans import border_rows, global_rank, is_after, sortable, tile_ends, with_tiles


def repeat_purchase(
    orders: DataFrame, user: str = "user_id", ts: str = "order_ts"
) -> DataFrame:
    """Repeat rate, days between consecutive orders and orders per buyer, as
    (metric, value) rows.

    Orders are folded to one row per (user, day): further orders of a day are
    gaps of zero days, and the day before gives the remaining gap. Gaps are
    counted by length, so the percentiles see one row per distinct length.
    """
    days = orders.groupBy(F.col(user).alias("user_id"), day(ts).alias("d")).agg(
        F.count(F.lit(1)).alias("n")
    )
    per_user = Window.partitionBy("user_id").orderBy("d")
    gaps = (
        days.select("n", day_gap(F.lag("d").over(per_user), "d").alias("since"))
        .select(
            F.inline(
                F.array(
                    F.struct(F.lit(0).cast("long").alias("gap"), (F.col("n") - 1).alias("w")),
                    F.struct(
                        F.col("since").alias("gap"),
                        F.when(F.col("since").isNotNull(), 1).otherwise(0).cast("long").alias("w"),
                    ),
                )
            )
        )
        .where("w > 0")
        .groupBy("gap")
        .agg(F.sum("w").alias("w"))
        .agg(
            F.percentile("gap", 0.5, F.col("w")).alias("median"),
            F.percentile("gap", 0.9, F.col("w")).alias("p90"),
        )
        .select(F.struct("median", "p90").alias("gap"))
    )
    buyers = (
        days.groupBy("user_id")
        .agg(F.sum("n").alias("orders"))
        .agg(
            F.count(F.lit(1)).alias("buyers"),
            F.count_if(F.col("orders") >= 2).alias("repeat_buyers"),
            F.count_if(F.col("orders") == 1).alias("buyers_1_order"),
            F.count_if(F.col("orders") == 2).alias("buyers_2_orders"),
            F.count_if(F.col("orders") == 3).alias("buyers_3_orders"),
            F.count_if(F.col("orders") >= 4).alias("buyers_4plus_orders"),
        )
        .withColumn("gap", gaps.scalar())
        .withColumns(
            {
                "repeat_rate_pct": percent("repeat_buyers", "buyers", 1),
                "median_days_between": F.round("gap.median"),
                "p90_days_between": F.round("gap.p90"),
            }
        )
    )
    return long_form(
        buyers,
        [
            "buyers",
            "repeat_buyers",
            "repeat_rate_pct",
            "median_days_between",
            "p90_days_between",
            "buyers_1_order",
            "buyers_2_orders",
            "buyers_3_orders",
            "buyers_4plus_orders",
        ],
    )


# The segment of each level of recency and level of spend.
SEGMENTS = {
    "high/high": "Champions",
    "high/middle": "Loyal",
    "high/low": "Promising",
    "middle/high": "Big Spenders",
    "middle/middle": "Regular",
    "middle/low": "Hibernating",
    "low/high": "Big Spenders",
    "low/middle": "At Risk",
    "low/low": "Hibernating",
}


def _level(score: str, buckets: int) -> Column:
    """Above, at or below the middle bucket."""
    middle = (buckets + 1) // 2
    return (
        F.when(F.col(score) > middle, "high")
        .when(F.col(score) == middle, "middle")
        .otherwise("low")
    )


def rfm(
    orders: DataFrame,
    buckets: int = 5,
    user: str = "user_id",
    ts: str = "order_ts",
    amount: str = "amount",
    slices: int | None = None,
) -> DataFrame:
    """Recency, frequency and monetary scores with a segment for every buyer.

    Recency (days before the last order in the data) and spend are NTILE
    buckets, ties broken by user id; frequency is scored by value, since most
    buyers order once and a bucket border would fall inside that tie. The bucket
    borders are selected by counting; buyers are neither sorted nor written.
    """
    folded = orders.groupBy(F.col(user).alias("user_id")).agg(
        F.struct(
            F.max(day(ts)).alias("_last"),
            F.count(F.lit(1)).alias("frequency"),
            total_money(amount).alias("monetary"),
        ).alias("b")
    )
    buyers = _shared(folded, "user_id")
    by_spend = with_tiles(buyers, {"r": "_last", "m": "monetary"}, "user_id", buckets, slices)
    newest = buyers.agg(F.max("_last")).scalar()
    f = (
        F.when(F.col("frequency") >= 3, 5).when(F.col("frequency") == 2, 4).otherwise(1)
    ).cast("long")
    names = F.create_map(*(F.lit(x) for cell in SEGMENTS.items() for x in cell))
    segment = names[F.concat_ws("/", _level("r", buckets), _level("m", buckets))]
    return by_spend.withColumn("_newest", newest).select(
        "user_id",
        day_gap("_last", "_newest").alias("recency_days"),
        "frequency",
        as_double("monetary").alias("monetary"),
        "r",
        f.alias("f"),
        "m",
        segment.alias("segment"),
    )


def _shared(folded: DataFrame, key: str) -> DataFrame:
    """A fold (key, struct b), unpacked, that several readings of one plan share.

    The finished fold is shuffled once more by its key, and readings begin there instead
    of adding up the orders again. Unpacked by a generator, no reading can leave out
    columns, which would make it a different shuffle.
    """
    return folded.repartition(key).select(key, F.inline(F.array("b")))


def rfm_segments(scored: DataFrame) -> DataFrame:
    """Buyers, repeat buyers and revenue of each segment with their shares."""
    everything = Window.partitionBy()  # at most seven segments
    return (
        scored.groupBy("segment")
        .agg(
            F.count(F.lit(1)).alias("buyers"),
            F.count_if(F.col("f") >= 4).alias("repeat_buyers"),
            as_double(total_money("monetary")).alias("total"),
        )
        .select(
            "segment",
            "buyers",
            "repeat_buyers",
            round_to("total", 2).alias("revenue"),
            percent("buyers", F.sum("buyers").over(everything), 1).alias("pct_of_buyers"),
            percent(
                "total", F.sum(F.col("total").cast("decimal(28,2)")).over(everything), 1
            ).alias("pct_of_revenue"),
        )
        .orderBy(F.desc("revenue"), "segment")
    )


def rfm_profile(scored: DataFrame) -> DataFrame:
    """Mean recency, mean spend and repeat share of each segment."""
    buyers = F.count(F.lit(1))
    return (
        scored.groupBy("segment")
        .agg(
            buyers.alias("buyers"),
            round_to(F.sum("recency_days") / buyers, 1).alias("mean_recency_days"),
            round_to(as_double(total_money("monetary")) / buyers, 2).alias("mean_monetary"),
            percent(F.count_if(F.col("f") >= 4), buyers, 1).alias("repeat_share_pct"),
        )
        .orderBy("segment")
    )


def pareto(
    orders: DataFrame,
    buckets: int = 10,
    user: str = "user_id",
    amount: str = "amount",
    slices: int | None = None,
) -> DataFrame:
    """Buyer and revenue share per revenue decile, highest first.

    The cumulative share adds the *rounded* shares.
    """
    folded = orders.groupBy(user).agg(F.struct(total_money(amount).alias("revenue")).alias("b"))
    # highest first, without any amount last
    last = F.coalesce(-F.col("revenue"), F.lit(Decimal("9" * 28)))
    buyers = _shared(folded, user).withColumn("_order", last)
    ranked = with_tiles(buyers, {"decile": "_order"}, user, buckets, slices)
    everything = Window.partitionBy()
    upto = Window.orderBy("decile").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        ranked.groupBy("decile")
        .agg(F.count(F.lit(1)).alias("buyers"), F.sum("revenue").alias("total"))
        .select(
            "decile",
            "buyers",
            round_to("total", 2).alias("revenue"),
            percent("buyers", F.sum("buyers").over(everything), 2).alias("pct_of_buyers"),
            percent("total", F.sum("total").over(everything), 2).alias("pct_of_revenue"),
        )
        .withColumn(
            "cum_pct",
            round_to(F.sum(F.col("pct_of_revenue").cast("decimal(9,2)")).over(upto), 2),
        )
        .orderBy("decile")
    )


def concentration(
    customers: DataFrame,
    measure: str = "revenue",
    key: str = "customer_id",
    slices: int | None = None,
) -> DataFrame:
    """Revenue share of the top decile, the top fifth and the top 15 percent.

    Decile and fifth cut by NTILE; the top 15 percent by PERCENT_RANK, where
    customers with equal revenue share a rank and are in or out together.
    """
    rows = customers.select(key, measure, (-F.col(measure)).alias("_order"))
    if not sortable(rows, key, measure):
        return _ranked_concentration(customers, measure, key, slices)
    first, second = tile_ends(10)[:2]
    borders = border_rows(rows, ["_order"], key, [first, second, (0.15, _last_below_15)])
    value = F.col(measure)
    total = F.sum(value)

    def top(i: int) -> Column:
        beyond = F.expr(is_after(f"get(filter(_b._order, b -> b.i = {i}), 0)", "_order", key))
        return percent(F.sum(F.when(~beyond, value)), total, 2)

    third = F.expr("get(filter(_b._order, b -> b.i = 3), 0).value")
    return rows.select("*", F.inline(F.array(F.struct(borders.alias("_b"))))).agg(
        top(1).alias("top_decile_pct"),
        percent(F.sum(F.when(F.col("_order") <= third, value)), total, 2).alias("top_15_pct"),
        top(2).alias("top_20_pct"),
    )


def _last_below_15(n: Column) -> Column:
    """The last rank, counted from 1, whose PERCENT_RANK is at most 0.15."""
    others = F.greatest(n - 1, F.lit(1))
    near = F.floor(others * 0.15)
    return (
        F.when((near + 1) / others <= 0.15, near + 1).when(near / others <= 0.15, near).otherwise(near - 1) + 1
    )


def _ranked_concentration(
    customers: DataFrame, measure: str, key: str, slices: int | None
) -> DataFrame:
    """The same by a distributed sort, for keys that are neither numbers nor dates."""
    ranked = global_rank(customers, [F.desc(measure), F.col(key)], "_g", "_n", slices)
    value = F.col(measure)
    decile = ntile_bucket(F.col("_g"), F.col("_n"), 10)
    by_value = (
        ranked.withColumn("_decile", decile)
        .groupBy(measure)
        .agg(
            F.min("_g").alias("_first"),
            F.max("_n").alias("_n"),
            F.sum(F.when(F.col("_decile") == 1, value)).alias("_top10"),
            F.sum(F.when(F.col("_decile") <= 2, value)).alias("_top20"),
            F.sum(value).alias("_all"),
        )
    )
    share_rank = F.col("_first") / F.greatest(F.col("_n") - 1, F.lit(1))
    top15 = F.sum(F.when(share_rank <= 0.15, F.col("_all")))
    total = F.sum("_all")
    return by_value.agg(
        percent(F.sum("_top10"), total, 2).alias("top_decile_pct"),
        percent(top15, total, 2).alias("top_15_pct"),
        percent(F.sum("_top20"), total, 2).alias("top_20_pct"),
    )


def subscription_conversion(
    orders: DataFrame,
    subs: DataFrame,
    user: str = "user_id",
    order_ts: str = "order_ts",
    started: str = "started_at",
    plan: str = "plan",
) -> DataFrame:
    """Buyers who subscribe, by plan, and days from first order to the start,
    as (metric, value) rows."""
    buyers = orders.groupBy(user).agg(F.min(order_ts).alias("_first"))
    purchasers = buyers.agg(F.count(F.lit(1))).scalar()
    waited = day_gap("_first", started)
    row = (
        buyers.join(subs.select(user, started, plan), user)
        .agg(
            F.count(F.lit(1)).alias("subscribers"),
            F.count_if(F.col(plan) == "monthly").alias("monthly_subs"),
            F.count_if(F.col(plan) == "annual").alias("annual_subs"),
            F.round(F.percentile(waited, 0.5)).alias("median_days_to_convert"),
            F.round(F.percentile(waited, 0.9)).alias("p90_days_to_convert"),
        )
        .withColumn("purchasers", purchasers)
        .withColumn("conversion_pct", percent("subscribers", "purchasers", 1))
    )
    return long_form(
        row,
        [
            "purchasers",
            "subscribers",
            "conversion_pct",
            "monthly_subs",
            "annual_subs",
            "median_days_to_convert",
            "p90_days_to_convert",
        ],
    )
