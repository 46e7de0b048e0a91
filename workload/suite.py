"""Every operator as a named query over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import round_to
from tidemark.operators import (
    activity,
    anomalies,
    checks,
    customers,
    experiments,
    funnel,
    models,
    profile,
    retail,
    retention,
    revenue,
    sessions,
    subscriptions,
    summary,
)
from tidemark.plans import scratch_path
from tidemark.sources import (
    clean_invoice_lines,
    clean_purchases,
    preview,
    read_table,
    union_sheets,
    write_table,
)
from workload import roles
from workload.roles import STEPS

# the event tables cover 30 days, so day 28 replaces day 30
DAYS = (1, 7, 28)
STARTS, WIDTH = (3, 7, 14, 21), 7
MRR_END = "2001-08-01"
CHURN_FROM, CHURN_TO = "1995-02-01", "2001-08-01"
EIGHT_HOURS = 8 * 3600

QUERIES = {}


def query(name):
    def register(fn):
        QUERIES[name] = fn
        return fn

    return register


# ------------------------------------------------------- analytical operators


@query("q01_funnel")
def _(s, d):
    return funnel.funnel(roles.events(s, d), STEPS).drop("pos")


@query("q02_nday_retention")
def _(s, d):
    return retention.nday_retention(
        roles.signups(s, d), roles.events(s, d), DAYS, grain="day"
    )


@query("q02_nday_retention_orders")
def _(s, d):
    return retention.nday_retention(
        roles.buyers(s, d), roles.all_orders(s, d), (1, 7, 30), ts="order_ts"
    )


@query("q03_rolling_retention")
def _(s, d):
    return retention.rolling_retention(
        roles.signups(s, d), roles.events(s, d), STARTS, WIDTH, grain="day"
    )


@query("q03_rolling_retention_orders")
def _(s, d):
    return retention.rolling_retention(
        roles.buyers(s, d), roles.all_orders(s, d), ts="order_ts"
    )


@query("q04_stickiness")
def _(s, d):
    return activity.stickiness(roles.events(s, d))


@query("q04_stickiness_7d")
def _(s, d):
    return activity.stickiness(roles.events(s, d), window_days=7)


@query("q04_stickiness_nulls")
def _(s, d):
    return activity.stickiness(roles.nullable_events(s, d))


@query("q05_ltv_by_cohort")
def _(s, d):
    return revenue.ltv_by_cohort(roles.buyers(s, d), roles.orders(s, d))


@query("q06_top_categories")
def _(s, d):
    return revenue.top_categories(roles.customers(s, d), roles.orders(s, d), 3)


@query("q07_running_total")
def _(s, d):
    return revenue.running_total(roles.orders(s, d))


@query("q07_running_total_by_category")
def _(s, d):
    return revenue.running_total(roles.all_orders(s, d), by=["product_category"])


@query("q08_longest_streak")
def _(s, d):
    return activity.longest_streak(roles.events(s, d), 50)


@query("q09_ab_test")
def _(s, d):
    return experiments.ab_test(roles.customers(s, d), roles.orders(s, d))


@query("q10_attribution")
def _(s, d):
    return revenue.attribution(roles.customers(s, d), roles.orders(s, d))


@query("q11_moving_average")
def _(s, d):
    return activity.moving_average(activity.daily_users(roles.events(s, d)))


@query("q12_top_users")
def _(s, d):
    return revenue.top_users(roles.customers(s, d), roles.orders(s, d), 2).drop("rnk")


@query("q13_pivot_revenue")
def _(s, d):
    return revenue.pivot_revenue(roles.orders(s, d))


@query("q14_mrr")
def _(s, d):
    return subscriptions.mrr(roles.subs(s, d), MRR_END)


@query("q14_mrr_early_end")
def _(s, d):
    return subscriptions.mrr(roles.subs(s, d), "1996-06-01")


@query("q15_distribution")
def _(s, d):
    return revenue.distribution(roles.orders(s, d))


@query("q16_session_metrics")
def _(s, d):
    return sessions.session_metrics(roles.events(s, d))


@query("q16_session_metrics_8h")
def _(s, d):
    return sessions.session_metrics(roles.events(s, d), EIGHT_HOURS)


@query("q16_sessionize")
def _(s, d):
    return sessions.sessionize(roles.events(s, d), EIGHT_HOURS).select(
        "event_id", "user_id", "session_no"
    )


@query("q16_sessionize_nulls")
def _(s, d):
    return sessions.sessionize(roles.nullable_events(s, d), EIGHT_HOURS).select(
        "event_id", "user_id", "session_no"
    )


@query("q16_session_metrics_nulls")
def _(s, d):
    return sessions.session_metrics(roles.nullable_events(s, d), EIGHT_HOURS)


@query("q17_lifecycle_nulls")
def _(s, d):
    return activity.lifecycle(roles.nullable_events(s, d))


@query("q17_lifecycle")
def _(s, d):
    return activity.lifecycle(roles.all_orders(s, d), ts="order_ts")


@query("q17_lifecycle_events")
def _(s, d):
    return activity.lifecycle(roles.events(s, d))


@query("q18_revenue_triangle")
def _(s, d):
    return revenue.revenue_triangle(roles.buyers(s, d), roles.orders(s, d))


@query("q19_repeat_purchase")
def _(s, d):
    return customers.repeat_purchase(roles.orders(s, d))


@query("q20_rfm")
def _(s, d):
    return customers.rfm(roles.orders(s, d))


@query("q20_rfm_segments")
def _(s, d):
    return customers.rfm_segments(customers.rfm(roles.orders(s, d)))


@query("q21_churn")
def _(s, d):
    return subscriptions.churn(
        roles.subs(s, d), roles.cancels(s, d), CHURN_FROM, CHURN_TO
    )


@query("q22_net_revenue_month")
def _(s, d):
    return revenue.net_revenue(roles.orders(s, d), roles.refunds(s, d))


@query("q22_net_revenue_category")
def _(s, d):
    return revenue.net_revenue(
        roles.orders(s, d), roles.refunds(s, d), "product_category"
    )


@query("q23_pareto")
def _(s, d):
    return customers.pareto(roles.orders(s, d))


@query("q24_anomalies")
def _(s, d):
    return anomalies.mad_anomalies(revenue.daily_revenue(roles.orders(s, d)))


@query("q24_anomalies_by_category")
def _(s, d):
    daily = revenue.daily_revenue(roles.all_orders(s, d), by=["product_category"])
    return anomalies.mad_anomalies(daily, by=["product_category"])


@query("q25_subscription_conversion")
def _(s, d):
    return customers.subscription_conversion(roles.orders(s, d), roles.subs(s, d))


@query("q26_repeat_concentration")
def _(s, d):
    return retail.repeat_concentration(roles.lines(s, d, country=False))


# ------------------------------------------------------- models and data tests


@query("m01_stg_users")
def _(s, d):
    return models.stg_users(roles.users(s, d))


@query("m02_stg_events")
def _(s, d):
    return models.stg_events(roles.events(s, d))


@query("m03_stg_subscriptions")
def _(s, d):
    return models.stg_subscriptions(roles.subs(s, d))


@query("m04_fct_funnel")
def _(s, d):
    return models.fct_funnel(models.stg_events(roles.events(s, d)), STEPS)


@query("m05_fct_retention")
def _(s, d):
    return models.fct_retention(
        models.stg_users(roles.users(s, d)),
        models.stg_events(roles.events(s, d)),
        DAYS,
        "week",
    )


@query("m06_fct_mrr")
def _(s, d):
    return models.fct_mrr(models.stg_subscriptions(roles.subs(s, d)), MRR_END)


@query("m07_mart_csv")
def _(s, d):
    path = scratch_path(s, "fct-mrr")
    mart = models.fct_mrr(models.stg_subscriptions(roles.subs(s, d)), MRR_END)
    models.write_mart(mart, path, "csv")
    return read_table(s, path, "csv", "month DATE, mrr DOUBLE, active_subs BIGINT")


@query("m07_mart_tables")
def _(s, d):
    """Staging views and a mart table by name; the mart reads its staging by name."""
    built = models.materialise(
        s,
        {
            "stg_subscriptions": lambda s: models.stg_subscriptions(roles.subs(s, d)),
            "fct_mrr": lambda s: models.fct_mrr(s.table("stg_subscriptions"), MRR_END),
        },
        {"stg": "view", "fct": "table"},
        scratch_path(s, "marts"),
    )
    return built["fct_mrr"]


@query("t01_not_null")
def _(s, d):
    return checks.not_null(roles.lines(s, d, country=False), "customer_id").select(
        "invoice", "stock_code", "quantity", "customer_id"
    )


@query("t02_unique")
def _(s, d):
    return checks.unique(roles.all_orders(s, d), "user_id")


@query("t03_unique_key")
def _(s, d):
    return checks.unique_key(roles.lines(s, d, country=False), ["customer_id", "invoice", "stock_code"])


@query("t04_relationships")
def _(s, d):
    return checks.relationships(
        roles.all_orders(s, d), roles.orders(s, d), "user_id"
    )


@query("t05_accepted_values")
def _(s, d):
    return checks.accepted_values(roles.events(s, d), "event_name", STEPS)


@query("t06_monotonic")
def _(s, d):
    mart = models.fct_funnel(models.stg_events(roles.events(s, d)), STEPS)
    return checks.monotonic(mart, "pos", "sessions", "event_name")


@query("t07_assert_golden")
def _(s, d):
    # expected: the same counts by another route, one of them off by one and
    # one for a step the mart does not have
    seen = roles.events(s, d).select("event_name", "session_id").distinct()
    wrong = F.when(F.col("event_name") == "purchase", 1).otherwise(0)
    expected = (
        seen.groupBy("event_name")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("event_name", (F.col("n") + wrong).alias("sessions"))
    )
    mart = models.fct_funnel(roles.events(s, d), STEPS)
    return checks.assert_golden(mart, expected, ["event_name"])


@query("t08_range_check")
def _(s, d):
    return checks.range_check(
        roles.lines(s, d, country=False), {"quantity": (1, None), "price": (0.0, 50000.0)}
    )


@query("t09_reconcile")
def _(s, d):
    orders, all_orders = roles.orders(s, d), roles.all_orders(s, d)
    refunds, subs = roles.refunds(s, d), roles.subs(s, d)
    cancels, users = roles.cancels(s, d), roles.customers(s, d)
    paid = revenue.total_money("amount")
    totals = revenue.running_total(orders).agg(F.max("cumulative"))
    buyers = revenue.revenue_per_user(orders).agg(F.count(F.lit(1)))
    late = checks.late_parents(users, orders, "user_id", "signup_date", "order_ts")
    none = orders.agg((F.count(F.lit(1)) * 0).alias("z"))
    orphans = checks.relationships(cancels, subs, "sub_id").agg(F.count(F.lit(1)))
    return checks.reconcile(
        [
            checks.equal_totals("order_total_is_cumulative", orders.agg(paid), totals),
            checks.at_most("refunds_within_gross", refunds.agg(paid), all_orders.agg(paid)),
            checks.equal_totals(
                "buyers_are_distinct_users", buyers, orders.agg(F.countDistinct("user_id"))
            ),
            checks.equal_totals("cancels_have_subs", orphans, none),
            checks.equal_totals("signup_before_order", late, none),
            checks.equal_totals(
                "all_orders_are_finished", all_orders.agg(paid), orders.agg(paid)
            ),
        ]
    )


@query("t10_claim_check")
def _(s, d):
    metrics = customers.repeat_purchase(roles.orders(s, d))
    # published: whole numbers, so rates become mismatches and counts do not
    claims = metrics.select("metric", F.floor("value").alias("published"))
    unknown = metrics.where("metric = 'buyers'").select(
        F.lit("sessions_per_buyer").alias("metric"), F.floor("value").alias("published")
    )
    return checks.claim_check(claims.unionByName(unknown), metrics)


# -------------------------------------------------- exploration and reporting


@query("e01_dataset_summary")
def _(s, d):
    events = roles.events(s, d)
    tables = {
        "users": roles.users(s, d),
        "events": events,
        "orders": roles.orders(s, d),
        "subscriptions": roles.subs(s, d),
        "refunds": roles.refunds(s, d),
        "cancellations": roles.cancels(s, d),
        "online_retail": roles.lines(s, d),
    }
    return summary.dataset_summary(tables, {"sessions": (events, "session_id")})


@query("e02_funnel_drop")
def _(s, d):
    return funnel.funnel_drop(roles.events(s, d), STEPS)


@query("e03_overall_retention")
def _(s, d):
    return retention.nday_retention(
        roles.signups(s, d), roles.events(s, d), DAYS, grain=None
    )


@query("e04_censored_retention")
def _(s, d):
    return retention.censored_retention(
        roles.users(s, d), roles.events(s, d), DAYS, grain="day"
    )


@query("e04_censored_means")
def _(s, d):
    table = retention.censored_retention(
        roles.users(s, d), roles.events(s, d), DAYS, grain="day"
    )
    return retention.censored_means(table, DAYS)


@query("e05_ab_rates")
def _(s, d):
    return experiments.ab_rates(roles.customers(s, d), roles.orders(s, d))


@query("e06_metric_by_segment")
def _(s, d):
    return summary.metric_by_segment(
        roles.orders(s, d), "amount", "product_category", money=True
    )


@query("e07_conversion_by_channel")
def _(s, d):
    return experiments.segment_conversion(
        roles.customers(s, d), roles.orders(s, d), "channel"
    )


@query("e07_conversion_by_country")
def _(s, d):
    return experiments.segment_conversion(
        roles.customers(s, d), roles.orders(s, d), "country"
    )


@query("e07_conversion_by_device")
def _(s, d):
    return experiments.segment_conversion(
        roles.customers(s, d), roles.orders(s, d), "device"
    )


@query("e08_composition")
def _(s, d):
    return summary.composition(roles.customers(s, d), "channel", "device")


@query("e09_plan_summary")
def _(s, d):
    return subscriptions.plan_summary(roles.subs(s, d), roles.cancels(s, d))


@query("e10_retail_overview")
def _(s, d):
    return retail.retail_overview(roles.lines(s, d, country=False))


@query("e11_customer_repeat")
def _(s, d):
    return retail.customer_repeat(roles.lines(s, d, country=False))


@query("e12_concentration")
def _(s, d):
    return customers.concentration(retail.customer_revenue(roles.lines(s, d, country=False)))


@query("e13_cancel_revenue")
def _(s, d):
    return retail.cancel_revenue(roles.lines(s, d, country=False))


@query("e14_weekly_resample")
def _(s, d):
    return summary.weekly_resample(roles.orders(s, d))


@query("e15_histogram")
def _(s, d):
    return summary.histogram(roles.orders(s, d), "amount")


@query("e15_histogram_log10")
def _(s, d):
    return summary.histogram(roles.orders(s, d), "amount", log10=True)


@query("e15_shape")
def _(s, d):
    return summary.distribution_shape(roles.orders(s, d), "amount")


@query("e15_shape_log10")
def _(s, d):
    return summary.distribution_shape(roles.orders(s, d), "amount", log10=True)


@query("e16_mask_warmup")
def _(s, d):
    return activity.mask_warmup(activity.stickiness(roles.events(s, d)))


@query("e17_triangle_matrix")
def _(s, d):
    triangle = revenue.revenue_triangle(
        roles.buyers(s, d), roles.orders(s, d), grain="year"
    )
    return revenue.triangle_matrix(triangle)


@query("e18_rank_pivot")
def _(s, d):
    top = revenue.top_categories(roles.customers(s, d), roles.orders(s, d), 3)
    return revenue.rank_pivot(top, "country", n=3)


@query("e19_rfm_profile")
def _(s, d):
    return customers.rfm_profile(customers.rfm(roles.orders(s, d)))


@query("e20_aov")
def _(s, d):
    return revenue.average_order_value(roles.orders(s, d))


@query("e20_arpu")
def _(s, d):
    return revenue.revenue_per_active_user(
        roles.orders(s, d),
        roles.all_orders(s, d),
        "1997-01-01",
        "1997-12-31",
        activity_ts="order_ts",
    )


@query("e20_refund_rate_orders")
def _(s, d):
    return revenue.refund_rate_by_orders(roles.orders(s, d), roles.refunds(s, d))


@query("e21_loss_table")
def _(s, d):
    return funnel.loss_table(roles.events(s, d), STEPS)


@query("e22_outcome_lift")
def _(s, d):
    return experiments.outcome_lift(roles.log(s, d))


# ------------------------------------------------------------------ profiling


@query("p01_schema")
def _(s, d):
    return profile.profile_schema(roles.orders(s, d))


@query("p02_quality")
def _(s, d):
    return profile.profile_quality(roles.lines(s, d))


@query("p03_numeric")
def _(s, d):
    return profile.profile_numeric(roles.lines(s, d), ["quantity", "price", "customer_id"])


@query("p04_categorical")
def _(s, d):
    return profile.profile_categorical(roles.lines(s, d), ["stock_code", "country"])


@query("p05_corr")
def _(s, d):
    lines = roles.table(s, d, "lineitem")
    gross = F.col("l_quantity") * F.col("l_extendedprice")
    return profile.profile_corr(
        lines.withColumn("gross", gross),
        ["l_quantity", "l_extendedprice", "l_discount", "gross"],
    )


@query("p06_metric_by_country")
def _(s, d):
    return summary.metric_by_segment(roles.lines(s, d), "price", "country")


@query("p06_metric_by_cancellation")
def _(s, d):
    return summary.metric_by_segment(roles.lines(s, d), "price", "is_cancellation")


@query("p07_weekly_trend")
def _(s, d):
    return profile.weekly_trend(roles.orders(s, d), "order_ts", "amount", money=True)


@query("p07_weekly_trend_sparse")
def _(s, d):
    # new subscriptions become rare towards the end, so weeks stay empty
    return profile.weekly_trend(roles.subs(s, d), "started_at", "amount", money=True)


@query("p08_findings")
def _(s, d):
    return profile.profile_findings(
        roles.lines(s, d),
        numeric=["quantity", "price"],
        categorical=["invoice", "stock_code", "country"],
        metric="price",
        segments=["country", "is_cancellation"],
        ts="invoice_ts",
        thresholds={"weekly_jump_pct": 10.0, "segment_gap": 1.01},
    )


# ------------------------------------------------- ingest, sources and sinks


@query("i01_clean_invoice_lines")
def _(s, d):
    return clean_invoice_lines(roles.raw_lines(s, d))


@query("i02_union_sheets")
def _(s, d):
    raw = roles.raw_lines(s, d)
    early = raw.where("InvoiceDate < '36000'")
    late = raw.where("InvoiceDate >= '36000'")
    return (
        clean_invoice_lines(union_sheets(early, late))
        .groupBy("country", "is_cancellation")
        .agg(F.count(F.lit(1)).alias("n"), F.count("invoice_ts").alias("dated"))
    )


@query("i03_parquet_zstd")
def _(s, d):
    path = scratch_path(s, "online-retail")
    write_table(clean_invoice_lines(roles.raw_lines(s, d)), path)
    return retail.retail_overview(read_table(s, path))


@query("i04_parquet_source")
def _(s, d):
    return read_table(s, f"{d}/orders.parquet")  # schema from the file


@query("i05_csv_source")
def _(s, d):
    path = scratch_path(s, "orders-csv")
    write_table(roles.orders(s, d), path, "csv")
    return read_table(
        s,
        path,
        "csv",
        "order_id BIGINT, user_id BIGINT, order_ts TIMESTAMP_NTZ, amount DOUBLE, "
        "product_category STRING",
    )


@query("i06_csv_sink")
def _(s, d):
    path = scratch_path(s, "users-csv")
    write_table(roles.users(s, d), path, "csv")
    return read_table(
        s,
        path,
        "csv",
        "user_id BIGINT, signup_date DATE, channel STRING, country STRING, "
        "device STRING, ab_variant STRING",
    )


@query("i06_csv_text")
def _(s, d):
    """Names turned into cells with quotes, commas, line breaks and nothing."""
    name, key = F.col("c_name"), F.col("c_custkey")
    cell = (
        F.when(key % 5 == 0, F.concat(F.lit('say "'), name, F.lit('", twice')))
        .when(key % 5 == 1, F.concat(name, F.lit("\n"), name))
        .when(key % 5 == 2, "")
        .when(key % 5 == 3, F.concat(F.lit("  "), name, F.lit(" ")))
    )
    path = scratch_path(s, "names-csv")
    write_table(roles.table(s, d, "customer").select("c_custkey", cell.alias("cell")), path, "csv")
    return read_table(s, path, "csv", "cell STRING, c_custkey BIGINT", multi_line=True)


@query("i07_json_sink")
def _(s, d):
    path = scratch_path(s, "metrics-json")
    # 0/0 in floating point is NaN, which must come back as null
    metrics = customers.repeat_purchase(roles.orders(s, d)).withColumn(
        "broken", F.when(F.col("metric") == "buyers", F.lit(float("nan"))).otherwise(1.0)
    )
    write_table(metrics, path, "json")
    return read_table(s, path, "json", "metric STRING, value DOUBLE, broken DOUBLE")


@query("i08_preview")
def _(s, d):
    return preview(revenue.running_total(roles.orders(s, d)), 10)


@query("i09_clean_purchases")
def _(s, d):
    return (
        clean_purchases(roles.lines(s, d, country=False))
        .groupBy("customer_id")
        .agg(
            F.count(F.lit(1)).alias("purchase_lines"),
            round_to(retail.line_total(), 2).alias("revenue"),
        )
    )
