"""Table profiling."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import percent, round_to, total, week_ending_sunday
from tidemark.operators.summary import every_week, unbiased_skewness, weekly_series
from tidemark.plans import durable, exact_quantiles, value_counts

MET_BROADCAST = 100_000  # pairs of hashes, 16 bytes each

# Limits beyond which a finding is reported.
THRESHOLDS = {
    "null_share_pct": 5.0,
    "duplicate_rows": 0,
    "outlier_share_pct": 5.0,
    "skew": 2.0,
    "cardinality": 100,
    "segment_gap": 1.5,
    "weekly_jump_pct": 30.0,
    "lookback_weeks": 8,
}


def profile_schema(df: DataFrame) -> DataFrame:
    """Column names and types in order, with the row count."""
    columns = F.array(
        *[
            F.struct(
                F.lit(i).cast("long").alias("position"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
            )
            for i, f in enumerate(df.schema.fields, start=1)
        ]
    )
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(F.inline(columns), "row_count")


def profile_quality(df: DataFrame) -> DataFrame:
    """Duplicate rows, and per column its nulls and whether it is constant.

    Constant means that the smallest value is the largest, so one pass over the
    table without any distinct count is enough. Duplicates are counted by hashes; see
    :func:`count_copies`.
    """
    rows = F.count(F.lit(1))
    per_column = [
        F.array(
            F.struct(
                F.lit("nulls").alias("check_name"),
                F.lit(c).alias("column_name"),
                (rows - F.count(c)).alias("n"),
                percent(rows - F.count(c), rows, 1).alias("share_pct"),
            ),
            F.struct(
                F.lit("constant").alias("check_name"),
                F.lit(c).alias("column_name"),
                F.when(F.min(c).eqNullSafe(F.max(c)), 1).otherwise(0).cast("long").alias("n"),
                F.lit(None).cast("double").alias("share_pct"),
            ),
        )
        for c in df.columns
    ]
    columns = df.agg(F.flatten(F.array(*per_column)).alias("checks")).select(F.inline("checks"))
    met = meeting_hashes(df.select(*row_hashes(df)))
    copies = df.agg(rows.alias("rows")).select(
        F.lit("duplicate_rows").alias("check_name"),
        F.lit(None).cast("string").alias("column_name"),
        F.lit(count_copies(df, met)).cast("long").alias("n"),
        "rows",
    )
    return copies.select(
        "check_name", "column_name", "n", percent("n", "rows", 1).alias("share_pct")
    ).unionByName(columns)


def row_hashes(df: DataFrame) -> list[Column]:
    """128 bits of a row as ``h1`` and ``h2``; equal rows have equal ones.

    A hash skips what is NULL, so which columns are goes in as well.
    """
    cells = [F.col(c) for c in df.columns] + [F.col(c).isNull() for c in df.columns]
    return [F.xxhash64(*cells).alias("h1"), F.xxhash64(F.lit(7), *cells).alias("h2")]


def meeting_hashes(hashes: DataFrame) -> DataFrame:
    """The hashes ``h1`` and ``h2`` of more than one row, as a written table."""
    return durable(hashes.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))


def count_copies(df: DataFrame, met: DataFrame) -> int:
    """Rows that repeat an earlier one, given the hashes that several rows ``met`` in.

    Rows of other hashes have no copy, so whole rows are compared only where hashes
    met. A list of hashes that is small for certain goes to all tasks and nothing else is
    moved; a longer one is joined.
    """
    hashes = met.count()
    if not hashes:
        return 0
    listed = met.select("h1", "h2")
    if hashes <= MET_BROADCAST:
        listed = F.broadcast(listed)
    suspects = df.select(F.struct(*df.columns).alias("row"), *row_hashes(df)).join(
        listed, ["h1", "h2"], "left_semi"
    )
    # grouped by the columns, since their values are what must be equal
    alike = suspects.select("row.*").groupBy(*df.columns).agg(F.count(F.lit(1)).alias("copies"))
    return alike.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0))).first()[0]


def profile_numeric(
    df: DataFrame, columns: list[str], slices: int | None = None
) -> DataFrame:
    """Count, mean, quartiles, p95, sample deviation, outliers and skewness.

    Quantiles are exact for all columns at once: values are counted per column,
    and the counts also give the share outside 1.5 interquartile ranges.
    """
    doubles = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    moments = doubles.agg(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column_name"),
                    F.avg(c).alias("mean"),
                    F.stddev_samp(c).alias("std"),
                    unbiased_skewness(c).alias("skew"),
                )
                for c in columns
            ]
        ).alias("m")
    ).select(F.inline("m"))
    long = doubles.unpivot([], columns, "column_name", "x")
    return _numeric(moments, value_counts(long, ["column_name"], "x", slices))


def counted_moments(counts: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, mean, std, skew) of columns from their counted values."""
    n, rows = F.col("n"), F.sum("n")
    means = counts.groupBy("column_name").agg(
        (F.sum(F.col("x") * n) / rows).alias("mean"), rows.cast("double").alias("rows")
    )
    off = F.col("x") - F.col("mean")
    # one row a column on the right; deviations from the mean keep their digits
    spread = (
        counts.join(F.broadcast(means), "column_name")
        .groupBy("column_name", "mean", "rows")
        .agg(F.sum(off * off * n).alias("m2"), F.sum(off * off * off * n).alias("m3"))
    )
    size, m2 = F.col("rows"), F.col("m2") / F.col("rows")
    bias = F.sqrt(size * (size - 1.0)) / F.nullif(size - 2.0, F.lit(0.0))
    listed = F.array(*(F.lit(c) for c in columns))
    every = counts.sparkSession.range(1).select(F.explode(listed).alias("column_name"))
    return every.join(spread, "column_name", "left").select(
        "column_name",
        "mean",
        F.when(size > 1, F.sqrt(F.col("m2") / F.nullif(size - 1.0, F.lit(0.0)))).alias("std"),
        F.when(size >= 3, F.col("m3") / size / F.nullif(F.pow(m2, 1.5), F.lit(0.0)) * bias).alias("skew"),
    )


def _numeric(moments: DataFrame, counts: DataFrame) -> DataFrame:
    """The numeric profile from moments and range-partitioned counts of values."""
    quantiles = exact_quantiles(
        counts,
        ["column_name"],
        "x",
        {"p25": 0.25, "median": 0.5, "p75": 0.75, "p95": 0.95},
    )
    reach = 1.5 * (F.col("p75") - F.col("p25"))
    outside = (F.col("x") < F.col("p25") - reach) | (F.col("x") > F.col("p75") + reach)
    # one row per profiled column on the right
    outliers = (
        counts.join(F.broadcast(quantiles.drop("n")), "column_name")
        .groupBy("column_name")
        .agg(F.sum(F.when(outside, F.col("n")).otherwise(0)).alias("outliers"))
    )
    # a column without any value has moments of NULL and no quantiles
    return (
        moments.join(quantiles, "column_name", "left")
        .join(outliers, "column_name", "left")
        .select(
            "column_name",
            F.coalesce("n", F.lit(0)).alias("n"),
            round_to("mean", 4).alias("mean"),
            round_to("median", 4).alias("median"),
            round_to("std", 4).alias("std"),
            round_to("p25", 4).alias("p25"),
            round_to("p75", 4).alias("p75"),
            round_to("p95", 4).alias("p95"),
            percent("outliers", "n", 1).alias("outlier_pct"),
            round_to("skew", 4).alias("skew"),
        )
    )


def profile_categorical(df: DataFrame, columns: list[str], top: int = 10) -> DataFrame:
    """Cardinality and the most frequent values with their share, per column.

    All columns are counted as (column, value) rows in one pass. Of these a task hands
    on no more than ``top`` rows a column; a column without any value is one row with
    cardinality 0.
    """
    return top_values(count_values(df, columns), columns, top)


def count_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, value, n): how often each column holds each value, also none."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    return (
        df.select(F.inline(cells))
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def top_values(counted: DataFrame, columns: list[str], top: int) -> DataFrame:
    """The profile of columns from their counted values."""
    listed = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(i).alias("_at")) for i, c in enumerate(columns)])
    empty = counted.sparkSession.range(1).select(F.inline(listed))
    known = F.col("value").isNotNull()
    whole = (
        counted.groupBy("column_name")
        .agg(F.count("value").alias("cardinality"), F.sum(F.when(known, F.col("n"))).alias("rows"))
    )
    # the count of nulls ranks last and goes afterwards: a filter before would reach the
    # source, which could then not be shared with the totals
    frequent = Window.partitionBy("column_name").orderBy(~known, F.desc("n"), "value")
    best = (
        counted.withColumn("_place", F.row_number().over(frequent))
        .where((F.col("_place") <= top) & known)
    )
    # one row a column on either side
    return (
        empty.join(whole, "column_name", "left")
        .join(best, "column_name", "left")
        .orderBy("_at", "_place")
        .select(
            "column_name",
            F.coalesce("cardinality", F.lit(0)).alias("cardinality"),
            "value",
            F.coalesce("n", F.lit(0)).alias("n"),
            percent("n", "rows", 1).alias("share_pct"),
        )
    )


def profile_corr(df: DataFrame, columns: list[str], min_r: float = 0.5) -> DataFrame:
    """Pearson correlation of column pairs with abs(r) at least ``min_r``, from
    one aggregation."""
    pairs = [
        F.struct(
            F.lit(a).alias("left_column"),
            F.lit(b).alias("right_column"),
            F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias("r"),
        )
        for a, b in combinations(columns, 2)
    ]
    return (
        df.agg(F.array(*pairs).alias("pairs"))
        .select(F.inline("pairs"))
        .where(F.abs("r") >= min_r)
        .withColumn("r", round_to("r", 4))
    )


def weekly_trend(
    df: DataFrame, ts: str, metric: str | None = None, money: bool = False
) -> DataFrame:
    """Weekly value, count and value per row over a gap-free calendar, each with
    its change; the change after a zero, and of the first week, is zero."""
    return trend_of(weekly_series(df, ts, metric, money))


def trend_of(series: DataFrame) -> DataFrame:
    """The trend of a gap-free weekly series."""
    by_week = Window.orderBy("week")  # one row per week

    def change(name: str):
        before = F.lag(name).over(by_week)
        moved = (F.col(name) / F.nullif(before, F.lit(0.0)) - 1.0) * 100.0
        return round_to(F.coalesce(moved, F.lit(0.0)), 1).alias(f"{name}_change_pct")

    return (
        series.withColumn("count", F.col("n").cast("double"))
        .withColumn(
            "per_unit",
            F.coalesce(F.col("value") / F.nullif(F.col("count"), F.lit(0.0)), F.lit(0.0)),
        )
        .select(
            "week",
            round_to("value", 4).alias("value"),
            F.col("n"),
            round_to("per_unit", 4).alias("per_unit"),
            change("value"),
            change("count"),
            change("per_unit"),
        )
        .orderBy("week")
    )


def profile_findings(
    df: DataFrame,
    numeric: list[str],
    categorical: list[str],
    metric: str | None = None,
    segments: list[str] | None = None,
    ts: str | None = None,
    thresholds: dict | None = None,
) -> DataFrame:
    """The findings worth a look: level, kind, subject, value and a detail."""
    limit = {**THRESHOLDS, **(thresholds or {})}
    segments = segments or []
    if segments and metric is None:
        raise ValueError("segments need a metric")

    def finding(frame, level, kind, subject, value, detail):
        return frame.select(
            F.lit(level).alias("level"),  # lit() leaves a column as it is
            F.lit(kind).alias("kind"),
            subject.alias("subject"),
            value.cast("double").alias("value"),
            detail.alias("detail"),
        )

    nothing = F.lit(None).cast("string")
    kept, at = kept_columns(df, numeric, categorical, segments, metric, ts)
    cells = profile_cells(kept, at, categorical, segments, metric, ts)

    def of(kind: str) -> DataFrame:
        return cells.where(F.col("kind") == kind).withColumnRenamed("name", "column_name")

    share = percent("n", "rows", 1)
    copies = count_copies(df, meeting_hashes(kept.select("h1", "h2")))
    found = [
        finding(
            of("null").withColumn("share", share).where((F.col("n") > 0) & (F.col("share") >= limit["null_share_pct"])),
            "WARN", "nulls", F.col("column_name"), F.col("share"), nothing,
        ),
        finding(
            df.sparkSession.range(1).where(F.lit(copies > limit["duplicate_rows"])),
            "WARN", "duplicates", F.lit("rows"), F.lit(copies), nothing,
        ),
    ]
    if numeric:
        direction = F.when(F.col("skew") > 0, "right").otherwise("left")
        reasons = F.array(
            F.struct(
                F.lit("WARN").alias("level"),
                F.lit("outliers").alias("kind"),
                F.col("outlier_pct").alias("value"),
                nothing.alias("detail"),
                (F.col("outlier_pct") >= limit["outlier_share_pct"]).alias("keep"),
            ),
            F.struct(
                F.lit("INFO").alias("level"),
                F.lit("skew").alias("kind"),
                F.col("skew").alias("value"),
                direction.alias("detail"),
                (F.abs("skew") > limit["skew"]).alias("keep"),
            ),
        )
        counts = value_counts(_by_column(kept, numeric, at["number"], "x"), ["column_name"], "x")
        numbers = _numeric(counted_moments(counts, numeric), counts).select(
            "column_name", F.inline(reasons)
        )
        found.append(
            finding(
                numbers.where("keep"),
                F.col("level"),
                F.col("kind"),
                F.col("column_name"),
                F.col("value"),
                F.col("detail"),
            )
        )
    if categorical:
        found.append(
            finding(
                of("value").where(F.col("n") > limit["cardinality"]),
                "INFO", "cardinality", F.col("column_name"), F.col("n"), nothing,
            )
        )
    if segments:
        mean = F.col("total") / F.col("n")
        gaps = of("segment").groupBy("column_name").agg(
            round_to(F.max(mean) / F.nullif(F.min(mean), F.lit(0.0)), 4).alias("gap")
        )
        found.append(
            finding(
                gaps.where(F.col("gap") > limit["segment_gap"]),
                "INFO", "segment_gap", F.col("column_name"), F.col("gap"), nothing,
            )
        )
    if ts:
        weeks = of("week").select("week", F.col("total").alias("value"), "n")
        found.append(_jump_finding(trend_of(every_week(weeks)), limit, finding))
    return reduce(lambda a, b: a.unionByName(b), found)


def kept_columns(
    df: DataFrame,
    numeric: list[str],
    categorical: list[str],
    segments: list[str],
    metric: str | None,
    ts: str | None,
) -> tuple[DataFrame, dict[str, dict[str, str]]]:
    """What the findings need of each row, from one reading of ``df``: a written table, and
    by kind the names in it of the columns of ``df``.

    Kinds: ``null`` flags of all columns, ``number`` columns as doubles and ``text``
    columns as strings. Also the row's hashes ``h1`` and ``h2``, and the ``week`` of ``ts``.
    Rows stay rows and are not shuffled here; each finding reads its own columns.
    """
    numbers = dict.fromkeys([*numeric, *([metric] if metric else [])])
    texts = dict.fromkeys([*categorical, *segments])
    at = {
        kind: {c: f"{kind}_{i}" for i, c in enumerate(names)}
        for kind, names in (("null", df.columns), ("number", numbers), ("text", texts))
    }
    kept = df.select(
        *row_hashes(df),
        *(F.col(c).isNull().alias(k) for c, k in at["null"].items()),
        *(F.col(c).cast("double").alias(k) for c, k in at["number"].items()),
        *(F.col(c).cast("string").alias(k) for c, k in at["text"].items()),
        *([week_ending_sunday(ts).alias("week")] if ts else []),
    )
    return durable(kept), at


def _by_column(kept: DataFrame, columns: list[str], at: dict[str, str], name: str, *more: str) -> DataFrame:
    """(column_name, ``name``, more) of every row and listed column."""
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(at[c]).alias(name), *more) for c in columns]
    return kept.select(F.inline(F.array(*cells)))


def profile_cells(
    kept: DataFrame,
    at: dict[str, dict[str, str]],
    categorical: list[str],
    segments: list[str],
    metric: str | None,
    ts: str | None,
) -> DataFrame:
    """The small counts behind the findings, from :func:`kept_columns`: a written table of
    (kind, name, text, week, n, rows, total).

    Kinds: ``null`` columns with their nulls and all rows, ``value`` with the number of
    distinct values of categorical columns, and ``segment`` values and ``week`` dates with
    the sum of the metric. Each is one aggregation, added up map-side.
    """
    fields = {"name": "string", "text": "string", "week": "date", "n": "bigint", "rows": "bigint", "total": "double"}

    def cells(kind: str, frame: DataFrame) -> DataFrame:
        frame = frame.withColumnRenamed("column_name", "name")
        given = (F.col(f) if f in frame.columns else F.lit(None) for f in fields)
        return frame.select(
            F.lit(kind).alias("kind"), *(c.cast(t).alias(f) for c, (f, t) in zip(given, fields.items()))
        )

    rows = F.count(F.lit(1))
    flags = [
        F.struct(F.lit(c).alias("name"), F.count_if(F.col(k)).alias("n"), rows.alias("rows"))
        for c, k in at["null"].items()
    ]
    every = [cells("null", kept.agg(F.array(*flags).alias("flags")).select(F.inline("flags")))]
    if categorical:
        values = _by_column(kept, categorical, at["text"], "text").where(F.col("text").isNotNull())
        every.append(cells("value", values.distinct().groupBy("column_name").agg(rows.alias("n"))))
    if segments:
        own = at["number"][metric]
        measured = kept.where(~F.col(at["null"][metric]))
        totals = _by_column(measured, segments, at["text"], "text", own).groupBy("column_name", "text")
        every.append(cells("segment", totals.agg(rows.alias("n"), total(own).alias("total"))))
    if ts:
        value = total(at["number"][metric]) if metric else rows.cast("double")
        weeks = kept.where(F.col("week").isNotNull()).groupBy("week")
        every.append(cells("week", weeks.agg(rows.alias("n"), value.alias("total"))))
    return durable(reduce(lambda a, b: a.unionByName(b), every))


def _jump_finding(trend: DataFrame, limit: dict, finding) -> DataFrame:
    """The largest weekly jump of the recent weeks and what drove it: the flow
    (rows) or the behaviour (value per row) of that same week."""
    newest_first = Window.orderBy(F.desc("week"))
    largest_first = Window.orderBy(F.desc(F.abs("value_change_pct")), F.desc("week"))
    recent = trend.withColumn("_age", F.row_number().over(newest_first)).where(
        F.col("_age") <= limit["lookback_weeks"]
    )
    jump = (
        recent.withColumn("_place", F.row_number().over(largest_first))
        .where(F.col("_place") == 1)
        .where(F.abs("value_change_pct") >= limit["weekly_jump_pct"])
    )
    flow = F.abs("count_change_pct") >= F.abs("per_unit_change_pct")
    return finding(
        jump, "WARN", "weekly_jump", F.col("week").cast("string"),
        F.col("value_change_pct"), F.when(flow, "flow").otherwise("behaviour"),
    )
