"""Column expressions shared by the operators.

Everything here is a built-in Spark expression, so it stays inside whole-stage
code generation. Timestamps are zone-less (``timestamp_ntz``) throughout; none
of these helpers converts through the session time zone.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

GRAINS = ("day", "week", "month", "quarter", "year")


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


# ------------------------------------------------------------------ rounding


def round_to(value, digits: int) -> Column:
    """Round a double half away from zero *after scaling it*.

    ``F.round(x, 2)`` rounds the shortest decimal rendering of ``x``; scaling
    first is what SQL engines working on binary doubles do, and the two differ
    on about one third-decimal tie in twenty.
    """
    scale = float(10**digits)
    return F.round(_col(value).cast("double") * scale) / scale


def percent(part, whole, digits: int | None = 2) -> Column:
    """``100 * part / whole``; NULL when ``whole`` is zero."""
    ratio = (
        F.lit(100.0)
        * _col(part).cast("double")
        / F.nullif(_col(whole).cast("double"), F.lit(0.0))
    )
    return ratio if digits is None else round_to(ratio, digits)


# --------------------------------------------------------------------- money


def units(value, scale: int = 2) -> Column:
    """A monetary double as a whole number of cents (or smaller units).

    Sums of it are exact, so they do not depend on how rows were partitioned,
    and the conversion is far cheaper than casting a double to a decimal. A value
    that has no exact number of such units as a double (NaN, infinite, or 9e15
    units and more) fails the query: it is not money.
    """
    x = _col(value).cast("double") * float(10**scale)
    failed = F.raise_error(
        F.concat(F.lit(f"not an amount of money with {scale} digits: "), _col(value).cast("string"))
    ).cast("long")
    return F.when(x.isNull() | (F.abs(x) < 9e15), F.floor(x + 0.5)).otherwise(failed)


def total_units(whole: Column, scale: int = 2) -> Column:
    """Exact decimal sum of a column of :func:`units`; cannot overflow a long."""
    return F.sum(whole.cast("decimal(20,0)")) * F.lit(Decimal(1).scaleb(-scale))


def total_money(value, scale: int = 2) -> Column:
    """Exact decimal sum of a monetary column."""
    return total_units(units(value, scale), scale)


_FINE = 2.0**40


def total(value, money: bool = False) -> Column:
    """Sum as a double that does not depend on the order of adding.

    ``money`` sums exact cents. Other values are cut into a whole part, 40 binary
    digits after the point, and a rest. The first two are summed exactly; the rest,
    below 1e-12 a value, keeps thirteen digits of its own. A sum with a value of 1e18
    and more is a plain one of thirteen digits, and NaN and infinity stay visible.
    """
    if money:
        return as_double(total_money(value))
    x = _col(value).cast("double")
    small = F.abs(x) < 1e18  # neither NaN nor infinite
    whole = F.when(small, x.cast("long")).otherwise(0)
    scaled = F.when(small, (x - whole) * _FINE).otherwise(0.0)
    fine = scaled.cast("long")
    exact = F.try_add(
        F.try_multiply(F.sum(whole.cast("decimal(18,0)")), F.lit(Decimal(2**40))),
        F.sum(fine.cast("decimal(13,0)")),
    ).cast("double")
    rest = _digits(F.sum(scaled - fine))
    added = F.sum(x)
    return F.when(F.max(F.abs(x)) < 1e18, F.coalesce(exact / _FINE + rest / _FINE, _digits(added))).otherwise(
        F.when(added.isNotNull(), _digits(added))
    )


def _digits(number: Column) -> Column:
    return F.format_string("%.12e", number).cast("double")


def as_double(value) -> Column:
    return _col(value).cast("double")


# ------------------------------------------------------------- dates, periods


def day(ts) -> Column:
    return F.to_date(_col(ts))


def week_of(ts) -> Column:
    """Monday of the week."""
    return F.trunc(day(ts), "week")


def month_of(ts) -> Column:
    return F.trunc(day(ts), "month")


def week_ending_sunday(ts) -> Column:
    """The Sunday that closes the Monday-to-Sunday week."""
    return F.date_add(week_of(ts), 6)


def period_of(ts, grain: str) -> Column:
    """First day of the period of the given grain, as a DATE."""
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}, not {grain!r}")
    return day(ts) if grain == "day" else F.trunc(day(ts), grain)


def day_gap(start, end) -> Column:
    """Number of midnights between two timestamps."""
    return F.datediff(day(end), day(start)).cast("long")


def month_gap(start, end) -> Column:
    """Calendar months between two timestamps, ignoring the day of month."""
    a, b = _col(start), _col(end)
    return ((F.year(b) - F.year(a)) * 12 + (F.month(b) - F.month(a))).cast("long")


def period_gap(start, end, grain: str) -> Column:
    """Whole periods between two period starts."""
    if grain == "day":
        return day_gap(start, end)
    if grain == "week":
        return (day_gap(start, end) / 7).cast("long")
    step = {"month": 1, "quarter": 3, "year": 12}[grain]
    return (month_gap(start, end) / step).cast("long")


def epoch_seconds(ts) -> Column:
    """Seconds since 1970-01-01 on the timestamp's own clock, rounded down (for
    earlier times a whole second counts to the one before)."""
    t = _col(ts)
    before = (t < F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")).cast("int")
    return F.unix_timestamp(t) - before


def epoch_minutes(ts) -> Column:
    """Whole minutes since 1970-01-01; differences count minute boundaries."""
    t = _col(ts)
    days = F.datediff(F.to_date(t), F.lit("1970-01-01").cast("date")).cast("long")
    return days * 1440 + F.hour(t) * 60 + F.minute(t)
