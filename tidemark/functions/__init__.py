from tidemark.functions.columns import (
    as_double,
    day,
    day_gap,
    epoch_minutes,
    epoch_seconds,
    month_gap,
    month_of,
    percent,
    period_gap,
    period_of,
    round_to,
    total,
    total_money,
    total_units,
    units,
    week_ending_sunday,
    week_of,
)
from tidemark.functions.stats import ntile_bucket, two_sided_p_value

__all__ = [
    "as_double",
    "day",
    "day_gap",
    "epoch_minutes",
    "epoch_seconds",
    "month_gap",
    "month_of",
    "ntile_bucket",
    "percent",
    "period_gap",
    "period_of",
    "round_to",
    "total",
    "total_money",
    "total_units",
    "two_sided_p_value",
    "units",
    "week_ending_sunday",
    "week_of",
]
