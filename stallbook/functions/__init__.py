"""Column expressions. Everything here stays inside the JVM: no Python UDFs."""

from .bands import band, flag_count, tier
from .calendar import (
    iso_week,
    month_gap,
    month_key,
    time_of_day,
    week_start,
    weekday_name,
    weekday_number,
)
from .numeric import MONEY, as_column, half_up, money, percent, ratio, sum_amount, sum_money
from .text import compact_number, joined, ordinal_of

__all__ = [
    "MONEY",
    "as_column",
    "band",
    "compact_number",
    "flag_count",
    "half_up",
    "iso_week",
    "joined",
    "money",
    "month_gap",
    "month_key",
    "ordinal_of",
    "percent",
    "ratio",
    "sum_amount",
    "sum_money",
    "tier",
    "time_of_day",
    "week_start",
    "weekday_name",
    "weekday_number",
]
