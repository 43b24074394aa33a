"""Calendar keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import as_column


def month_key(when: Column | str) -> Column:
    """yyyy-MM. Going through DATE keeps zone-less timestamps free of zone rules."""
    return F.date_format(F.to_date(as_column(when)), "yyyy-MM")


def iso_week(when: Column | str) -> Column:
    """ISO week label such as 2024-W05; the year is the week's own year."""
    day = F.to_date(as_column(when))
    year = F.extract(F.lit("YEAROFWEEK"), day).cast("string")
    return F.concat(year, F.lit("-W"), F.lpad(F.weekofyear(day).cast("string"), 2, "0"))


def week_start(when: Column | str) -> Column:
    """Monday of the week, as DATE."""
    day = F.to_date(as_column(when))
    return F.date_sub(day, F.weekday(day))


def weekday_name(when: Column | str) -> Column:
    return F.date_format(F.to_date(as_column(when)), "EEEE")


def weekday_number(when: Column | str) -> Column:
    """Monday is 1, Sunday is 7."""
    return F.weekday(F.to_date(as_column(when))) + F.lit(1)


def month_gap(later: Column | str, earlier: Column | str) -> Column:
    """Whole months between two yyyy-MM keys."""
    return F.months_between(
        F.to_date(as_column(later), "yyyy-MM"), F.to_date(as_column(earlier), "yyyy-MM")
    ).cast("int")


def time_of_day(when: Column | str) -> Column:
    return F.date_format(as_column(when), "HH:mm:ss")
