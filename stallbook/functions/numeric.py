"""Money, ratios and rounding."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = "decimal(18,2)"
_ROUNDING = "decimal(38,12)"


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def money(value: Column | str) -> Column:
    """A currency amount; 18 digits keep it in one machine word."""
    return as_column(value).cast(MONEY)


def sum_money(value: Column | str) -> Column:
    """Exact sum of a two-decimal amount.

    A decimal sum leaves the machine word after 18 digits and then costs about
    three times a long sum, so the hot loop adds whole cents and the result is
    turned back into a decimal once per group. A group may reach 92 quadrillion
    currency units; ANSI mode raises beyond that rather than wrap.
    """
    cents = (money(value) * F.lit(100)).cast("bigint")
    return (F.sum(cents) * F.lit(Decimal("0.01"))).cast("decimal(21,2)")


def sum_amount(frame: DataFrame, amount: str, where: Column | None = None) -> Column:
    """Exact sum of a column at its own scale, optionally of some rows only.

    Declared cents take the fast path of ``sum_money``. A binary floating-point
    amount is added as decimal with ten places, so that the order of the rows
    does not matter.
    """
    kind = frame.schema[amount].dataType
    value = F.col(amount) if where is None else F.when(where, F.col(amount))
    if isinstance(kind, T.DecimalType):
        return sum_money(value) if kind.scale <= 2 else F.sum(value)
    if isinstance(kind, T.IntegralType):
        return F.sum(value)
    return F.sum(value.cast("decimal(28,10)"))


def ratio(part: Column | str, whole: Column | str) -> Column:
    """part / whole as double; NULL when whole is zero or NULL."""
    return F.try_divide(as_column(part).cast("double"), as_column(whole).cast("double"))


def half_up(value: Column | str, places: int) -> Column:
    """Round half away from zero on the decimal form, as double."""
    return F.round(as_column(value).cast(_ROUNDING), places).cast("double")


def percent(part: Column | str, whole: Column | str, places: int) -> Column:
    return half_up(ratio(part, whole) * F.lit(100.0), places)
