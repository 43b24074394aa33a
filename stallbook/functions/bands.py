"""Threshold labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import as_column


def _labelled(tests, otherwise: str | None) -> Column:
    rest = F.lit(otherwise)
    for condition, label in reversed(list(tests)):
        rest = F.when(condition, F.lit(label)).otherwise(rest)
    return rest


def band(
    value: Column | str,
    ceilings: Sequence[tuple[float, str]],
    otherwise: str,
    inclusive: bool = True,
) -> Column:
    """Label by the first ceiling, in ascending order, that the value does not pass."""
    v = as_column(value)
    return _labelled(
        ((v <= F.lit(top) if inclusive else v < F.lit(top), label) for top, label in ceilings), otherwise
    )


def tier(
    value: Column | str,
    floors: Sequence[tuple[float, str]],
    otherwise: str,
    inclusive: bool = True,
) -> Column:
    """Label by the first floor, in descending order, that the value reaches."""
    v = as_column(value)
    return _labelled(
        ((v >= F.lit(low) if inclusive else v > F.lit(low), label) for low, label in floors), otherwise
    )


def first_match(tests: Sequence[tuple[Column, str]], otherwise: str) -> Column:
    """Label of the first condition that holds."""
    return _labelled(tests, otherwise)


def flag_count(condition: Column) -> Column:
    """Rows for which the condition holds."""
    return F.count_if(condition).cast("bigint")
