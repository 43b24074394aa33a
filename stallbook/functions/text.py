"""Display text and label codes."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import as_column

# Display units, largest first.
UNITS = ((1_000_000_000, "B"), (1_000_000, "M"), (1_000, "K"))


def compact_number(value: Column | str, currency: bool = True) -> Column:
    """1234567 as $1.2M; missing and NaN as N/A.

    format_number rounds on the exact binary value, half to even.
    """
    v = as_column(value).cast("double")
    sign = F.lit("$" if currency else "")
    shown = F.concat(sign, F.format_number(v, 0))
    for size, unit in reversed(UNITS):
        scaled = F.replace(F.format_number(v / F.lit(float(size)), 1), F.lit(","), F.lit(""))
        shown = F.when(F.abs(v) >= F.lit(float(size)), F.concat(sign, scaled, F.lit(unit))).otherwise(shown)
    return F.when(v.isNull() | F.isnan(v), F.lit("N/A")).otherwise(shown)


def joined(items: Column | str, separator: str = ", ") -> Column:
    """Array to text in a fixed order."""
    return F.concat_ws(separator, F.array_sort(as_column(items)))


def ordinal_of(label: Column | str, order: Sequence[str]) -> Column:
    """Position of the label in a fixed list; NULL when it is not listed."""
    lookup = F.create_map(*chain.from_iterable((F.lit(name), F.lit(i)) for i, name in enumerate(order)))
    return F.try_element_at(lookup, as_column(label))
