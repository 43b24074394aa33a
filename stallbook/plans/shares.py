"""Shares of a grand total.

Only for finished aggregates with one row per label (payment method, promoter
class, brand): those rows fit in one task by nature, and a window over them
reads the aggregate once, where a scalar subquery would compute it again.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import ratio


def share_of_total(value: str) -> Column:
    """value / sum(value) over all labels, as double."""
    return ratio(F.col(value), F.sum(value).over(Window.partitionBy()))
