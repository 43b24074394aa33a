"""Event-time windows with a watermark.

Rows later than the watermark are dropped by append and update queries; state
is kept per window only, so it is bounded by the watermark and not by the
length of the stream.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ratio, sum_amount

_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def interval_seconds(text: str) -> int:
    """Seconds in an interval such as '5 minutes'."""
    found = re.fullmatch(r"(\d+) (second|minute|hour|day)s?", text.strip().lower())
    if found is None:
        raise ValueError(f"not a fixed interval: {text!r}")
    return int(found[1]) * _SECONDS[found[2]]


def event_time(rows: DataFrame, ts: str) -> DataFrame:
    """Give the event time the type a watermark needs; unparsable text becomes NULL.

    A zone-less time is read in the session time zone, which should be UTC.
    """
    kind = dict(rows.dtypes)[ts]
    if kind == "timestamp":
        return rows
    return rows.withColumn(ts, F.try_to_timestamp(ts) if kind == "string" else F.col(ts).cast("timestamp"))


def _timed(rows: DataFrame, ts: str, watermark: str) -> DataFrame:
    return event_time(rows, ts).withWatermark(ts, watermark)


def _bounds(*columns: Column | str) -> list[Column | str]:
    return [F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *columns]


def orders_per_minute(rows: DataFrame, ts: str, watermark: str = "10 minutes") -> DataFrame:
    """Rows per minute."""
    counts = _timed(rows, ts, watermark).groupBy(F.window(ts, "1 minute").alias("w")).agg(
        F.count(F.lit(1)).alias("orders")
    )
    return counts.select(*_bounds("orders"))


def hourly_amount(rows: DataFrame, ts: str, amount: str, watermark: str = "1 hour") -> DataFrame:
    """Amount per hour."""
    sums = _timed(rows, ts, watermark).groupBy(F.window(ts, "1 hour").alias("w")).agg(
        sum_amount(rows, amount).alias("revenue")
    )
    return sums.select(*_bounds("revenue"))


def rolling_rate(
    rows: DataFrame, ts: str, window: str = "5 minutes", slide: str = "1 minute", watermark: str = "10 minutes"
) -> DataFrame:
    """Rows and rows per second in a sliding window.

    Rows are counted per slide first; a sliding window adds up whole slides, so
    only these counts are repeated for the windows they fall into.
    """
    slides = _timed(rows, ts, watermark).groupBy(F.window(ts, slide).alias("slide")).agg(
        F.count(F.lit(1)).alias("events")
    )
    counts = slides.groupBy(F.window("slide", window, slide).alias("w")).agg(F.sum("events").alias("events"))
    return counts.select(*_bounds("events", ratio("events", F.lit(interval_seconds(window))).alias("tx_per_sec")))


def event_mix(
    rows: DataFrame, ts: str, event_type: str, window: str = "5 minutes", watermark: str = "10 minutes"
) -> DataFrame:
    """Events per type and window."""
    counts = (
        _timed(rows, ts, watermark)
        .groupBy(F.window(ts, window).alias("w"), event_type)
        .agg(F.count(F.lit(1)).alias("events"))
    )
    return counts.select(*_bounds(event_type, "events"))


def daily_funnel(
    rows: DataFrame, ts: str = "timestamp", event_type: str = "event_type", watermark: str = "1 day"
) -> DataFrame:
    """Events per day and type."""
    return event_mix(rows, ts, event_type, "1 day", watermark).select(
        F.to_date("window_start").alias("event_date"), event_type, F.col("events").alias("event_count")
    )


def rolling_kpis(
    rows: DataFrame,
    ts: str,
    amount: str,
    user: str,
    window: str = "1 hour",
    slide: str = "5 minutes",
    watermark: str = "1 hour",
    exact: bool = False,
) -> DataFrame:
    """Count, amount, mean amount and customers in a sliding window.

    Slides are summed first, as in ``rolling_rate``. A stream cannot count
    distinct values exactly; the sketches of its slides are united, with a
    relative error of about 2 percent. A batch may ask for the exact number.
    """
    if interval_seconds(window) % interval_seconds(slide):
        raise ValueError("the window must be a multiple of the slide")
    timed = _timed(rows, ts, watermark)
    sums = [F.count(F.lit(1)).alias("orders"), sum_amount(rows, amount).alias("revenue")]
    panes = F.window("slide", window, slide).alias("w")
    added = [F.sum("orders").alias("orders"), F.sum("revenue").alias("revenue")]
    if exact:
        slides = timed.groupBy(F.window(ts, slide).alias("slide"), user).agg(*sums)
        figures = slides.groupBy(panes).agg(*added, F.count_distinct(user).alias("customers"))
    else:
        slides = timed.groupBy(F.window(ts, slide).alias("slide")).agg(*sums, F.hll_sketch_agg(user).alias("sketch"))
        customers = F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("customers")
        figures = slides.groupBy(panes).agg(*added, customers)
    return figures.select(*_bounds("orders", "revenue", "customers", ratio("revenue", "orders").alias("avg_value")))
