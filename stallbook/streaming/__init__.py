"""Live monitors. Every transformation takes a batch or a streaming DataFrame."""

from .commits import CommitLog, once_per_batch
from .ingest import (
    append_new,
    dedup_events,
    earliest_events,
    enrich_late,
    enrich_stream,
    run_to_table,
    stream_to_gold,
    without_known,
)
from .meter import BatchMeter
from .windows import (
    daily_funnel,
    event_mix,
    event_time,
    hourly_amount,
    orders_per_minute,
    rolling_kpis,
    rolling_rate,
)

__all__ = [
    "BatchMeter",
    "CommitLog",
    "append_new",
    "daily_funnel",
    "dedup_events",
    "earliest_events",
    "enrich_late",
    "enrich_stream",
    "event_mix",
    "event_time",
    "hourly_amount",
    "once_per_batch",
    "orders_per_minute",
    "rolling_kpis",
    "rolling_rate",
    "run_to_table",
    "stream_to_gold",
    "without_known",
]
