"""Idempotent ingest, enrichment and sinks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.sales import enrich_clicks, flatten_clicks
from ..plans.staging import new_folder
from .windows import event_time


def dedup_events(
    rows: DataFrame, key: str | Sequence[str] = "event_id", ts: str = "timestamp", watermark: str = "10 minutes"
) -> DataFrame:
    """One row per key.

    A batch keeps the earliest copy, ties by the other columns. A stream keeps
    the copy that arrives first and drops others within the watermark.
    """
    keys = [key] if isinstance(key, str) else list(key)
    timed = event_time(rows, ts)
    if not rows.isStreaming:
        rest = [c for c in timed.columns if c not in keys and c != ts]
        first = timed.groupBy(*keys).agg(F.min(F.struct(ts, *rest)).alias("_first"))
        return first.select(*(F.col(c) if c in keys else F.col("_first")[c].alias(c) for c in timed.columns))
    return timed.withWatermark(ts, watermark).dropDuplicatesWithinWatermark(keys)


def earliest_events(
    rows: DataFrame,
    key: str | Sequence[str] = "event_id",
    ts: str = "timestamp",
    within: str = "1 hour",
    watermark: str = "10 minutes",
) -> DataFrame:
    """The earliest copy of each key, in a stream as in a batch, in whatever order copies arrive.

    Copies of a key lie less than ``within`` apart, one from the next. A stream keeps a key's earliest copy as state and
    hands it on when the watermark is ``within`` past its last one; ties go by the other columns. So the state is
    bounded by the two intervals. Copies farther apart, or later than the watermark, are not the same event to it.
    Rows without key or time are left out.
    """
    keys = [key] if isinstance(key, str) else list(key)
    timed = event_time(rows, ts).dropna(subset=[*keys, ts])
    rest = [c for c in timed.columns if c not in keys and c != ts]
    if rows.isStreaming:
        timed = timed.withWatermark(ts, watermark)
    first = timed.groupBy(*keys, F.session_window(ts, within).alias("_copies")).agg(
        F.min(F.struct(F.col(ts).alias("_at"), *rest)).alias("_first")
    )
    at = {c: F.col(c) if c in keys else F.col("_first._at" if c == ts else f"_first.{c}") for c in timed.columns}
    return first.select(*(column.alias(c) for c, column in at.items()))


def without_known(rows: DataFrame, known: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """One row per key that the known table does not hold yet: an insert that ignores conflicts."""
    keys = [key] if isinstance(key, str) else list(key)
    return rows.dropDuplicates(keys).join(known.select(*keys), keys, "left_anti")


def append_new(
    load_known: Callable[[], DataFrame],
    write: Callable[[DataFrame], None],
    key: str | Sequence[str],
    ts: str | None = None,
) -> Callable[[DataFrame, int], None]:
    """A micro-batch writer that appends unknown keys only, so that a repeated batch adds nothing.

    With ``ts``, a column whose value belongs to the key (all copies of a row
    carry the same), only stored rows of the batch's own time range are read:
    on a table partitioned or sorted by it the work follows the batch, not the
    table.
    """

    def append(batch: DataFrame, number: int) -> None:
        known = load_known()
        if ts is not None:
            ends = batch.agg(F.min(ts).alias("low"), F.max(ts).alias("high")).first()
            known = known.filter(F.col(ts).between(ends["low"], ends["high"]) | F.col(ts).isNull())
        write(without_known(batch, known, key))

    return append


def enrich_stream(clicks: DataFrame, users: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Flattened clicks joined to a static user table."""
    return enrich_clicks(flatten_clicks(clicks), users, columns)


def enrich_late(
    clicks: DataFrame,
    users: DataFrame,
    key: str = "user_id",
    click_time: str = "timestamp",
    user_time: str = "signup_date",
    before: str = "1 day",
    after: str = "1 day",
    watermark: str = "1 hour",
) -> DataFrame:
    """Clicks with the columns of their user, where users are a stream too and may come after their clicks.

    A user's record counts for the clicks up to ``after`` later and up to ``before`` earlier than it. Both sides wait in
    state until the watermark has passed these bounds; a click that found no user by then comes out once, without one.
    So the state is bounded by the intervals, not by the number of users. Several records of a user in reach give a
    row each. Rows of either side without a time are left out, as they could never be closed. The other columns of
    ``users`` must not be named as those of ``clicks``. On batches the result is the same, without the wait.
    """
    timed = event_time(clicks, click_time).dropna(subset=[click_time])
    known = event_time(users, user_time).dropna(subset=[user_time]).withColumnRenamed(key, "_key")
    if clicks.isStreaming:
        timed = timed.withWatermark(click_time, watermark)
    if users.isStreaming:
        known = known.withWatermark(user_time, watermark)
    reach = F.col(user_time).between(
        F.col(click_time) - F.expr(f"INTERVAL {after}"), F.col(click_time) + F.expr(f"INTERVAL {before}")
    )
    return timed.join(known, (F.col(key) == F.col("_key")) & reach, "left_outer").drop("_key")


def stream_to_gold(
    rows: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    once: bool = True,
) -> StreamingQuery:
    """Start a query that hands every micro-batch to ``write``.

    The writer may see a batch again after a failure, so it should replace or
    deduplicate by the batch number it is given.
    """
    query = rows.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    return (query.trigger(availableNow=True) if once else query).start()


def run_to_table(rows: DataFrame, label: str, mode: str = "append") -> DataFrame:
    """Process everything that is there now into a shared folder and return it as a batch frame.

    Append mode gives each batch its own folder, so that a repeated batch
    overwrites itself; windows arrive when the watermark has closed them, and
    later rows are dropped. Complete mode replaces the table in every batch and
    keeps all windows: only for results that stay small.
    """
    spark = rows.sparkSession
    target = new_folder(spark, label)
    checkpoint = new_folder(spark, f"{label}-state")

    def write(batch: DataFrame, number: int | str) -> None:
        path = f"{target}/data" if mode == "complete" else f"{target}/batch={number}"
        batch.write.mode("overwrite").parquet(path)

    # an input without rows runs no batch, so the table starts out empty
    write(spark.createDataFrame([], rows.schema), "none")

    stream_to_gold(rows, write, checkpoint, mode).awaitTermination()
    place = f"{target}/data" if mode == "complete" else f"{target}/batch=*"
    return spark.read.schema(rows.schema).parquet(place)
