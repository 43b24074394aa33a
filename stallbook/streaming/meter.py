"""Throughput of a stream, measured while its micro-batches are written: no batch is kept or read a second time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.monitor import rated
from .windows import event_time

SCHEMA = "batch bigint, events bigint, undated bigint, first timestamp, last timestamp"
_OBSERVED = SCHEMA.replace("timestamp", "bigint")


class BatchMeter:
    """Counts of every micro-batch, one small file each in a shared folder; a batch that comes again replaces its own."""

    def __init__(self, spark: SparkSession, folder: str, when: str):
        self.spark, self.folder, self.when = spark, folder.rstrip("/"), when
        self._keep([], "none")  # before its first batch the table is empty

    def _keep(self, found: list[tuple], number: int | str) -> None:
        reading = self.spark.createDataFrame(found, _OBSERVED)
        reading = reading.withColumns({end: F.timestamp_micros(end) for end in ("first", "last")})
        reading.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/reading={number}")

    def measured(self, write: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
        """A micro-batch writer that observes the rows as ``write`` writes them.

        ``write`` must run a job on the frame it is given, whose first one reads all rows. Counts are kept after it has
        ended, so a batch that fails has none. Inside ``once_per_batch`` recorded batches are not measured again.
        """

        def run(batch: DataFrame, number: int) -> None:
            seen = Observation()
            time = F.col(self.when)
            watched = event_time(batch, self.when).observe(
                seen,
                F.count(F.lit(1)).alias("events"),
                F.count_if(time.isNull()).alias("undated"),
                F.unix_micros(F.min(time)).alias("first"),
                F.unix_micros(F.max(time)).alias("last"),
            )
            write(watched.select(*batch.columns), number)
            found = seen.get
            self._keep([(number, *(found[name] for name in ("events", "undated", "first", "last")))], number)

        return run

    def readings(self) -> DataFrame:
        """(batch, events, undated, first, last) of the batches written so far."""
        return self.spark.read.schema(SCHEMA).parquet(f"{self.folder}/reading=*")

    def scorecard(self, target: float, seconds: float | None = None) -> DataFrame:
        """Events, true rate and PASS or FAIL of each batch that had rows.

        The rate is over ``seconds``, the trigger's interval, or else over the time between the first and the last
        event; a batch whose events are all of one time has then no rate, and fails.
        """
        span = (F.unix_micros("last") - F.unix_micros("first")) / F.lit(1_000_000.0)
        steps = self.readings().filter("events > 0")
        steps = steps.select("batch", "events", "first", "last", (span if seconds is None else F.lit(seconds)).alias("_span"))
        return rated(steps, target, F.col("_span")).drop("_span")
