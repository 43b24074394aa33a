"""Commit records of micro-batches, for sinks that cannot replace a batch by its number.

After a failure Spark hands a micro-batch to the writer again. A batch with a record is skipped. A batch that was written
but not recorded is written again, so the writer must leave out rows the sink already has (``append_new``); together
they make every batch count once, whatever the sink.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "batch bigint, rows bigint"


class CommitLog:
    """One small file per finished micro-batch in a shared folder; a record is complete when its file is there."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._store = hadoop(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._place = lambda number: hadoop(f"{self.folder}/commit={number}/_SUCCESS")

    def has(self, number: int) -> bool:
        return self._store.exists(self._place(number))

    def record(self, number: int, rows: int) -> None:
        """Written again, a record replaces itself."""
        row = self.spark.createDataFrame([(number, rows)], SCHEMA)
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/commit={number}")

    def records(self) -> DataFrame:
        """(batch, rows) of the finished batches; rows are those that arrived, known ones among them."""
        return self.spark.read.schema(SCHEMA).parquet(f"{self.folder}/commit=*")


def once_per_batch(write: Callable[[DataFrame, int], None], log: CommitLog) -> Callable[[DataFrame, int], None]:
    """A micro-batch writer that does nothing for a batch that is recorded as written."""

    def commit(batch: DataFrame, number: int) -> None:
        if log.has(number):
            return
        batch.persist()  # its rows are read by the writer and counted
        try:
            write(batch, number)
            log.record(number, batch.count())
        finally:
            batch.unpersist()

    return commit
