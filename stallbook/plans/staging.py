"""Written intermediate results in the folder the cluster shares.

A staged table cuts lineage, keeps column pruning and survives the loss of
executors, which a cached or locally checkpointed frame does not.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def work_folder(spark: SparkSession) -> str:
    """The shared folder named by the session, else a folder beside the tables of the session's warehouse."""
    named = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/stallbook-work"


def new_folder(spark: SparkSession, label: str) -> str:
    path = f"{work_folder(spark)}/{label}-{uuid.uuid4().hex}"
    for area in _open_areas:
        area.append(path)
    return path


def stage(frame: DataFrame, label: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write the frame once and continue from the written files."""
    spark = frame.sparkSession
    path = new_folder(spark, label)
    writer = frame.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


_open_areas: list[list[str]] = []


@contextmanager
def temporary_stages(spark: SparkSession) -> Iterator[list[str]]:
    """Remove on leaving whatever was staged inside; results must be written or collected before."""
    area: list[str] = []
    _open_areas.append(area)
    try:
        yield area
    finally:
        _open_areas[:] = [a for a in _open_areas if a is not area]
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for path in area:
            place = hadoop(path)
            place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
