"""Session settings the library expects; a cluster sets the same ones itself."""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import SparkSession

# Settings that matter for results or for skewed joins. Memory, core and
# executor counts belong to the cluster and are left alone.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even when that costs one more exchange afterwards
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # shuffled bytes that one task is given: what it sorts and aggregates takes some twenty times as much, unpacked
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings to a running session, once."""
    if not getattr(spark, "_stallbook_ready", False):
        for key, value in DEFAULTS.items():
            spark.conf.set(key, value)
        spark._stallbook_ready = True
    return spark


def local_session(
    cores: int | str = "*",
    shuffle_partitions: int = 8,
    app: str = "stallbook",
    settings: Mapping[str, str] | None = None,
) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("STALLBOOK_DRIVER_MEMORY", "6g"))
    )
    for key, value in {**DEFAULTS, **(settings or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
