"""Relational tables over JDBC.

Credentials come from the caller or from the environment, never from code.
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..plans.staging import stage


def connection_properties(
    properties: Mapping[str, str] | None = None, prefix: str = "STALLBOOK_JDBC_"
) -> dict[str, str]:
    """Properties from <prefix>USER, <prefix>PASSWORD and <prefix>DRIVER, overridden by the argument."""
    found = {
        name.lower(): os.environ[prefix + name] for name in ("USER", "PASSWORD", "DRIVER") if prefix + name in os.environ
    }
    found.update(properties or {})
    return found


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    *,
    partition_column: str | None = None,
    bounds: tuple[int | str, int | str] | None = None,
    num_partitions: int | None = None,
    predicates: Sequence[str] | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """A whole table, read in parallel when a numeric or date column or a list of predicates is named."""
    props = {"fetchsize": str(fetch_size), **connection_properties(properties)}
    if predicates is not None:
        if partition_column is not None:
            raise ValueError("give either predicates or partition_column")
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=props)
    if partition_column is None:
        return spark.read.jdbc(url, table, properties=props)
    if bounds is None or num_partitions is None:
        raise ValueError("partition_column needs bounds and num_partitions")
    lower, upper = bounds
    return spark.read.jdbc(
        url,
        table,
        column=partition_column,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=num_partitions,
        properties=props,
    )


def write_jdbc(
    frame: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    *,
    mode: str = "overwrite",
    batch_size: int = 10_000,
    max_connections: int = 16,
) -> None:
    """Replace (keeping the table definition) or append; concurrent connections are bounded.

    The frame is staged first: what it has to compute then runs in as many
    tasks as it likes, and only the transfer in ``max_connections``.
    """
    writer = (
        stage(frame, "jdbc").write.mode(mode)
        .option("batchsize", str(batch_size))
        .option("numPartitions", str(max_connections))
        .option("truncate", str(mode == "overwrite").lower())
    )
    writer.jdbc(url, table, properties=connection_properties(properties))
