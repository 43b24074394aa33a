"""Catalog tables, in-memory rows and file outputs."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# The tables a dashboard loads, most important first.
SERVING_TABLES = (
    "gold_finance_pl",
    "gold_rfm_v2",
    "gold_churn",
    "gold_brand",
    "gold_nps",
    "gold_clv",
    "gold_abc",
    "gold_price_sensitivity",
    "gold_journey",
    "gold_affinity",
    "gold_seasonality_weekly",
    "gold_seasonality_hour",
    "gold_payment",
    "gold_city",
    "gold_returns",
    "gold_ml_association",
    "gold_inventory_v2",
)


def frame_from_rows(spark: SparkSession, rows: Iterable, schema: str | StructType) -> DataFrame:
    """A handful of literal rows as a table."""
    return spark.createDataFrame(list(rows), schema)


def load_table(spark: SparkSession, name: str, schema: str | StructType | None = None) -> DataFrame:
    """A catalog table; an empty frame of the declared schema when it does not exist.

    Any other failure (permissions, corrupt files) is raised, not hidden.
    """
    if spark.catalog.tableExists(name):
        return spark.table(name)
    return spark.createDataFrame([], schema if schema is not None else StructType([]))


def load_serving_tables(
    spark: SparkSession,
    names: Sequence[str] = SERVING_TABLES,
    schemas: Mapping[str, str | StructType] | None = None,
) -> dict[str, DataFrame]:
    """Lazy frames in the given order; nothing is read until a chart asks for it."""
    return {name: load_table(spark, name, (schemas or {}).get(name)) for name in names}


def schema_text(frame: DataFrame) -> str:
    """The schema as DDL, for logs and docs."""
    return ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in frame.schema.fields)


def preview(frame: DataFrame, n: int = 20) -> DataFrame:
    """The first n rows; a frame rather than a print, so that no job runs inside a build."""
    return frame.limit(n)


def write_table(
    frame: DataFrame,
    name: str,
    *,
    mode: str = "overwrite",
    path: str | None = None,
    partition_by: Sequence[str] = (),
    source: str = "parquet",
) -> None:
    """Save as a catalog table, or as plain files when a path is given."""
    writer = frame.write.mode(mode).format(source)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path is not None:
        writer.save(path)
    else:
        writer.saveAsTable(name)


def write_all(tables: Mapping[str, DataFrame], write: Callable[[DataFrame, str], None]) -> list[str]:
    """Write every table with the given writer; returns the names in order."""
    for name, frame in tables.items():
        write(frame, name)
    return list(tables)
