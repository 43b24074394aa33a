"""Document collections: JSON files, or a document-store connector when its jar is installed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_documents(
    spark: SparkSession,
    path: str | None = None,
    schema: str | StructType | None = None,
    *,
    source: str = "json",
    options: Mapping[str, str] | None = None,
    collection: str | None = None,
) -> DataFrame:
    """A collection with nested columns.

    ``options`` apply to this read only; ``collection`` overrides the one they
    name. Without a schema Spark infers one, which costs a pass over the data.
    """
    reader = spark.read.format(source)
    if schema is not None:
        reader = reader.schema(schema)
    if options:
        reader = reader.options(**options)
    if collection is not None:
        reader = reader.option("collection", collection)
    return reader.load(path) if path is not None else reader.load()


def recent_documents(
    docs: DataFrame,
    event_time: str = "timestamp",
    key: str = "event_id",
    within: str = "5 minutes",
    n: int = 100,
    as_of: Column | None = None,
) -> DataFrame:
    """The n latest documents of the last interval, newest key first.

    ``as_of`` defaults to the newest event, so that a replayed collection gives the same answer.
    """
    newest = docs.agg(F.max(event_time)).scalar() if as_of is None else as_of
    recent = docs.filter(F.col(event_time) >= newest - F.expr(f"INTERVAL {within}"))
    return recent.orderBy(F.desc(key)).limit(n)


def read_variants(spark: SparkSession, path: str | Sequence[str], document: str = "document") -> DataFrame:
    """JSON lines of any shapes as one VARIANT column: no schema, and no pass to infer one.

    A line that is no JSON gives null; lines without text give no row.
    """
    places = [path] if isinstance(path, str) else list(path)
    return spark.read.format("json").option("singleVariantColumn", document).load(places)


def lift(
    documents: DataFrame,
    fields: Mapping[str, tuple[str | Sequence[str], str]],
    document: str = "document",
) -> DataFrame:
    """The columns of ``documents`` but its VARIANT, and one column per field.

    ``fields`` maps a column to (path or paths, type). Shapes that keep a member in different places list all of them;
    the first that holds a value of the type counts. A member that is missing, null or of no fitting type gives null.
    """

    def member(paths: str | Sequence[str], kind: str) -> Column:
        places = [paths] if isinstance(paths, str) else paths
        return F.coalesce(*(F.try_variant_get(document, place, kind) for place in places))

    found = (member(paths, kind).alias(column) for column, (paths, kind) in fields.items())
    return documents.select(*(c for c in documents.columns if c != document), *found)


def shapes(documents: DataFrame, document: str = "document") -> DataFrame:
    """(shape, documents): the schemas that occur, and how often each; unreadable documents have the shape null."""
    shape = F.schema_of_variant(document).alias("shape")
    return documents.select(shape).groupBy("shape").agg(F.count(F.lit(1)).alias("documents"))


def common_schema(documents: DataFrame, document: str = "document") -> DataFrame:
    """One row (shape): the schema that fits all documents; members of unlike types are VARIANT in it."""
    readable = documents.filter(F.col(document).isNotNull())
    return readable.agg(F.schema_of_variant_agg(document).alias("shape"))
