"""Readers, writers and input schemas."""

from .documents import common_schema, lift, read_documents, read_variants, recent_documents, shapes
from .jdbc import read_jdbc, write_jdbc
from .star import StarRetail
from .tables import (
    SERVING_TABLES,
    frame_from_rows,
    load_serving_tables,
    load_table,
    preview,
    schema_text,
    write_all,
    write_table,
)
from .timed import TimedTable

__all__ = [
    "SERVING_TABLES",
    "StarRetail",
    "TimedTable",
    "common_schema",
    "frame_from_rows",
    "lift",
    "load_serving_tables",
    "load_table",
    "preview",
    "read_documents",
    "read_jdbc",
    "read_variants",
    "recent_documents",
    "schema_text",
    "shapes",
    "write_all",
    "write_jdbc",
    "write_table",
]
