"""Canonical retail inputs derived from an order / line / part star schema.

Every member is a lazy DataFrame; nothing is cached or collected here. The
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

# Column types of the star tables. A declared schema spares one
# footer-reading job per table and per query.
STAR_SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

# Stages of the event funnel and label lists for the derived columns.
STAGES = ("view", "click", "signup", "purchase")
DEVICES = ("mobile", "desktop", "tablet")
SYSTEMS = ("android", "ios", "windows", "macos")
REFERRERS = ("search", "social", "email", "direct", "ads", "partner")
PRIORITIES = ("Low", "Medium", "High", "Urgent")


def _pick(labels: Sequence[str], number: str, name: str) -> str:
    """SQL for the label at position number modulo the length of the list."""
    listed = ", ".join(f"'{label}'" for label in labels)
    return f"get(array({listed}), pmod({number}, {len(labels)})) AS {name}"


class StarRetail:
    """Bronze tables of one data directory."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def raw(self, table: str) -> DataFrame:
        return self.spark.read.schema(STAR_SCHEMAS[table]).parquet(f"{self.folder}/{table}.parquet")

    @cached_property
    def items(self) -> DataFrame:
        """Order lines with the given line amount instead of a unit price.

        The amount stays as stored, so that only lines that pass the joins are
        converted to a decimal.
        """
        return self.raw("lineitem").selectExpr(
            "l_orderkey AS order_id",
            "l_partkey AS product_id",
            "CAST(l_quantity AS INT) AS quantity",
            "l_extendedprice AS line_amount",
        )

    @cached_property
    def orders(self) -> DataFrame:
        return self.raw("orders").selectExpr(
            "o_orderkey AS order_id",
            "o_custkey AS user_id",
            "o_orderdate AS order_date",
            "o_orderstatus AS status",
            "o_orderpriority AS payment_method",
            "CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 150 WHEN '2-HIGH' THEN 100 WHEN '3-MEDIUM' THEN 60 "
            "ELSE 0 END AS DECIMAL(8,2)) AS shipping_fee",
            "CAST(CASE WHEN o_orderkey % 10 < 3 THEN o_orderkey % 201 ELSE 0 END AS DECIMAL(8,2)) AS discount_amount",
        )

    @cached_property
    def products(self) -> DataFrame:
        return self.raw("part").selectExpr(
            "p_partkey AS product_id",
            "concat('SKU-', p_partkey) AS sku",
            "p_brand AS brand",
            "p_name AS name",
            "p_type AS category",
            "CAST(p_retailprice AS DECIMAL(10,2)) AS cost_price",
            "CAST(CAST(p_retailprice AS DECIMAL(10,2)) * 2 AS DECIMAL(10,2)) AS selling_price",
            "p_size * 20 AS stock_quantity",
            "CAST(10 + p_partkey % 41 AS INT) AS reorder_point",
            "p_partkey % 10 AS supplier_id",
        )

    @cached_property
    def suppliers(self) -> DataFrame:
        nation = self.raw("nation").selectExpr("n_nationkey AS s_nationkey", "n_name AS city")
        return (
            self.raw("supplier")
            .join(nation, "s_nationkey", "left")
            .selectExpr(
                "s_suppkey AS supplier_id",
                "s_name AS name",
                "city",
                "CASE WHEN s_acctbal >= 6000 THEN 'A' WHEN s_acctbal >= 2000 THEN 'B' ELSE 'C' END AS rating",
            )
        )

    @cached_property
    def users(self) -> DataFrame:
        nation = self.raw("nation").selectExpr("n_nationkey AS c_nationkey", "n_name AS city")
        return (
            self.raw("customer")
            .join(nation, "c_nationkey")
            .selectExpr(
                "c_custkey AS user_id",
                "c_name AS name",
                "concat(lower(c_name), '@example.com') AS email",
                "city",
                "c_mktsegment AS member_level",
                "date_add(DATE'1994-01-01', CAST(c_custkey % 365 AS INT)) AS signup_date",
            )
        )

    @cached_property
    def returns(self) -> DataFrame:
        return (
            self.raw("lineitem")
            .filter("l_returnflag = 'R'")
            .selectExpr(
                "l_orderkey AS order_id",
                "l_partkey AS product_id",
                "l_shipdate AS return_date",
                "l_linestatus AS reason",
                "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * "
                "(CAST(1 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,2)) AS refund_amount",
                "CASE WHEN l_linestatus = 'F' THEN 'Approved' ELSE 'Pending' END AS status",
            )
        )

    @cached_property
    def purchase_orders(self) -> DataFrame:
        headers = self.raw("orders").selectExpr("o_orderkey AS l_orderkey", "o_orderdate")
        cost = self.raw("part").selectExpr(
            "p_partkey AS l_partkey", "CAST(p_retailprice AS DECIMAL(10,2)) AS unit_cost"
        )
        return (
            self.raw("lineitem")
            .join(headers, "l_orderkey")
            .join(cost, "l_partkey")
            .selectExpr(
                "l_suppkey AS supplier_id",
                "l_partkey AS product_id",
                "CAST(l_quantity AS INT) AS quantity",
                "unit_cost",
                "o_orderdate AS order_date",
                "date_add(to_date(o_orderdate), 30) AS expected_date",
                "CASE WHEN l_linestatus = 'F' THEN to_date(l_shipdate) END AS received_date",
                "CASE WHEN l_linestatus = 'F' THEN 'Received' ELSE 'In Transit' END AS status",
            )
        )

    @cached_property
    def clicks(self) -> DataFrame:
        return self.clicks_of(self.raw("events"))

    def clicks_of(self, events: DataFrame) -> DataFrame:
        """Click documents with a nested metadata struct; ``timestamp`` stays zone-less."""
        return events.selectExpr("*", "CAST(get_json_object(props, '$.k') AS INT) AS k").selectExpr(
            "event_id",
            "user_id",
            "event_type",
            "ts AS timestamp",
            "value",
            _pick(DEVICES, "k", "device"),
            _pick(SYSTEMS, "k", "os"),
            _pick(REFERRERS, "k", "referrer"),
            "named_struct('url', concat('/page/', k), 'session_duration_sec', CAST(k AS STRING)) AS metadata",
            "CAST(NULL AS STRING) AS _id",
        )

    @cached_property
    def tickets(self) -> DataFrame:
        return (
            self.raw("events")
            .selectExpr("*", "CAST(get_json_object(props, '$.k') AS INT) AS k")
            .selectExpr(
                "event_id AS ticket_id",
                "user_id",
                "event_type AS type",
                _pick(PRIORITIES, "k", "priority"),
                "ts AS created_at",
                "nullif(k % 5, 0) AS satisfaction_score",
            )
        )
