"""Every operator as a named query over the star-schema test tables."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable, Sequence

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions import compact_number, joined
from ..operators import basket, behaviour, customers, distinct, finance, itemsets, monitor, products, serving
from ..operators.sales import (
    average_dwell,
    build_lines,
    build_sales,
    enrich_clicks,
    flatten_clicks,
    order_facts,
    order_rollup,
)
from ..session import prepare
from ..sources import (
    StarRetail,
    TimedTable,
    common_schema,
    lift,
    read_documents,
    read_variants,
    recent_documents,
    shapes,
    write_table,
)
from ..sources.star import STAGES, STAR_SCHEMAS
from ..streaming import (
    BatchMeter,
    CommitLog,
    append_new,
    daily_funnel,
    dedup_events,
    earliest_events,
    enrich_late,
    enrich_stream,
    event_mix,
    hourly_amount,
    once_per_batch,
    orders_per_minute,
    rolling_kpis,
    rolling_rate,
    run_to_table,
    stream_to_gold,
    without_known,
)
from .gold import Bronze, Rules, build_gold
from .monthly import TABLES as MONTHLY_TABLES
from .monthly import MonthlyGold
from .staging import new_folder, stage

# Thresholds under which every class of the test tables has members.
COMPLETED = "F"
PRICE = {"low": 50000, "mid": 50000, "high": 55000, "many": 5, "few": 5}
PROMOTER, PASSIVE = (15, 900000), (8, 400000)
CLV_TIERS = (500000, 300000, 100000)
# The reference's values.
RULE_SUPPORT, RULE_CONFIDENCE = 0.01, 0.1
TARGET_RATE = 0.004

Query = Callable[[StarRetail], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    _QUERIES[build.__name__] = build
    return build


def comparable(frame: DataFrame) -> DataFrame:
    """Plain column types that any engine can reproduce: bigint, double, string, boolean."""

    def plain(field: T.StructField):
        column, kind = F.col(field.name), field.dataType
        if isinstance(kind, T.DecimalType):
            column = column.cast("double")
        elif isinstance(kind, T.IntegralType):
            column = column.cast("bigint")
        elif isinstance(kind, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        return column.alias(field.name)

    return frame.select(*(plain(field) for field in frame.schema.fields))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(build: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: comparable(build(StarRetail(prepare(spark), folder)))

    return {name: bound(build) for name, build in _QUERIES.items()}


# --- shared inputs -------------------------------------------------------------------


def sales(star: StarRetail) -> DataFrame:
    return build_sales(
        star.items, star.orders, star.products, completed=COMPLETED, amount=F.col("line_amount")
    )


def lines(star: StarRetail) -> DataFrame:
    """For tables that need no product attribute; the source enforces the foreign key to the products."""
    return build_lines(star.items, star.orders, completed=COMPLETED, amount=F.col("line_amount"))


def orders_of(star: StarRetail) -> DataFrame:
    """One row per order of the fact, written once for tables that read it several times."""
    return stage(order_facts(sales(star)), "orders")


def churn(star: StarRetail) -> DataFrame:
    return customers.churn_risk(lines(star), star.users)


def pl(star: StarRetail) -> DataFrame:
    return finance.monthly_pl(order_rollup(sales(star)), finance.monthly_refunds(star.returns))


def inventory(star: StarRetail) -> DataFrame:
    return products.inventory_health(lines(star), star.products, star.suppliers)


def clusters(star: StarRetail, k: int, count_lines: bool = False) -> DataFrame:
    return customers.rfm_clusters(customers.rfm_features(lines(star), count_lines=count_lines), k=k)


def fitted_well(star: StarRetail, k: int, count_lines: bool = False) -> DataFrame:
    """What must hold for any good clustering, as one row.

    All users and their spend are there, k clusters are named in the order of
    mean spend, and nearly every user is nearest to its own cluster's centre.
    """
    found = stage(clusters(star, k, count_lines), "clusters")
    features = ("recency", "frequency", "monetary")
    scale = found.agg(F.struct(*(F.stddev(c).alias(c) for c in features))).scalar()
    scaled = found.select("prediction", "monetary", *(F.try_divide(c, scale[c]).alias(f"s_{c}") for c in features))
    means = scaled.groupBy("prediction").agg(*(F.avg(f"s_{c}").alias(f"s_{c}") for c in features))
    # k rows come to the driver and go back as literals
    away = [
        F.struct(
            sum(((F.col(f"s_{c}") - F.lit(m[f"s_{c}"])) ** 2 for c in features), F.lit(0.0)).alias("away"),
            F.lit(m["prediction"]).alias("at"),
        )
        for m in means.collect()
    ]
    nearest = scaled.select("monetary", (F.array_min(F.array(*away))["at"] == F.col("prediction")).alias("own"))
    named = customers.rfm_segments(found, labels=[f"{n:02d}" for n in range(k)])
    by_label = named.groupBy("customer_segment").agg(F.avg("monetary").alias("mean"))
    rising = by_label.select((F.col("mean") >= F.lag("mean", 1, 0.0).over(Window.orderBy("customer_segment"))).alias("up"))
    labels = rising.agg(F.struct(F.count(F.lit(1)).alias("segments"), F.bool_and("up").alias("rising"))).scalar()
    return nearest.agg(
        F.count(F.lit(1)).alias("users"),
        F.round(F.sum("monetary"), 2).alias("total"),
        (F.avg(F.col("own").cast("int")) >= 0.97).alias("near_own_centre"),
    ).select("users", "total", "near_own_centre", labels["segments"].alias("segments"), labels["rising"].alias("rising"))


def bronze_of(star: StarRetail) -> Bronze:
    return Bronze(
        items=star.items, orders=star.orders, products=star.products, users=star.users, returns=star.returns,
        suppliers=star.suppliers, purchase_orders=star.purchase_orders, clicks=star.clicks, tickets=star.tickets,
    )


def rules() -> Rules:
    return Rules(
        completed=COMPLETED, amount=F.col("line_amount"), clv_tiers=CLV_TIERS,
        price_bounds=(PRICE["low"], PRICE["mid"], PRICE["high"]), price_counts=(PRICE["many"], PRICE["few"]),
        promoter=PROMOTER, passive=PASSIVE, stages=STAGES, min_confidence=RULE_CONFIDENCE, min_support=RULE_SUPPORT,
    )


def gold_table(star: StarRetail, name: str) -> DataFrame:
    """One table of the gold build, written to a folder and loaded again."""
    build = build_gold(bronze_of(star), rules(), include_ml=False, only=(name,))
    folder = new_folder(star.spark, "gold")
    build.write(lambda frame, table: write_table(frame, table, path=f"{folder}/{table}"))
    return star.spark.read.parquet(f"{folder}/{name}")


def refreshed_table(star: StarRetail, name: str) -> DataFrame:
    """A table after a refresh: the first build had wrong orders in two months, one of them stored as another."""
    wrong, moved, to = "1995-03", "1995-05", "2030-01"
    month = F.date_format("order_date", "yyyy-MM")
    then = star.orders.where((month != wrong) | (F.col("order_id") % 3 != 0)).withColumn(
        "order_date", F.when(month == moved, F.lit(f"{to}-07").cast("timestamp_ntz")).otherwise(F.col("order_date"))
    )
    bronze = bronze_of(star)
    store = MonthlyGold(star.spark, new_folder(star.spark, "monthly"), rules(), (name,))
    store.refresh(dataclasses.replace(bronze, orders=then))
    store.refresh(bronze, [wrong, moved, to])
    return store.table(name, bronze)


def nps_classes(star: StarRetail) -> DataFrame:
    return customers.nps_segments(customers.nps_users(lines(star), PROMOTER, PASSIVE))


def event_stream(star: StarRetail) -> DataFrame:
    """The events table as a file stream; the pattern also matches a folder of part files."""
    return star.spark.readStream.schema(STAR_SCHEMAS["events"]).parquet(f"{star.folder}/event[s].parquet")


def arriving(star: StarRetail, rows: DataFrame, parts: Sequence[Column]) -> DataFrame:
    """A stream of events that come part after part, a micro-batch each.

    A part is written by all tasks, as equally many files as any other: files that are missing are added without rows.
    """
    spark, folder = star.spark, new_folder(star.spark, "events")
    files = max(spark.sparkContext.defaultParallelism, 1)
    for n, condition in enumerate(parts):
        path = f"{folder}/part={n}"
        own = rows.filter(condition)
        own.repartition(files).write.parquet(path)
        for _ in range(files - len(spark.read.schema(own.schema).parquet(path).inputFiles())):
            own.limit(0).coalesce(1).write.mode("append").parquet(path)
    reader = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files)
    return reader.parquet(f"{folder}/part=*")


MICROS = "unix_micros(CAST(ts AS timestamp))"


def time_ranges(star: StarRetail, parts: int) -> tuple[int, int, int]:
    """The first and the last time of the events and the length of a part, in microseconds."""
    ends = star.raw("events").agg(F.min("ts").alias("low"), F.max("ts").alias("high"))
    ends = ends.select(F.unix_micros(F.col("low").cast("timestamp")), F.unix_micros(F.col("high").cast("timestamp"))).first()
    low, high = ends[0] or 0, ends[1] or 0
    return low, high, (high - low) // parts + 1


def streamed(
    star: StarRetail,
    build: Callable[[DataFrame], DataFrame],
    label: str,
    parts: int = 3,
    again: Callable[[Column, int, int], Column] | None = None,
) -> DataFrame:
    """What a stream makes of the events that come by time in some parts.

    ``again`` selects rows that come once more at the end, by their time, the first and the last time in microseconds.
    """
    low, high, step = time_ranges(star, parts)
    at = F.expr(MICROS)
    conditions = [(at - low).between(n * step, (n + 1) * step - 1) for n in range(parts)]
    if again is not None:
        conditions.append(again(at, low, high))
    return run_to_table(build(arriving(star, star.raw("events"), conditions)), label)


# --- sales fact ----------------------------------------------------------------------


@query
def sales_fact(star):
    return sales(star).select(
        "order_id",
        "product_id",
        "user_id",
        "category",
        "quantity",
        "line_revenue",
        "line_cost",
        "line_profit",
        "order_month",
        "order_week",
    )


@query
def orders_rolled_up(star):
    return order_rollup(sales(star))


@query
def flat_clicks(star):
    return flatten_clicks(star.clicks).select("event_id", "user_id", "event_type", "url", "duration_sec")


@query
def enriched_clicks(star):
    clicks = flatten_clicks(star.clicks)
    return enrich_clicks(clicks, star.users, ["name", "city", "member_level"]).select(
        "event_id", "user_id", "duration_sec", "name", "city", "member_level"
    )


@query
def dwell_by_city(star):
    return average_dwell(enrich_clicks(flatten_clicks(star.clicks), star.users, ["city"]))


# --- finance -------------------------------------------------------------------------


@query
def sales_by_category(star):
    return finance.sales_by_category(sales(star))


@query
def daily_finance(star):
    return finance.daily_finance(sales(star))


@query
def monthly_refunds(star):
    return finance.monthly_refunds(star.returns)


@query
def monthly_refunds_approved(star):
    return finance.monthly_refunds(star.returns, ["Approved"])


@query
def monthly_pl(star):
    return pl(star)


@query
def category_performance(star):
    return finance.category_performance(sales(star))


@query
def weekly_trend(star):
    return finance.weekly_trend(sales(star))


@query
def discount_roi(star):
    return finance.discount_roi(sales(star))


@query
def payment_mix(star):
    return finance.payment_mix(lines(star))


# --- products ------------------------------------------------------------------------


@query
def product_performance(star):
    return products.product_performance(lines(star), star.products)


@query
def inventory_health(star):
    return inventory(star)


@query
def returns_breakdown(star):
    return products.returns_breakdown(star.returns, star.products)


@query
def return_rate(star):
    return products.return_rate(sales(star), star.returns, star.products)


@query
def supplier_scorecard(star):
    return products.supplier_scorecard(star.purchase_orders, star.suppliers)


@query
def abc_pareto(star):
    return products.abc_pareto(lines(star), star.products)


@query
def abc_distribution(star):
    return products.abc_distribution(products.abc_pareto(lines(star), star.products))


@query
def brand_performance(star):
    return products.brand_performance(sales(star), star.returns, star.products)


@query
def category_affinity(star):
    return products.category_affinity(sales(star))


@query
def top_pairs(star):
    return products.top_pairs(products.category_affinity(sales(star)))


@query
def affinity_matrix(star):
    return products.affinity_matrix(products.category_affinity(sales(star)))


# --- customers -----------------------------------------------------------------------


@query
def member_summary(star):
    return customers.member_summary(lines(star), star.users)


@query
def rfm_features(star):
    return customers.rfm_features(lines(star))


@query
def rfm_features_by_line(star):
    return customers.rfm_features(lines(star), count_lines=True)


@query
def rfm_segments(star):
    return customers.rfm_segments(clusters(star, 5), star.users)


@query
def rfm_segments_four(star):
    return customers.rfm_segments(clusters(star, 4, count_lines=True), star.users, customers.SEGMENTS_4)


@query
def cluster_profile(star):
    return customers.cluster_profile(clusters(star, 5))


@query
def clusters_of_five(star):
    return fitted_well(star, 5)


@query
def clusters_of_four(star):
    return fitted_well(star, 4, count_lines=True)


@query
def cohort_retention(star):
    return customers.cohort_retention(lines(star))


@query
def city_sales(star):
    return customers.city_sales(sales(star), star.users)


@query
def clv(star):
    return customers.clv(sales(star), star.users, CLV_TIERS)


@query
def churn_risk(star):
    return churn(star)


@query
def churn_summary(star):
    return customers.churn_summary(churn(star))


@query
def churn_distribution(star):
    return customers.churn_distribution(churn(star))


@query
def price_sensitivity(star):
    return customers.price_sensitivity(lines(star), **PRICE)


@query
def sensitivity_stats(star):
    return customers.sensitivity_stats(customers.price_sensitivity(lines(star), **PRICE))


@query
def nps_segments(star):
    return nps_classes(star)


@query
def nps_score(star):
    return customers.nps_score(nps_classes(star))


@query
def nps_score_reference_form(star):
    return customers.nps_score(nps_classes(star), reference_form=True)


@query
def inactivity_histogram(star):
    return customers.inactivity_histogram(churn(star))


@query
def at_risk_top(star):
    return customers.at_risk_top(churn(star))


@query
def user_baskets(star):
    return basket.baskets(sales(star)).select("user_id", joined("items").alias("items"))


@query
def association_rules(star):
    return basket.association_rules(basket.baskets(sales(star)), RULE_SUPPORT, RULE_CONFIDENCE)


@query
def vertical_rules(star):
    return itemsets.vertical_rules(sales(star), "user_id", "name", RULE_SUPPORT, RULE_CONFIDENCE)


@query
def category_rules(star):
    """Rules of one and more categories bought together in an order, at one percent support."""
    return basket.association_rules(basket.baskets(sales(star), "order_id", "category"), 0.01, RULE_CONFIDENCE)


# --- behaviour -----------------------------------------------------------------------


@query
def daily_events(star):
    return behaviour.daily_event_funnel(star.clicks)


@query
def channel_attribution(star):
    return behaviour.channel_attribution(star.clicks)


@query
def device_breakdown(star):
    return behaviour.device_breakdown(star.clicks)


@query
def support_summary(star):
    return behaviour.support_summary(star.tickets)


@query
def weekday_hour_heatmap(star):
    return behaviour.weekday_hour_heatmap(star.clicks, "timestamp", "value", "event_id")


@query
def weekday_seasonality(star):
    return behaviour.weekday_seasonality(lines(star))


@query
def hour_seasonality(star):
    return behaviour.hour_seasonality(star.clicks, "timestamp", "value")


@query
def funnel_conversion(star):
    return behaviour.funnel_conversion(star.clicks, STAGES)


@query
def funnel_reference_form(star):
    return behaviour.funnel_conversion(star.clicks, STAGES, reference_form=True)


@query
def dropoff_stages(star):
    return behaviour.dropoff_stages(behaviour.funnel_conversion(star.clicks, STAGES))


# --- dashboard figures ---------------------------------------------------------------


@query
def executive_kpis(star):
    orders = orders_of(star)
    monthly = finance.monthly_pl(order_rollup(orders), finance.monthly_refunds(star.returns))
    return serving.executive_kpis(monthly, customers.churn_risk(orders, star.users))


@query
def revenue_series(star):
    return serving.revenue_series(pl(star))


@query
def brand_share(star):
    return serving.brand_share(products.brand_performance(sales(star), star.returns, star.products))


@query
def finance_points(star):
    return serving.finance_points(pl(star))


@query
def churn_points(star):
    orders = orders_of(star)
    return serving.churn_points(customers.churn_risk(orders, star.users), customers.rfm_features(orders))


@query
def rfm_points(star):
    return serving.rfm_points(customers.rfm_features(lines(star)))


@query
def stock_points(star):
    return serving.stock_points(inventory(star))


@query
def stage_points(star):
    return serving.stage_points(behaviour.funnel_conversion(star.clicks, STAGES))


@query
def hour_points(star):
    return serving.hour_points(behaviour.hour_seasonality(star.clicks, "timestamp", "value"))


@query
def compact_totals(star):
    """Order amounts as display text."""
    total = star.raw("orders").select("o_orderkey", "o_totalprice")
    return total.select(
        F.col("o_orderkey").alias("order_id"),
        compact_number("o_totalprice").alias("shown"),
        compact_number(F.col("o_totalprice") * 10000, currency=False).alias("shown_large"),
        compact_number(F.col("o_totalprice") / 1000).alias("shown_small"),
    )


# --- monitoring ----------------------------------------------------------------------


@query
def table_inventory(star):
    names = ("orders", "lineitem", "customer", "part", "supplier", "events")
    return monitor.table_inventory(star.spark, {name: star.raw(name) for name in names})


@query
def table_rows(star):
    names = ("orders", "lineitem", "customer", "part", "supplier", "events")
    return monitor.table_inventory(star.spark, {name: star.raw(name) for name in names}).select("table_name", "row_count")


@query
def documents_round_trip(star):
    """Events written as documents and read again."""
    folder = new_folder(star.spark, "documents")
    star.raw("events").select("event_id", "user_id", "event_type", "value").write.json(folder)
    return read_documents(star.spark, folder, "event_id bigint, user_id bigint, event_type string, value double")


# Where the shapes of click documents keep their members.
CLICK_FIELDS = {
    "event_id": ("$.event_id", "bigint"),
    "user_id": ("$.user_id", "bigint"),
    "event_type": ("$.event_type", "string"),
    "url": (("$.metadata.url", "$.metadata.page.url"), "string"),
    "duration_sec": (("$.metadata.session_duration_sec", "$.metadata.session.duration_sec"), "int"),
}


def mixed_documents(star: StarRetail) -> DataFrame:
    """Clicks as JSON lines of three shapes, without metadata, with flat and with nested ones; some lines are cut short."""
    head = ("event_id", "user_id", "event_type")
    url, seconds = F.col("metadata.url"), F.col("metadata.session_duration_sec")
    nested = F.struct(F.struct(url.alias("url")).alias("page"), F.struct(seconds.cast("int").alias("duration_sec")).alias("session"))
    line = (
        F.when(F.col("event_id") % 3 == 0, F.to_json(F.struct(*head)))
        .when(F.col("event_id") % 3 == 1, F.to_json(F.struct(*head, "metadata")))
        .otherwise(F.to_json(F.struct(*head, nested.alias("metadata"))))
    )
    line = F.when(F.col("event_id") % 97 == 0, line.substr(F.lit(1), F.length(line) - 1)).otherwise(line)
    folder = new_folder(star.spark, "mixed")
    star.clicks.select(line.alias("value")).write.text(folder)
    return read_variants(star.spark, folder)


@query
def mixed_clicks(star):
    return lift(mixed_documents(star).filter("document IS NOT NULL"), CLICK_FIELDS)


@query
def mixed_shapes(star):
    """The shapes that occur, and the one that fits all of them."""
    found = mixed_documents(star)
    every = common_schema(found).select(F.concat(F.lit("all: "), "shape").alias("shape"))
    return shapes(found).unionByName(every.withColumn("documents", F.lit(None).cast("bigint")))


@query
def minute_trend_last_hour(star):
    return monitor.minute_trend(star.clicks, "timestamp", within="1 hour")


@query
def collection_counts(star):
    return monitor.collection_counts({"clickstream": star.clicks, "support_tickets": star.tickets})


@query
def live_kpis(star):
    return monitor.live_kpis(star.clicks, "timestamp", "user_id", "value")


@query
def recent_orders(star):
    return monitor.recent_orders(star.orders, star.users)


@query
def recent_events(star):
    recent = recent_documents(star.clicks, within="1 day")
    return recent.select("event_id", "user_id", "event_type", "timestamp")


@query
def recent_event_types(star):
    return monitor.event_types(recent_documents(star.clicks, within="1 day"))


@query
def status_distribution(star):
    return monitor.status_distribution(star.orders)


@query
def minute_trend(star):
    return monitor.minute_trend(star.clicks, "timestamp")


@query
def throughput_scorecard(star):
    return monitor.throughput_scorecard(star.clicks, "timestamp", TARGET_RATE, "1 hour", 3600)


@query
def latency_classes(star):
    timed = star.clicks.select(monitor.latency_class(F.col("value") * 10).alias("latency_class"))
    return timed.groupBy("latency_class").agg(F.count(F.lit(1)).alias("requests"))


@query
def latest_months(star):
    return monitor.latest_rows(pl(star), "order_month", 100)


@query
def latest_rfm(star):
    return monitor.latest_rows(customers.rfm_features(lines(star)), "user_id", 100)


@query
def order_line_sample(star):
    return monitor.order_line_sample(star.orders, star.items)


# --- live figures from tables laid out by time -------------------------------------------


def timed(star: StarRetail, rows: DataFrame, when: str, period: str, label: str) -> TimedTable:
    """The rows in two appends, the newer half first."""
    table = TimedTable(star.spark, new_folder(star.spark, label), rows.schema, when, period)
    ends = rows.agg(F.min(when).alias("low"), F.max(when).alias("high"))
    middle = ends.select((F.col("low") + (F.col("high") - F.col("low")) / 2).cast("string")).first()[0]
    newer = F.coalesce(F.col(when) >= F.lit(middle).cast(rows.schema[when].dataType), F.lit(False))
    for half in (newer, ~newer):
        table.append(rows.filter(half))
    return table


def timed_clicks(star: StarRetail) -> TimedTable:
    plain = star.clicks.select("event_id", "user_id", "event_type", "timestamp", "value")
    return timed(star, plain, "timestamp", "hour", "clicks")


@query
def timed_recent_events(star):
    return timed_clicks(star).recent("1 day", inclusive=True).select(
        "event_id", "user_id", "event_type", "timestamp"
    ).orderBy(F.desc("event_id")).limit(100)


@query
def timed_recent_orders(star):
    """The ten newest orders from the newest days, then their customers."""
    orders = timed(star, star.orders, "order_date", "day", "orders")
    return monitor.recent_orders(orders.latest(10, "order_id"), star.users)


@query
def timed_minute_trend(star):
    """Minutes of the last hour; the whole table is not read for its newest time."""
    return monitor.minute_trend(timed_clicks(star).recent("1 hour"), "timestamp")


@query
def timed_live_kpis(star):
    """One pass over the table, whose end comes from its newest hour."""
    table = timed_clicks(star)
    return monitor.live_kpis(table.rows(), "timestamp", "user_id", "value", as_of=table.as_of())


# --- live monitors: once as a batch, once as a stream over the same files ------------


@query
def orders_by_minute(star):
    return orders_per_minute(star.clicks, "timestamp")


@query
def amount_by_hour(star):
    return hourly_amount(star.clicks, "timestamp", "value")


@query
def sliding_rate(star):
    return rolling_rate(star.clicks, "timestamp")


@query
def event_mix_by_window(star):
    return event_mix(star.clicks, "timestamp", "event_type")


@query
def sliding_kpis(star):
    return rolling_kpis(star.clicks, "timestamp", "value", "user_id", exact=True)


@query
def deduplicated_events(star):
    twice = star.raw("events").unionByName(star.raw("events"))
    return dedup_events(twice, "event_id", "ts").select("event_id", "user_id", "event_type")


@query
def orders_without_conflicts(star):
    """Every order arrives twice; completed ones are stored already."""
    known = star.orders.filter(F.col("status") == COMPLETED)
    arriving = star.orders.unionByName(star.orders)
    return without_known(arriving, known, "order_id").select("order_id", "user_id", "status")


@query
def stream_orders_by_minute(star):
    return streamed(star, lambda rows: orders_per_minute(rows, "ts"), "minutes")


@query
def stream_late_rows(star):
    """The first day's events come again after the watermark has passed them, and are dropped."""
    again = lambda at, low, high: at < low + 86_400_000_000
    return streamed(star, lambda rows: orders_per_minute(rows, "ts"), "late", again=again)


@query
def stream_amount_by_hour(star):
    return streamed(star, lambda rows: hourly_amount(rows, "ts", "value"), "hours")


@query
def stream_sliding_rate(star):
    return streamed(star, lambda rows: rolling_rate(rows, "ts"), "rates")


@query
def stream_event_mix(star):
    return streamed(star, lambda rows: event_mix(rows, "ts", "event_type"), "mix")


@query
def stream_daily_funnel(star):
    return streamed(star, lambda rows: daily_funnel(rows, "ts"), "funnel")


@query
def stream_sliding_kpis(star):
    """Exact figures of the closed windows, and whether the sketch of the customers is within ten percent."""
    found = streamed(star, lambda rows: rolling_kpis(rows, "ts", "value", "user_id"), "kpis")
    exact = rolling_kpis(star.clicks, "timestamp", "value", "user_id", exact=True)
    truth = exact.select("window_start", F.col("customers").alias("true_customers"))
    near = F.abs(F.col("customers") - F.col("true_customers")) <= F.col("true_customers") * 0.1
    return found.join(truth, "window_start").select(
        "window_start", "window_end", "orders", "revenue", "avg_value", near.alias("customers_near")
    )


@query
def stream_deduplicated(star):
    """Each event of the last twelve hours arrives twice, in different micro-batches."""
    again = lambda at, low, high: at > high - 43_200_000_000
    unique = lambda rows: dedup_events(rows, "event_id", "ts", "1 day").select("event_id", "user_id", "event_type")
    return streamed(star, unique, "unique", again=again)


def copied_events(star: StarRetail) -> DataFrame:
    """The events, and of every third a copy that is five minutes younger and says otherwise."""
    events = star.raw("events")
    copies = events.filter("event_id % 3 = 0").withColumns(
        {"ts": F.expr("ts + INTERVAL 5 MINUTES"), "event_type": F.upper("event_type"), "value": F.col("value") + 1}
    )
    return events.withColumn("copy", F.lit(False)).unionByName(copies.withColumn("copy", F.lit(True)))


@query
def stream_earliest(star):
    """Half of the events of the twelve hours before a part ends come a part late, long after their copies."""
    parts, half_day = 3, 43_200_000_000
    low, high, step = time_ranges(star, parts)
    own = F.floor((F.expr(MICROS) - F.when(F.col("copy"), 300_000_000).otherwise(0) - low) / step)
    late = ~F.col("copy") & (F.col("event_id") % 2 == 0) & (F.expr(MICROS) >= low + (own + 1) * step - half_day)
    part = F.least(own + late.cast("int"), F.lit(parts - 1))
    stream = arriving(star, copied_events(star), [part == n for n in range(parts)]).drop("copy")
    first = earliest_events(stream, "event_id", "ts", "1 hour", "1 day").select("event_id", "user_id", "event_type", "ts", "value")
    return run_to_table(first, "earliest")


@query
def earliest_of_copies(star):
    first = earliest_events(copied_events(star).drop("copy"), "event_id", "ts", "1 hour")
    return first.select("event_id", "user_id", "event_type", "ts", "value")


@query
def stream_appended(star):
    """A table that holds every fifth event gets all of them, some twice; once the writer dies after it has written."""
    folder = new_folder(star.spark, "appended")
    events = star.raw("events")
    events.filter("event_id % 5 = 0").write.parquet(f"{folder}/table")
    load = lambda: star.spark.read.schema(events.schema).parquet(f"{folder}/table")
    log = CommitLog(star.spark, f"{folder}/commits")
    append = append_new(load, lambda new: new.write.mode("append").parquet(f"{folder}/table"), "event_id", "ts")
    dies = {1}

    def write(batch: DataFrame, number: int) -> None:
        append(batch, number)
        if number in dies:
            dies.remove(number)
            raise RuntimeError("the writer is lost after writing and before its record")

    low, high, step = time_ranges(star, 2)
    at = F.expr(MICROS)
    stream = arriving(star, events, [at < low + step, at >= low + step - 43_200_000_000])
    try:
        stream_to_gold(stream, once_per_batch(write, log), f"{folder}/state").awaitTermination()
    except StreamingQueryException:  # started again, the query gets the same batch once more
        stream_to_gold(stream, once_per_batch(write, log), f"{folder}/state").awaitTermination()
    return load().select("event_id", "user_id", "event_type")


@query
def stream_enriched(star):
    clicks = star.clicks_of(event_stream(star))
    enriched = enrich_stream(clicks, star.users, ["name", "city"])
    return run_to_table(
        enriched.select("event_id", "user_id", "url", "duration_sec", "name", "city"), "enriched", mode="append"
    )


def registered(star: StarRetail) -> DataFrame:
    """Users with the time of their record: some hours before or after their first event, for some of them days."""
    first = star.raw("events").groupBy("user_id").agg(F.min("ts").alias("first_seen"))
    hours = F.pmod(F.col("user_id") * 7, F.lit(60)) - 20
    at = F.col("first_seen") + F.make_dt_interval(hours=hours)
    return first.select("user_id", at.alias("recorded"), F.concat(F.lit("user "), "user_id").alias("label"))


LAST = "TIMESTAMP_NTZ '2100-01-01 00:00:00'"


@query
def stream_late_users(star):
    """Clicks and users as two streams, by time in three parts; a last row far ahead closes each of them."""
    low, high, step = time_ranges(star, 3)

    def parts(when: str) -> list[Column]:
        at = F.unix_micros(F.col(when).cast("timestamp"))
        return [at < low + step, (at >= low + step) & (at < low + 2 * step), at >= low + 2 * step]

    clicks = star.raw("events").select("event_id", "user_id", "ts")
    end = star.spark.range(1)
    clicks = clicks.unionByName(end.selectExpr("-1L AS event_id", "-1L AS user_id", f"{LAST} AS ts"))
    users = registered(star).unionByName(end.selectExpr("-2L AS user_id", f"{LAST} AS recorded", "'' AS label"))
    joined_up = enrich_late(
        arriving(star, clicks, parts("ts")), arriving(star, users, parts("recorded")), "user_id", "ts", "recorded"
    )
    found = run_to_table(joined_up.select("event_id", "user_id", "ts", "label", "recorded"), "late-users")
    return found.filter("event_id >= 0")  # on the stream this would be pushed below the watermark


@query
def late_users(star):
    clicks = star.raw("events").select("event_id", "user_id", "ts")
    return enrich_late(clicks, registered(star), "user_id", "ts", "recorded").select(
        "event_id", "user_id", "ts", "label", "recorded"
    )


@query
def stream_throughput(star):
    """The scorecard of a stream's three micro-batches, from what was observed while they were written."""
    low, high, step = time_ranges(star, 3)
    at = F.expr(MICROS) - low
    stream = arriving(star, star.raw("events"), [at.between(n * step, (n + 1) * step - 1) for n in range(3)])
    folder = new_folder(star.spark, "metered")
    meter = BatchMeter(star.spark, f"{folder}/readings", "ts")
    write = lambda batch, number: batch.write.mode("overwrite").parquet(f"{folder}/table/batch={number}")
    stream_to_gold(stream, meter.measured(write), f"{folder}/state").awaitTermination()
    return meter.scorecard(TARGET_RATE)


# --- exact distinct counts from stored bitmaps -----------------------------------------


def buyers_by_month(star: StarRetail) -> DataFrame:
    """Bitmaps of the users who bought, per city and month, written once."""
    bought = lines(star).join(star.users.select("user_id", "city"), "user_id")
    return stage(distinct.distinct_bitmaps(bought, ["city", "order_month"], "user_id"), "buyers")


@query
def yearly_buyers_by_city(star):
    year = F.substring("order_month", 1, 4)
    counts = distinct.distinct_counts(buyers_by_month(star).withColumn("year", year), ["city", "year"], "buyers")
    return counts.select("city", "year", "buyers")


@query
def quarterly_active_buyers(star):
    """Buyers of each month and the two before it."""
    return distinct.rolling_counts(buyers_by_month(star), "order_month", [], 3, "buyers")


# --- the gold build: each table through write and load, with the SQL of the query of the same content ----------------

GOLD_TABLES = {
    "gold_sales_performance": "sales_by_category",
    "gold_finance": "daily_finance",
    "gold_inventory": "product_performance",
    "gold_members": "member_summary",
    "gold_finance_pl": "monthly_pl",
    "gold_category": "category_performance",
    "gold_inventory_v2": "inventory_health",
    "gold_cohort": "cohort_retention",
    "gold_returns": "returns_breakdown",
    "gold_return_rate": "return_rate",
    "gold_supplier": "supplier_scorecard",
    "gold_weekly_sales": "weekly_trend",
    "gold_channel": "channel_attribution",
    "gold_abc": "abc_pareto",
    "gold_brand": "brand_performance",
    "gold_discount": "discount_roi",
    "gold_payment": "payment_mix",
    "gold_city": "city_sales",
    "gold_clv": "clv",
    "gold_churn": "churn_risk",
    "gold_price_sensitivity": "price_sensitivity",
    "gold_journey": "funnel_conversion",
    "gold_affinity": "category_affinity",
    "gold_nps": "nps_segments",
    "gold_seasonality_weekly": "weekday_seasonality",
}


def _through_gold(name: str) -> Query:
    return lambda star: gold_table(star, name)


_QUERIES.update({name: _through_gold(name) for name in GOLD_TABLES})

# --- gold tables of monthly parts, after some months have changed ------------------------

REFRESHED = {
    f"refreshed_{query}": table
    for table, query in GOLD_TABLES.items()
    if table in MONTHLY_TABLES
}


def _after_refresh(table: str) -> Query:
    return lambda star: refreshed_table(star, table)


_QUERIES.update({name: _after_refresh(table) for name, table in REFRESHED.items()})
