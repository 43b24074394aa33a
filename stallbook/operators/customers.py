"""Members, RFM, cohorts, lifetime value, churn, price sensitivity and promoter tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import flag_count, half_up, month_key, percent, ratio, tier
from ..functions.bands import first_match
from ..plans.shares import share_of_total
from ..plans.staging import stage
from .sales import spend_by_user, sums_by_order, sums_by_user

# Labels, from the cluster with the lowest mean spend to the highest.
SEGMENTS_5 = ("Hibernating", "New / Potential", "At Risk", "Loyal", "Champions")
SEGMENTS_4 = ("流失危機客 (At Risk)", "潛力新客 (Potential)", "一般客戶 (Standard)", "忠誠大戶 (Champions)")

# Churn, lifetime and promoter labels.
NO_PURCHASE = "New - No Purchase"
CLV_LABELS = ("Platinum", "Gold", "Silver")
PROMOTER, PASSIVE, DETRACTOR = "Promoter (9-10)", "Passive (7-8)", "Detractor (0-6)"


def member_summary(sales: DataFrame, users: DataFrame) -> DataFrame:
    """Customers, spend and sales rows per member level.

    Sales are reduced to one row per user first: customers are then rows, and
    the join carries users instead of lines.
    """
    levels = (
        spend_by_user(sales).join(users.select("user_id", "member_level"), "user_id")
        .groupBy("member_level")
        .agg(
            F.count(F.lit(1)).alias("total_customers"),
            F.sum("revenue").alias("total_spent"),
            F.sum("lines").alias("total_orders"),
        )
    )
    return levels.withColumn("avg_spent_per_user", ratio("total_spent", "total_customers"))


def _ended(per_user: DataFrame, last: str, as_of: Column | None) -> tuple[DataFrame, Column]:
    """The user table and the day its period ends.

    The newest purchase is only known after all users are; the user table is
    then staged (one job), so that the sales are not read a second time for it.
    """
    if as_of is not None:
        return per_user, as_of
    staged = stage(per_user, "users")
    return staged, staged.agg(F.max(last)).scalar()


def rfm_features(sales: DataFrame, as_of: Column | None = None, count_lines: bool = False) -> DataFrame:
    """Days since the last purchase, orders (or sales rows) and spend per user.

    Without ``as_of`` the newest purchase ends the period, see ``_ended``.
    """
    users, today = _ended(sums_by_user(sales), "last_purchase", as_of)
    return users.select(
        "user_id",
        F.datediff(today, "last_purchase").alias("recency"),
        F.col("lines" if count_lines else "orders").alias("frequency"),
        F.col("revenue").alias("monetary"),
    )


def rfm_clusters(rfm: DataFrame, k: int = 5, seed: int = 42, partitions: int = 16) -> DataFrame:
    """Cluster number per user: standardised features, k-means.

    Runs jobs: the features are staged once and read by both fits. The seeded
    start depends on how the users are laid out, so ``partitions`` belongs to
    the seed: the layout follows the user and this number, not the session.
    Fewer than two users cannot be clustered, which is an error; MLlib cannot
    look for more than two clusters in two points, so two users are two.
    """
    features = ["recency", "frequency", "monetary"]
    numeric = rfm.select("user_id", *(F.col(name).cast("double").alias(name) for name in features))
    staged = stage(numeric, "rfm")
    users = staged.limit(3).count()
    if users < 2:
        raise ValueError("k-means needs two users at least")
    placed = staged.repartition(partitions, "user_id").sortWithinPartitions("user_id")
    steps = Pipeline(
        stages=[
            VectorAssembler(inputCols=features, outputCol="features"),
            StandardScaler(inputCol="features", outputCol="scaled", withStd=True, withMean=True),
            KMeans(featuresCol="scaled", predictionCol="prediction", k=k if users > 2 else 2, seed=seed),
        ]
    )
    return steps.fit(placed).transform(staged).select("user_id", *features, "prediction")


def cluster_profile(clusters: DataFrame) -> DataFrame:
    """Users and mean features per cluster."""
    return clusters.groupBy("prediction").agg(
        F.count(F.lit(1)).alias("users"),
        F.avg("recency").alias("avg_r"),
        F.avg("frequency").alias("avg_f"),
        F.avg("monetary").alias("avg_m"),
    )


def rfm_segments(clusters: DataFrame, users: DataFrame | None = None, labels: Sequence[str] = SEGMENTS_5) -> DataFrame:
    """A name per user, given to clusters by their rank in mean spend.

    Cluster numbers are arbitrary, so they carry no meaning of their own. The
    ranking runs over one row per cluster.
    """
    by_spend = Window.orderBy("avg_m", "prediction")
    position = F.row_number().over(by_spend)
    names = F.array(*(F.lit(label) for label in labels))
    named = cluster_profile(clusters).select(
        "prediction",
        F.coalesce(F.get(names, position - 1), F.concat(F.lit("Segment "), position.cast("string"))).alias(
            "customer_segment"
        ),
    )
    labelled = clusters.join(F.broadcast(named), "prediction")
    if users is None:
        return labelled
    wanted = [c for c in ("name", "email", "city", "member_level", "signup_date") if c in users.columns]
    return labelled.join(users.select("user_id", *wanted), "user_id")


def cohort_retention(sales: DataFrame) -> DataFrame:
    """Users of each first-purchase month who bought again n months later.

    A user is reduced to the set of months with a purchase, which is bounded by
    the calendar; its minimum is the cohort.
    """
    months = sales.groupBy("user_id").agg(F.collect_set(F.trunc("order_date", "month")).alias("months"))
    active = months.select(F.array_min("months").alias("first"), F.explode("months").alias("month"))
    return (
        active.groupBy("first", "month")
        .agg(F.count(F.lit(1)).alias("active_users"))
        .select(
            month_key("first").alias("cohort_month"),
            F.months_between("month", "first").cast("int").alias("months_since_first"),
            "active_users",
        )
    )


def city_sales(sales: DataFrame, users: DataFrame) -> DataFrame:
    """Customers, orders, revenue and profit per city."""
    cities = (
        sums_by_user(sales)
        .join(users.select("user_id", "city"), "user_id")
        .groupBy("city")
        .agg(
            F.count(F.lit(1)).alias("total_customers"),
            F.sum("orders").alias("total_orders"),
            F.sum("revenue").alias("total_revenue"),
            F.sum("cost").alias("cost"),
            F.sum("lines").alias("lines"),
        )
    )
    return cities.select(
        "city",
        "total_customers",
        "total_orders",
        "total_revenue",
        (F.col("total_revenue") - F.col("cost")).alias("total_profit"),
        half_up(ratio("total_revenue", "lines"), 2).alias("avg_item_value"),
        half_up(ratio("total_revenue", "total_customers"), 2).alias("revenue_per_customer"),
    )


def clv(
    sales: DataFrame,
    users: DataFrame,
    tiers: tuple[float, float, float] = (50000, 20000, 5000),
    as_of: Column | None = None,
) -> DataFrame:
    """Projected lifetime value and tier per user."""
    bought, today = _ended(sums_by_user(sales), "last_purchase", as_of)
    named = users.select("user_id", F.col("name").alias("user_name"), "city", "member_level", "signup_date")

    months_known = F.greatest(F.col("customer_age_days") / F.lit(30.0), F.lit(1.0))
    order_value = ratio("total_revenue", F.greatest("total_orders", F.lit(1)))
    loyalty = F.least(F.col("active_days") / F.lit(365.0) + F.lit(1.0), F.lit(3.0))
    aged = bought.join(named, "user_id").select(
        "user_id",
        "user_name",
        "city",
        "member_level",
        "signup_date",
        F.col("orders").alias("total_orders"),
        F.col("revenue").alias("total_revenue"),
        (F.col("revenue") - F.col("cost")).alias("total_profit"),
        "first_purchase",
        "last_purchase",
        ratio("revenue", "lines").alias("avg_item_value"),
        F.datediff(today, "signup_date").alias("customer_age_days"),
        F.datediff("last_purchase", "first_purchase").alias("active_days"),
    )
    scored = (
        aged.withColumn("purchase_frequency", half_up(ratio("total_orders", months_known), 2))
        .withColumn("projected_annual_value", half_up(F.col("purchase_frequency") * F.lit(12.0) * order_value, 2))
        .withColumn("clv_score", half_up(F.col("projected_annual_value") * loyalty, 2))
    )
    return scored.withColumn("clv_tier", tier("clv_score", tuple(zip(tiers, CLV_LABELS)), "Bronze"))


def churn_risk(
    sales: DataFrame,
    users: DataFrame,
    threshold: int = 60,
    dormant: int = 30,
    as_of: Column | None = None,
) -> DataFrame:
    """Days since the last purchase and a risk label for every user.

    Users without a purchase are labelled first and then get three thresholds
    as their number of days.
    """
    last, today = _ended(
        sales.groupBy("user_id").agg(F.max("order_date").alias("last_order_date")), "last_order_date", as_of
    )
    days = F.datediff(today, "last_order_date")
    known = users.join(last, "user_id", "left").withColumn("days_since_last", days)
    since = F.col("days_since_last")
    risk = first_match(
        [
            (since.isNull(), NO_PURCHASE),
            (since > 2 * threshold, "Churned"),
            (since > threshold, "At Risk"),
            (since > dormant, "Dormant"),
        ],
        "Active",
    )
    kept = [c for c in ("user_id", "name", "email", "city", "member_level") if c in users.columns]
    return (
        known.withColumn("churn_risk", risk)
        .fillna(3 * threshold, subset=["days_since_last"])
        .select(*kept, "last_order_date", "days_since_last", "churn_risk")
    )


def churn_summary(churn: DataFrame) -> DataFrame:
    """Users and mean days of inactivity per risk label."""
    return churn.groupBy("churn_risk").agg(
        F.count("user_id").alias("user_count"),
        half_up(ratio(F.sum(F.col("days_since_last").cast("bigint")), F.count("days_since_last")), 1).alias(
            "avg_days_inactive"
        ),
    )


def churn_distribution(churn: DataFrame) -> DataFrame:
    """Users per risk label."""
    return churn.groupBy("churn_risk").agg(F.count(F.lit(1)).alias("user_count"))


def price_sensitivity(
    sales: DataFrame,
    low: float = 1000,
    mid: float = 3000,
    high: float = 5000,
    many: int = 5,
    few: int = 3,
    count_orders: bool = False,
) -> DataFrame:
    """Segment per user from the mean line value and the number of lines.

    ``count_orders`` counts distinct orders instead of lines.
    """
    if count_orders:
        spending = sums_by_order(sales).groupBy("user_id").agg(
            F.sum("revenue").alias("revenue"),
            F.sum("lines").alias("lines"),
            F.count(F.lit(1)).alias("total_orders"),
            F.sum("units").alias("total_items"),
        )
    else:
        spending = spend_by_user(sales).select(
            "user_id", "revenue", "lines", F.col("lines").alias("total_orders"), F.col("units").alias("total_items")
        )
    valued = spending.withColumn("avg_order_value", ratio("revenue", "lines"))
    value, orders = F.col("avg_order_value"), F.col("total_orders")
    segment = first_match(
        [
            ((value < low) & (orders > many), "Price Sensitive - Frequent"),
            ((value > mid) & (orders <= few), "Quality Focused - Occasional"),
            ((value > high) & (orders > many), "Premium Loyal"),
        ],
        "Average Shopper",
    )
    return valued.select(
        "user_id", "avg_order_value", "total_orders", "total_items", segment.alias("sensitivity_segment")
    )


def sensitivity_stats(sensitivity: DataFrame) -> DataFrame:
    """Users, mean value and mean number of orders per segment."""
    # six decimals of each user's mean, as in a decimal average; a decimal sum
    # does not depend on the order of addition
    value = F.col("avg_order_value").cast("decimal(20,6)")
    return sensitivity.groupBy("sensitivity_segment").agg(
        F.count("user_id").alias("count"),
        half_up(ratio(F.sum(value), F.count(value)), 2).alias("avg_order_value"),
        half_up(ratio(F.sum("total_orders"), F.count("total_orders")), 2).alias("avg_orders"),
    )


def nps_users(
    sales: DataFrame,
    promoter: tuple[int, float] = (8, 20000),
    passive: tuple[int, float] = (4, 8000),
    count_orders: bool = False,
) -> DataFrame:
    """Promoter class per user from purchase count and spend; counts sales rows by default."""
    if count_orders:
        spent = sums_by_order(sales).groupBy("user_id").agg(
            F.count(F.lit(1)).alias("order_count"), F.sum("revenue").alias("total_spent")
        )
    else:
        spent = spend_by_user(sales).select(
            "user_id", F.col("lines").alias("order_count"), F.col("revenue").alias("total_spent")
        )

    def reaches(level: tuple[int, float]) -> Column:
        return (F.col("order_count") >= level[0]) & (F.col("total_spent") > level[1])

    return spent.withColumn(
        "nps_segment", first_match([(reaches(promoter), PROMOTER), (reaches(passive), PASSIVE)], DETRACTOR)
    )


def nps_segments(users: DataFrame) -> DataFrame:
    """Users, revenue and revenue share per promoter class."""
    classes = users.groupBy("nps_segment").agg(
        F.count("user_id").alias("user_count"), F.sum("total_spent").alias("total_revenue")
    )
    return classes.withColumn(
        "nps_contribution", half_up(share_of_total("total_revenue") * F.lit(100.0), 1)
    )


def nps_score(segments: DataFrame, reference_form: bool = False) -> DataFrame:
    """Net promoter score from the class table.

    The standard form is the share of promoters less the share of detractors.
    ``reference_form`` counts passives as detractors.
    """
    users = F.col("user_count")
    counted = segments.agg(
        F.coalesce(F.sum(F.when(F.col("nps_segment") == PROMOTER, users)), F.lit(0)).alias("promoters"),
        F.coalesce(F.sum(F.when(F.col("nps_segment") == DETRACTOR, users)), F.lit(0)).alias("detractors"),
        F.coalesce(F.sum(users), F.lit(0)).alias("total_users"),
    )
    against = F.col("total_users") - F.col("promoters") if reference_form else F.col("detractors")
    score = F.coalesce(percent(F.col("promoters") - against, "total_users", 1), F.lit(0.0))
    return counted.select(score.alias("nps_score"), "promoters", "detractors", "total_users")


def inactivity_histogram(
    churn: DataFrame,
    bins: int = 10,
    labels: Sequence[str] = ("Active", "Dormant"),
    value: str = "days_since_last",
) -> DataFrame:
    """Users per equal-width bin of days, empty bins included.

    Bins are closed on the right and the minimum belongs to the first; one
    single value widens the range by a thousandth on both sides.
    """
    days = (
        churn.filter(F.col("churn_risk").isin(*labels))
        .groupBy(F.coalesce(F.col(value), F.lit(0)).cast("double").alias("x"))
        .agg(F.count(F.lit(1)).alias("users"))
    )
    # From here on there is one row per distinct number of days, then per bin.
    everything = Window.partitionBy()
    spread = days.select("x", "users", F.min("x").over(everything).alias("min"), F.max("x").over(everything).alias("max"))
    pad = F.when(F.col("min") != F.col("max"), F.lit(0.0)).otherwise(
        F.when(F.col("min") == 0, F.lit(0.001)).otherwise(F.abs("min") * F.lit(0.001))
    )
    edged = spread.select("x", "users", (F.col("min") - pad).alias("low"), (F.col("max") + pad).alias("high"))
    at = F.ceil((F.col("x") - F.col("low")) * F.lit(bins) / (F.col("high") - F.col("low"))).cast("bigint")
    filled = edged.groupBy("low", "high", F.greatest(at, F.lit(1)).alias("bin")).agg(F.sum("users").alias("users"))
    counts = filled.groupBy("low", "high").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "users"))).alias("users")
    )
    numbers = F.sequence(F.lit(1).cast("bigint"), F.lit(bins).cast("bigint"))
    step = (F.col("high") - F.col("low")) / F.lit(float(bins))
    return counts.select("*", F.explode(numbers).alias("bin")).select(
        "bin",
        (F.col("low") + (F.col("bin") - 1) * step).alias("over"),
        (F.col("low") + F.col("bin") * step).alias("up_to"),
        F.coalesce(F.try_element_at("users", "bin"), F.lit(0)).alias("user_count"),
    )


def at_risk_top(churn: DataFrame, n: int = 15, labels: Sequence[str] = ("At Risk", "Churned")) -> DataFrame:
    """The n users longest without a purchase among the given labels; ties by user_id."""
    kept = [c for c in ("user_id", "name", "email", "city", "member_level") if c in churn.columns]
    return (
        churn.filter(F.col("churn_risk").isin(*labels))
        .orderBy(F.desc("days_since_last"), "user_id")
        .limit(n)
        .select(*kept, "days_since_last", "churn_risk")
    )
