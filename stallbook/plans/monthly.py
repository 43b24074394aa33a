"""Gold tables from monthly parts: a changed month rewrites its own folders and nothing else.

The fact and every part are written by order month. A part has what a month adds to a table: sums, counts of orders (an
order belongs to one month) and bitmaps of users. The tables are put together from the parts and read no line. A
refresh reads the lines of the months it is given, replaces their folders and removes those of months that have
become empty.
"""

from __future__ import annotations

from collections.abc import Callable, Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import month_key, week_start
from ..operators import finance, products
from ..operators.distinct import BITS, BUCKET, distinct_bitmaps, distinct_counts
from ..operators.sales import build_sales, order_facts, order_rollup
from .gold import Bronze, Rules

MONTH = "order_month"

_MONEY, _SUM = "decimal(18,2)", "decimal(31,2)"
# Columns of the stored parts; the month is a folder.
PARTS = {
    "fact": (
        f"order_id bigint, product_id bigint, user_id bigint, order_date timestamp_ntz, payment_method string, "
        f"shipping_fee {_MONEY}, discount_amount {_MONEY}, quantity bigint, line_revenue {_MONEY}, brand string, "
        f"name string, category string, line_cost {_MONEY}"
    ),
    "orders": (
        f"order_id bigint, user_id bigint, revenue {_SUM}, cost {_SUM}, units bigint, lines bigint, "
        f"order_date timestamp_ntz, payment_method string, shipping_fee {_MONEY}, discount_amount {_MONEY}"
    ),
    "refunds": f"total_refunds {_SUM}",
    "pl": (
        f"gross_revenue {_SUM}, total_cogs {_SUM}, total_discounts {_SUM}, total_refunds {_SUM}, total_shipping {_SUM}, "
        f"net_revenue {_SUM}, gross_profit {_SUM}, gross_margin_pct double, total_orders bigint"
    ),
    "days": f"order_date_only date, daily_revenue {_SUM}, daily_cost {_SUM}, daily_gross_profit {_SUM}, daily_orders bigint",
    "products": f"category string, product_id bigint, revenue {_SUM}, cost {_SUM}, units bigint",
    "categories": "category string, orders bigint",
    "payments": f"payment_method string, orders bigint, revenue {_SUM}, lines bigint",
    "payment_users": f"payment_method string, {BUCKET} bigint, {BITS} binary",
    "weeks": f"week_start date, revenue {_SUM}, cost {_SUM}, units bigint, orders bigint",
    "week_users": f"week_start date, {BUCKET} bigint, {BITS} binary",
    "buyers": "user_id bigint",
}


# The parts each table is put together from, besides the fact.
TABLES = {
    "gold_finance": ("days",),
    "gold_finance_pl": ("orders", "refunds", "pl"),
    "gold_category": ("products", "categories"),
    "gold_payment": ("orders", "payments", "payment_users"),
    "gold_weekly_sales": ("orders", "weeks", "week_users"),
    "gold_inventory": ("products",),
    "gold_cohort": ("orders", "buyers"),
}


class MonthlyGold:
    """A folder of monthly parts, for all tables or some. Users' ids must suit bitmaps (see ``operators.distinct``)."""

    def __init__(self, spark: SparkSession, folder: str, rules: Rules = Rules(), tables: Collection[str] = tuple(TABLES)):
        self.spark, self.folder, self.rules = spark, folder.rstrip("/"), rules
        self.parts = {part for table in tables for part in TABLES[table]}

    # --- writing

    def refresh(self, bronze: Bronze, months: Collection[str] | None = None) -> None:
        """Bring these months (yyyy-MM), or all of them, up to date.

        A month's refunds count as a change of that month. Months that are not named keep their files. The parts of a
        month are replaced one after the other, so a refresh that fails is to be run again.
        """
        orders = bronze.orders.where(self._of(F.col("order_date"), months))
        sales = build_sales(bronze.items, orders, bronze.products, completed=self.rules.completed, amount=self.rules.amount)
        self._replace("fact", sales, months)
        made = self._made(bronze.returns.where(self._of(F.col("return_date"), months)), months)
        for part in PARTS:
            if part in self.parts:
                self._replace(part, made[part](), months)

    def _made(self, returns: DataFrame, months: Collection[str] | None) -> dict[str, Callable[[], DataFrame]]:
        """The parts of the months, from the stored fact and the stored orders."""
        fact, orders = lambda: self._stored("fact", months), lambda: self._stored("orders", months)

        def refunds() -> DataFrame:
            return finance.monthly_refunds(returns).withColumnRenamed("return_month", MONTH)

        def pl() -> DataFrame:
            given_back = self._stored("refunds", months).withColumnRenamed(MONTH, "return_month")
            return finance.monthly_pl(order_rollup(orders()), given_back)

        def per_product() -> DataFrame:
            return fact().groupBy(MONTH, "category", "product_id").agg(
                F.sum("line_revenue").alias("revenue"), F.sum("line_cost").alias("cost"), F.sum("quantity").alias("units")
            )

        def per_category() -> DataFrame:
            once = fact().select(MONTH, "category", "order_id").distinct()
            return once.groupBy(MONTH, "category").agg(F.count("order_id").alias("orders"))

        def per_method() -> DataFrame:
            return orders().groupBy(MONTH, "payment_method").agg(
                F.count(F.lit(1)).alias("orders"), F.sum("revenue").alias("revenue"), F.sum("lines").alias("lines")
            )

        def dated() -> DataFrame:
            return orders().withColumn("week_start", week_start("order_date"))

        def per_week() -> DataFrame:
            return dated().groupBy(MONTH, "week_start").agg(
                F.sum("revenue").alias("revenue"), F.sum("cost").alias("cost"), F.sum("units").alias("units"),
                F.count(F.lit(1)).alias("orders"),
            )

        return {
            "orders": lambda: order_facts(fact()).withColumn(MONTH, month_key("order_date")),
            "refunds": refunds,
            "pl": pl,
            "days": lambda: finance.daily_finance(fact()).withColumn(MONTH, month_key("order_date_only")),
            "products": per_product,
            "categories": per_category,
            "payments": per_method,
            "payment_users": lambda: distinct_bitmaps(orders(), [MONTH, "payment_method"], "user_id"),
            "weeks": per_week,
            "week_users": lambda: distinct_bitmaps(dated(), [MONTH, "week_start"], "user_id"),
            "buyers": lambda: orders().select(MONTH, "user_id").distinct(),
        }

    @staticmethod
    def _of(when: Column, months: Collection[str] | None) -> Column:
        """Whether a time lies in the months, as ranges that reach a scan."""
        if months is None:
            return F.lit(True)
        found = F.lit(False)
        for month in sorted(set(months)):
            first = F.to_date(F.lit(f"{month}-01"))
            kind = when.cast("timestamp_ntz")
            found = found | ((kind >= first.cast("timestamp_ntz")) & (kind < F.add_months(first, 1).cast("timestamp_ntz")))
        return found

    def _replace(self, part: str, frame: DataFrame, months: Collection[str] | None) -> None:
        columns = [F.col(f.split()[0]).cast(f.split(" ", 1)[1]) for f in self._fields(part)]
        # rows of a month go together, and a large month to several tasks
        writer = frame.select(*columns, MONTH).hint("rebalance", MONTH).write.mode("overwrite").partitionBy(MONTH)
        if months is None:
            writer.parquet(f"{self.folder}/{part}")
            return
        before = {month: self._files(part, month) for month in months}
        writer.option("partitionOverwriteMode", "dynamic").parquet(f"{self.folder}/{part}")
        for month, files in before.items():
            if files and files == self._files(part, month):  # nothing was written: the month is empty now
                place, store = self._place(part, month)
                store.delete(place, True)

    def _place(self, part: str, month: str) -> tuple:
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{part}/{MONTH}={month}")
        return place, place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _files(self, part: str, month: str) -> set[str]:
        """Names of a month's files; every write gives new names."""
        place, store = self._place(part, month)
        return {f.getPath().getName() for f in store.listStatus(place)} if store.exists(place) else set()

    # --- reading

    @staticmethod
    def _fields(part: str) -> list[str]:
        fields, depth, word = [], 0, ""
        for letter in PARTS[part] + ",":
            depth += (letter == "(") - (letter == ")")
            if letter == "," and not depth:
                fields.append(word.strip())
                word = ""
            else:
                word += letter
        return fields

    def _stored(self, part: str, months: Collection[str] | None = None) -> DataFrame:
        found = self.spark.read.schema(f"{PARTS[part]}, {MONTH} string").parquet(f"{self.folder}/{part}")
        return found if months is None else found.where(F.col(MONTH).isin(*months))

    def table(self, name: str, bronze: Bronze) -> DataFrame:
        """A gold table from the parts; `bronze` gives the products' attributes."""
        return self._tables(bronze)[name]()

    def _tables(self, bronze: Bronze) -> dict[str, Callable[[], DataFrame]]:
        return {
            "gold_finance": lambda: self._stored("days").drop(MONTH),
            "gold_finance_pl": lambda: self._stored("pl").select(MONTH, *(f.split()[0] for f in self._fields("pl"))),
            "gold_category": self._category,
            "gold_payment": self._payment,
            "gold_weekly_sales": self._weekly,
            "gold_inventory": lambda: self._inventory(bronze.products),
            "gold_cohort": self._cohort,
        }

    def _category(self) -> DataFrame:
        per_product = self._stored("products").groupBy("category", "product_id").agg(
            F.sum("revenue").alias("revenue"), F.sum("cost").alias("cost"), F.sum("units").alias("units")
        )
        totals = per_product.groupBy("category").agg(
            F.sum("revenue").alias("total_revenue"), F.sum("cost").alias("total_cost"),
            F.sum("units").alias("total_units_sold"), F.count("product_id").alias("product_count"),
        )
        orders = self._stored("categories").groupBy(F.col("category").alias("of_category")).agg(F.sum("orders").alias("total_orders"))
        return finance.category_figures(totals.join(orders, F.col("category").eqNullSafe(F.col("of_category"))))

    def _payment(self) -> DataFrame:
        methods = self._stored("payments").groupBy("payment_method").agg(
            F.sum("orders").alias("total_orders"), F.sum("revenue").alias("total_revenue"), F.sum("lines").alias("lines")
        )
        users = distinct_counts(self._stored("payment_users"), ["payment_method"], "unique_users")
        users = users.withColumnRenamed("payment_method", "of_method")
        return finance.payment_figures(methods.join(users, F.col("payment_method").eqNullSafe(F.col("of_method"))))

    def _weekly(self) -> DataFrame:
        weeks = self._stored("weeks").groupBy("week_start").agg(
            F.sum("revenue").alias("weekly_revenue"), (F.sum("revenue") - F.sum("cost")).alias("weekly_profit"),
            F.sum("units").alias("weekly_units"), F.sum("orders").alias("weekly_orders"),
        )
        return weeks.join(distinct_counts(self._stored("week_users"), ["week_start"], "weekly_active_users"), "week_start")

    def _inventory(self, catalogue: DataFrame) -> DataFrame:
        sold = self._stored("products").select(
            "product_id", F.col("units").alias("quantity"), F.col("revenue").alias("line_revenue")
        )
        return products.product_performance(sold, catalogue)

    def _cohort(self) -> DataFrame:
        bought = self._stored("buyers").select("user_id", F.to_date(MONTH, "yyyy-MM").alias("month"))
        first = bought.groupBy("user_id").agg(F.min("month").alias("first"))
        return (
            bought.join(first, bought["user_id"].eqNullSafe(first["user_id"]))
            .groupBy("first", "month")
            .agg(F.count(F.lit(1)).alias("active_users"))
            .select(
                month_key("first").alias("cohort_month"),
                F.months_between("month", "first").cast("int").alias("months_since_first"),
                "active_users",
            )
        )
