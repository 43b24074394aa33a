import datetime as dt
import sys
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from stallbook.operators.sales import build_sales  # noqa: E402
from stallbook.session import local_session  # noqa: E402
from stallbook.sources import schemas  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folders = {
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("work")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    }
    session = local_session(8, shuffle_partitions=4, app="stallbook-tests", settings=folders)
    yield session
    session.stop()


def at(text):
    return dt.datetime.fromisoformat(text)


def money(text):
    return Decimal(text)


def rows(frame, *keys):
    """Rows as dicts, in the order of the given keys."""
    found = [r.asDict(recursive=True) for r in frame.collect()]
    return sorted(found, key=lambda r: tuple(str(r[k]) for k in keys)) if keys else found


class Shop:
    """A shop small enough to check by hand.

    Orders: 1 and 2 hold two categories, 3 holds one, 4 is cancelled, 5 has a
    line of zero revenue, 6 has no lines.
    """

    def __init__(self, spark):
        self.products = spark.createDataFrame(
            [
                (1, "S1", "Acme", "pen", "Office", money("2.00"), money("5.00"), 10, 10, 1),
                (2, "S2", "Acme", "desk", "Home", money("50.00"), money("80.00"), 20, 10, 1),
                (3, "S3", "Bolt", "lamp", "Home", money("10.00"), money("25.00"), 365, 10, 2),
                (4, "S4", "Bolt", "cable", "Tech", money("1.00"), money("25.00"), 400, 10, None),
                (5, "S5", "Cove", "never", "Tech", money("3.00"), money("4.00"), 160, 10, 2),
            ],
            schemas.PRODUCTS,
        )
        self.users = spark.createDataFrame(
            [
                (1, "Ann", "a@x", "1", "Oslo", at("2024-01-01"), "Gold", 1),
                (2, "Bob", "b@x", "2", "Rome", at("2024-01-01"), "Silver", 1),
                (3, "Cyd", "c@x", "3", "Oslo", at("2024-01-01"), "Gold", 1),
            ],
            schemas.USERS,
        )
        self.orders = spark.createDataFrame(
            [
                (1, 1, at("2024-01-10 10:00:00"), "Completed", "card", money("60.00"), money("0.00")),
                (2, 1, at("2024-02-12 11:00:00"), "Completed", "card", money("0.00"), money("50.00")),
                (3, 2, at("2024-02-13 11:30:00"), "Completed", "cash", money("0.00"), money("100.01")),
                (4, 2, at("2024-03-01 00:00:00"), "Cancelled", "cash", money("0.00"), money("10.00")),
                (5, 2, at("2024-03-09 23:59:59"), "Completed", "cash", money("0.00"), money("150.01")),
                (6, 3, at("2024-03-10 00:00:00"), "Completed", "card", money("0.00"), money("0.00")),
            ],
            schemas.ORDERS,
        )
        self.items = spark.createDataFrame(
            [
                (1, 1, 1, 2, money("5.00")),  # 10.00
                (2, 1, 2, 1, money("80.00")),  # 80.00
                (3, 2, 2, 1, money("80.00")),  # 80.00
                (4, 2, 4, 2, money("25.00")),  # 50.00
                (5, 3, 3, 2, money("25.00")),  # 50.00
                (6, 4, 3, 9, money("25.00")),  # cancelled
                (7, 5, 1, 1, money("0.00")),  # 0.00
            ],
            schemas.ORDER_ITEMS,
        )
        self.returns = spark.createDataFrame(
            [
                (1, 1, 1, at("2024-01-20"), "broken", money("5.00"), "Approved"),
                (2, 1, 2, at("2024-02-20"), "late", money("80.00"), "Pending"),
                (3, 2, 2, at("2024-02-21"), "late", money("40.00"), "Approved"),
                (4, 3, 3, at("2025-07-01"), "late", money("25.00"), "Approved"),  # month without sales
            ],
            schemas.RETURNS,
        )
        self.suppliers = spark.createDataFrame(
            [(1, "North", "Oslo", "A", 5, money("0.90")), (2, "South", "Rome", "B", 9, money("0.80"))],
            schemas.SUPPLIERS,
        )
        due = at("2024-01-10")
        self.purchase_orders = spark.createDataFrame(
            [
                (1, 1, 1, 10, money("2.00"), at("2024-01-01"), due, at("2024-01-08"), "Received"),  # early
                (2, 1, 1, 10, money("2.00"), at("2024-01-01"), due, due, "Received"),  # on the day
                (3, 1, 2, 1, money("50.00"), at("2024-01-01"), due, at("2024-01-15"), "Received"),  # late
                (4, 2, 3, 5, money("9.00"), at("2024-01-01"), due, None, "In Transit"),
            ],
            schemas.PURCHASE_ORDERS,
        )
        self.clicks = spark.createDataFrame(
            [
                ("e1", 1, "view", "2024-01-01T10:00:00", "mobile", "ios", "ads", (1, None, 30, 2)),
                ("e2", 1, "view", "2024-01-01T11:00:00", "mobile", "ios", "ads", (1, "pen", 50, 2)),
                ("e3", 2, "click", "2024-01-02T10:00:00", "tablet", "ios", "mail", (2, None, None, 1)),
                ("e4", 9, "buy", "not a time", "tablet", "ios", "mail", None),
            ],
            schemas.CLICKS,
        )
        self.tickets = spark.createDataFrame(
            [
                ("t1", 1, "refund", "High", "open", "2024-01-01T00:00:00", None, 4),
                ("t2", 1, "refund", "High", "open", "2024-01-01T00:00:00", None, None),
                ("t3", 2, "refund", "Low", "open", "2024-01-01T00:00:00", None, None),
            ],
            schemas.TICKETS,
        )

    @property
    def sales(self):
        return build_sales(self.items, self.orders, self.products)


@pytest.fixture(scope="session")
def shop(spark):
    return Shop(spark)
