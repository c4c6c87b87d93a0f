from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from merchlens.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("4", shuffle_partitions=4, memory="4g")


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def shop_tables(spark):
    """A literal shop: five users, a few sessions, every staging edge case."""
    from merchlens.sources.bindings import RawTables
    from merchlens.sources.datasets import RAW_SCHEMAS

    def frame(name, data):
        kinds = RAW_SCHEMAS[name].replace("timestamp_ntz", "string")
        df = spark.createDataFrame(data, kinds)
        for part in RAW_SCHEMAS[name].split(", "):
            column, kind = part.split(" ")
            if kind == "timestamp_ntz":
                df = df.withColumn(column, df[column].cast("timestamp_ntz"))
        return df

    users = [
        (" USR-1 ", "2024-01-01 10:00:00", " us ", "Organic", " VIP", "Mobile"),
        ("USR-2", "2024-01-02 00:00:00", "uk", "Paid", "Regular", "Desktop"),
        ("USR-3", "2024-01-03 00:00:00", "de", "Paid", "Bargain", "Tablet"),
        ("USR-4", "2024-01-04 00:00:00", "fr", "Direct", "Regular", "Mobile"),
        (None, "2024-01-05 00:00:00", "fr", "Direct", "Regular", "Mobile"),
    ]
    products = [
        ("PRD-1", "Lamp ", "Home", 4.0, 10.0, 6.0, 5, "2023-01-01 00:00:00"),
        ("PRD-2", "Shoe", "Apparel", 20.0, 50.0, 30.0, 5, "2023-01-01 00:00:00"),
        ("PRD-0", "Gift", "Home", 0.0, 0.0, 0.0, 5, "2023-01-01 00:00:00"),
    ]

    def session(i, user, start, end, variant, returning=False):
        return (f"SES-{i}", user, start, end, "Mobile", "us", "Organic", "web", False, returning, not returning, variant, "x")

    sessions = [
        session(1, "USR-1", "2024-02-01 23:59:50", "2024-02-02 00:01:00", " Control "),
        session(2, "USR-1", "2024-02-20 09:00:00", "2024-02-20 08:00:00", "TREATMENT", True),
        session(3, "USR-2", "2024-03-01 09:00:00", "2024-03-01 09:30:00", "control"),
        session(4, "USR-9", "2024-03-02 09:00:00", "2024-03-02 09:10:00", "treatment"),
    ]

    def event(i, sid, user, at, kind, step, product="PRD-1", cart=None):
        return (f"EVT-{i}", sid, user, at, kind.upper(), f" {kind} ", step, "/p", product, cart)

    events = [
        event(1, "SES-1", "USR-1", "2024-02-01 23:59:50", "landing_page", 1, " "),
        event(2, "SES-1", "USR-1", "2024-02-01 23:59:55", "product_view", 2),
        event(3, "SES-1", "USR-1", "2024-02-02 00:00:00", "add_to_cart", 3, cart=10.0),
        event(4, "SES-1", "USR-1", "2024-02-02 00:00:20", "checkout_started", 4, cart=10.0),
        event(5, "SES-1", "USR-1", "2024-02-02 00:00:40", "payment_started", 5, cart=10.0),
        event(6, "SES-1", "USR-1", "2024-02-02 00:01:00", "purchase", 6, cart=10.0),
        event(7, "SES-2", "USR-1", "2024-02-20 09:00:00", "landing_page", 1),
        event(8, "SES-3", "USR-2", "2024-03-01 09:00:00", "landing_page", 1),
        event(9, "SES-3", "USR-2", "2024-03-01 09:10:00", "checkout_started", 4),
    ]

    def order(i, sid, user, at, subtotal, tax, ship, off, total, status="Completed "):
        return (f"ORD-{i}", sid, user, at[:10], at, subtotal, tax, ship, off, total, "card", status, "control")

    orders = [
        order(1, "SES-1", "USR-1", "2024-02-02 00:01:00", 10.0, 0.74, 5.99, 1.0, 15.73),
        order(2, "SES-2", "USR-1", "2024-02-20 09:00:00", 50.0, None, None, None, 50.0),
        order(3, None, "USR-1", "2024-04-01 12:00:00", 100.0, 0.0, 0.0, 0.0, 100.0),
        order(4, "SES-3", "USR-2", "2024-03-01 09:20:00", 20.0, 0.0, 0.0, 0.0, 20.0, "CANCELLED"),
        order(5, "SES-3", "USR-2", "2024-03-01 09:30:00", 200.0, 0.0, 0.0, 0.0, 200.0),
    ]
    items = [
        ("ITM-1", "ORD-1", "PRD-1", 1, 10.0, 4.0, 10.0, None, 6.0),
        ("ITM-2", "ORD-2", "PRD-1", 1, 10.0, 4.0, 10.0, 10.0, 6.0),
        ("ITM-3", "ORD-2", "PRD-2", 1, 40.0, 20.0, 40.0, 40.0, 20.0),
    ]
    data = dict(users=users, products=products, sessions=sessions, events=events, orders=orders, order_items=items)
    return RawTables.of(**{name: frame(name, rows) for name, rows in data.items()})
