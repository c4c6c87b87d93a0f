"""Star joins over the facts and conformed dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlens.functions.scalar import pct, sum_exact
from merchlens.operators.dimensions import calendar_columns


def star_revenue(
    orders: DataFrame, users: DataFrame, items: DataFrame, products: DataFrame, calendar: DataFrame
) -> DataFrame:
    """Orders, revenue, profit and margin by segment, category and year.

    Items shrink to one row per order and product before they meet the dimensions; orders of
    a slice are counted by collapsing the order first. Only the calendar is broadcast, whose
    rows are days; for the other joins Catalyst goes by the sizes it measures.
    """
    lines = items.groupBy("order_id", "product_id").agg(
        sum_exact("total_item_price").alias("revenue"), sum_exact("line_profit").alias("profit")
    )
    joined = (
        lines.join(products.select("product_id", "category"), "product_id")
        .join(orders.select("order_id", "user_id", "order_date"), "order_id")
        .join(users.select("user_id", "customer_segment"), "user_id")
        .join(F.broadcast(calendar.select(F.col("date_day").alias("order_date"), "year")), "order_date")
    )
    slices = ["customer_segment", "category", "year"]
    per_order = joined.groupBy(*slices, "order_id").agg(F.sum("revenue").alias("revenue"), F.sum("profit").alias("profit"))
    totals = per_order.groupBy(*slices).agg(
        F.count("order_id").alias("total_orders"),
        F.round(F.sum("revenue"), 2).alias("gross_revenue"),
        F.round(F.sum("profit"), 2).alias("gross_profit"),
    )
    return totals.withColumn("gross_margin_pct", pct("gross_profit", "gross_revenue"))


def by_date_role(fact: DataFrame, role: Column, measures: Sequence[Column], by: Sequence[str]) -> DataFrame:
    """Aggregate a fact along the calendar by any of its dates: order date, ship date, ...

    The fact shrinks to one row per day first; the calendar is that of the role's own days, so none is lost. Rows
    without the date form one group of nulls.
    """
    daily = fact.groupBy(role.cast("date").alias("__day")).agg(*measures)
    names = [c for c in daily.columns if c != "__day"]
    calendar = calendar_columns(daily.select(F.col("__day").alias("date_day"))).select("date_day", *by)
    joined = daily.join(calendar, F.col("__day").eqNullSafe(F.col("date_day")))
    return joined.groupBy(*by).agg(*[F.sum(c).alias(c) for c in names])


def shipping_pairs(orders: DataFrame, days: int = 2) -> DataFrame:
    """Orders per order date and the shipping date ``days`` later."""
    ordered = F.col("order_timestamp").cast("date")
    return orders.groupBy(ordered.alias("order_date"), F.date_add(ordered, days).alias("shipping_date")).agg(
        F.count(F.lit(1)).alias("order_count")
    )


def lineage(users: DataFrame, sessions: DataFrame, events: DataFrame, orders: DataFrame, items: DataFrame) -> DataFrame:
    """Rows of each table that still have a full chain of parents."""
    known_sessions = sessions.join(users.select("user_id"), "user_id", "left_semi")
    known_events = events.join(known_sessions.select("session_id"), "session_id", "left_semi")
    known_orders = orders.join(known_sessions.select("session_id"), "session_id", "left_semi")
    known_items = items.join(known_orders.select("order_id"), "order_id", "left_semi")
    chain = {"users": users, "sessions": known_sessions, "events": known_events, "orders": known_orders, "order_items": known_items}
    result = None
    for name, df in chain.items():
        row = df.agg(F.count(F.lit(1)).alias("linked_rows")).select(F.lit(name).alias("table"), "linked_rows")
        result = row if result is None else result.unionByName(row)
    return result
