"""Catalog search and paged lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlens.functions.scalar import all_of

ACTIVE = "ACTIVE"  # fixed value


def page(df: DataFrame, order: Sequence[Column | str], number: int, size: int) -> DataFrame:
    """One page of a total order. A report feature: ``size`` rows leave the sort."""
    return df.orderBy(*order).offset(number * size).limit(size)


def search_products(
    products: DataFrame,
    category: str | None = None,
    min_price=None,
    max_price=None,
    text: str | None = None,
    status: str | None = ACTIVE,
) -> DataFrame:
    """Products that meet every condition given; blank texts count as not given."""
    tests = []
    if status is not None and "status" in products.columns:
        tests.append(F.col("status") == status)
    if category and category.strip():
        tests.append(F.lower("category") == category.strip().lower())
    if min_price is not None:
        tests.append(F.col("price") >= min_price)
    if max_price is not None:
        tests.append(F.col("price") <= max_price)
    if text and text.strip():
        tests.append(F.lower("product_name").contains(text.strip().lower()))
    return products.where(all_of(tests)) if tests else products


def orders_of_user(orders: DataFrame, user_id, number: int = 0, size: int = 20) -> DataFrame:
    """A page of one user's orders, newest first."""
    mine = orders.where(F.col("user_id") == user_id)
    return page(mine, [F.desc("order_timestamp"), "order_id"], number, size)
