"""Order items per order, orders per user, and user activity per month."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from merchlens.functions.scalar import (
    day_diff,
    month_offset,
    month_start,
    safe_divide,
    scaled,
    sum_exact,
    unscaled,
)

# Profit assumed for orders whose items are unknown.
DEFAULT_MARGIN = "0.40"
PROFIT_SCALE = 4  # places of money times that margin
COMPLETED = "completed"


def assumed_profit(total="total_amount"):
    """Profit of an order without items."""
    return F.col(total) * F.lit(DEFAULT_MARGIN).cast("decimal(3,2)")


def completed(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("status") == COMPLETED)


def order_items_agg(items: DataFrame, products: DataFrame) -> DataFrame:
    """Units, revenue, cost, profit and main category per order."""
    # The catalog first: if it is too large to broadcast, the rows lie by product from then on, and one row per order
    # and product, which lets products be counted plainly, needs no shuffle of its own. The category is a key there,
    # so the (sort-based) maximum over text only sees the smaller set.
    known = products.select("product_id", "category")
    lines = items.join(known, "product_id", "left").groupBy("order_id", "product_id", "category").agg(
        F.sum("quantity").alias("units"),
        F.sum(unscaled("line_total")).alias("revenue"),
        F.sum(F.col("quantity") * unscaled("unit_cost")).alias("cost"),
        F.sum(unscaled("line_profit")).alias("profit"),
    )
    totals = lines.groupBy("order_id").agg(
        F.sum("units").alias("total_items_count"),
        F.count("product_id").alias("distinct_products_count"),
        scaled(F.sum("revenue")).alias("gross_items_revenue"),
        scaled(F.sum("cost")).alias("total_cogs"),
        scaled(F.sum("profit")).alias("gross_profit"),
        F.max("category").alias("primary_product_category"),
    )
    return totals.select(
        "order_id",
        "total_items_count",
        F.col("total_items_count").alias("item_count"),
        "distinct_products_count",
        "gross_items_revenue",
        F.col("gross_items_revenue").alias("subtotal_sum"),
        "total_cogs",
        F.col("total_cogs").alias("total_cost"),
        "gross_profit",
        F.col("gross_profit").alias("gross_margin_amount"),
        safe_divide("gross_profit", "gross_items_revenue").alias("margin_rate"),
        "primary_product_category",
    )


def completed_with_profit(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """Completed orders with the profit of their items, else the assumed one."""
    profit = order_items.select("order_id", F.col("gross_profit").alias("__profit"))
    return (
        completed(orders)
        .select("order_id", "user_id", "order_timestamp", "order_date", "total_amount")
        .join(profit, "order_id", "left")
        .withColumn("gross_profit", F.coalesce("__profit", assumed_profit()))
        .drop("__profit")
    )


def user_order_summary(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """Lifetime figures per user over completed orders.

    The gaps between consecutive orders add up to last day minus first day, so the mean
    gap needs no window: one combining aggregate does, whatever one user's share of rows.
    """
    totals = completed_with_profit(orders, order_items).groupBy("user_id").agg(
        F.count("order_id").alias("orders"),
        F.count("order_timestamp").alias("timed"),
        F.min("order_timestamp").alias("first_at"),
        F.min("order_date").alias("first_date"),
        F.max("order_timestamp").alias("last_at"),
        F.max("order_date").alias("last_date"),
        sum_exact("total_amount").alias("revenue"),
        sum_exact("gross_profit", PROFIT_SCALE).alias("profit"),
    )
    value = safe_divide("revenue", "orders")
    return totals.select(
        "user_id",
        F.col("orders").alias("lifetime_orders"),
        F.col("orders").alias("lifetime_completed_orders"),
        F.col("first_at").alias("first_order_timestamp"),
        F.col("first_at").alias("first_order_at"),
        F.col("first_date").alias("first_order_date"),
        month_start("first_date").alias("first_order_cohort_month"),
        month_start("first_date").alias("cohort_month"),
        F.col("last_at").alias("most_recent_order_timestamp"),
        F.col("last_at").alias("last_order_at"),
        F.col("last_date").alias("most_recent_order_date"),
        F.col("last_date").alias("last_order_date"),
        F.col("revenue").alias("lifetime_revenue"),
        F.col("profit").alias("lifetime_gross_profit"),
        value.alias("lifetime_aov"),
        value.alias("avg_order_value"),
        safe_divide(day_diff("first_at", "last_at"), F.col("timed") - 1).alias("avg_days_between_orders"),
    )


def user_cohort_monthly(users: DataFrame, orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """Orders, revenue and profit per user and month, with months since the first order.

    Orders shrink to one row per user and month before they meet the users. The cohort is
    the user's first such month, so the same rows give it and no second pass is needed.
    """
    monthly = (
        completed_with_profit(orders, order_items)
        .withColumn("activity_month", month_start("order_date"))
        # The join above already placed rows by order id: this step moves nothing.
        .groupBy("order_id", "user_id", "activity_month")
        .agg(
            F.sum(unscaled("total_amount")).alias("revenue"),
            F.sum(unscaled("gross_profit", PROFIT_SCALE)).alias("profit"),
        )
        .groupBy("user_id", "activity_month")
        .agg(
            F.count("order_id").alias("orders"),
            scaled(F.sum("revenue")).alias("revenue"),
            scaled(F.sum("profit"), PROFIT_SCALE).alias("profit"),
        )
    )
    first = F.min("activity_month").over(Window.partitionBy("user_id"))
    cohorts = monthly.withColumn("cohort_month", first).where(F.col("user_id").isNotNull())
    people = users.select("user_id", "customer_segment", "country", "acquisition_channel", "signup_cohort_month")
    offset = month_offset("cohort_month", "activity_month").cast("int")
    return cohorts.join(people, "user_id").select(
        "user_id",
        "customer_segment",
        "country",
        "acquisition_channel",
        "signup_cohort_month",
        "cohort_month",
        "activity_month",
        offset.alias("month_number"),
        offset.alias("month_offset"),
        F.col("orders").alias("monthly_orders"),
        F.col("orders").alias("orders_in_month"),
        F.col("revenue").alias("monthly_revenue"),
        F.col("revenue").alias("revenue_in_month"),
        F.col("profit").alias("monthly_gross_profit"),
        F.lit(1).alias("is_retained"),
        F.lit(1).alias("is_active"),
    )
