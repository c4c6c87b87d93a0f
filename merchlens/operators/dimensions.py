"""Dates, products and users."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlens.functions.scalar import MONEY, day_diff, safe_divide, sum_exact

# Default calendar, frequency bands, monetary tiers, lifecycle states.
CALENDAR = (date(2024, 1, 1), date(2026, 12, 31))
FREQUENCY_BANDS = ("0 Orders", "1 Order", "2-3 Orders", "4+ Orders")
MONETARY_TIERS = (
    "Tier 0: Non-Buyer",
    "Tier 1: Low Value",
    "Tier 2: Mid Value",
    "Tier 3: High Value",
    "Tier 4: VIP",
)
MONETARY_CUTS = (100, 300, 750)
LIFECYCLE = ("Registered Non-Purchaser", "Single Purchaser", "Active Repeat", "Dormant Repeat", "Churned Repeat")
ACTIVE_DAYS = 60
DORMANT_DAYS = 120


def days_between(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """One row per day from ``first`` to ``last`` of a one-row frame."""
    return bounds.select(F.explode(F.sequence(F.col(first), F.col(last))).alias("date_day"))


def calendar_columns(days: DataFrame) -> DataFrame:
    day = F.col("date_day")
    return days.select(
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.concat(F.lit("Q"), F.quarter(day), F.lit(" "), F.year(day)).alias("quarter_name"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "MMM").alias("month_short"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        F.weekofyear(day).alias("week_of_year"),
        F.dayofmonth(day).alias("day_of_month"),
        (F.dayofweek(day) - 1).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "EEE").alias("day_short"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_key"),
    )


def dim_date(spark: SparkSession, start: date = CALENDAR[0], end: date = CALENDAR[1]) -> DataFrame:
    bounds = spark.range(1).select(F.lit(start).alias("first"), F.lit(end).alias("last"))
    return calendar_columns(days_between(bounds, "first", "last"))


def calendar_of(df: DataFrame, column: str) -> DataFrame:
    """The calendar that spans a table's dates."""
    day = F.col(column).cast("date")
    return calendar_columns(days_between(df.agg(F.min(day).alias("first"), F.max(day).alias("last")), "first", "last"))


def product_sales(items: DataFrame) -> DataFrame:
    """Orders, units, revenue and profit per product."""
    return items.groupBy("product_id").agg(
        F.count_distinct("order_id").alias("total_orders_count"),
        F.sum("quantity").alias("total_units_sold"),
        sum_exact("line_total").alias("total_revenue_generated"),
        sum_exact("line_profit").alias("total_profit_generated"),
    )


def dim_products(products: DataFrame, items: DataFrame) -> DataFrame:
    sold = products.join(product_sales(items), "product_id", "left")
    return sold.select(
        "product_id",
        "product_name",
        "category",
        "cost",
        "price",
        F.round(F.col("price") - F.col("cost"), 2).alias("margin_amount"),
        F.round(safe_divide(F.col("price") - F.col("cost"), "price") * 100.0, 2).alias("margin_percentage"),
        "margin",
        "unit_margin",
        "margin_rate",
        "inventory_count",
        "created_at",
        F.coalesce("total_orders_count", F.lit(0)).alias("total_orders_count"),
        F.coalesce("total_units_sold", F.lit(0)).alias("total_units_sold"),
        F.coalesce("total_revenue_generated", F.lit(0).cast(MONEY)).alias("total_revenue_generated"),
        F.coalesce("total_profit_generated", F.lit(0).cast(MONEY)).alias("total_profit_generated"),
        safe_divide("total_revenue_generated", "total_units_sold").alias("realized_avg_selling_price"),
    )


def sessions_per_user(sessions: DataFrame) -> DataFrame:
    return (
        sessions.where(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(F.count("session_id").alias("lifetime_sessions"))
    )


def frequency_band(orders: Column) -> Column:
    none, one, few, many = FREQUENCY_BANDS
    return (
        F.when(F.coalesce(orders, F.lit(0)) == 0, none)
        .when(orders == 1, one)
        .when(orders.between(2, 3), few)
        .otherwise(many)
    )


def monetary_tier(revenue: Column, cuts: Sequence[float] = MONETARY_CUTS) -> Column:
    spent = F.coalesce(revenue, F.lit(0).cast(MONEY))
    tier = F.when(spent == 0, MONETARY_TIERS[0])
    for cut, label in zip(cuts, MONETARY_TIERS[1:]):
        tier = tier.when(spent < cut, label)
    return tier.otherwise(MONETARY_TIERS[-1])


def lifecycle(orders: Column, idle_days: Column, active: int = ACTIVE_DAYS, dormant: int = DORMANT_DAYS) -> Column:
    registered, single, current, asleep, lost = LIFECYCLE
    return (
        F.when(F.coalesce(orders, F.lit(0)) == 0, registered)
        .when(orders == 1, single)
        .when((orders > 1) & (idle_days <= active), current)
        .when((orders > 1) & (idle_days <= dormant), asleep)
        .otherwise(lost)
    )


def dim_users(
    users: DataFrame,
    sessions: DataFrame,
    summary: DataFrame,
    as_of,
    monetary_cuts: Sequence[float] = MONETARY_CUTS,
    active_days: int = ACTIVE_DAYS,
    dormant_days: int = DORMANT_DAYS,
) -> DataFrame:
    """Users with lifetime figures and recency, frequency and monetary classes at ``as_of``."""
    today = F.lit(as_of)
    zero = F.lit(0).cast(MONEY)
    joined = users.join(sessions_per_user(sessions), "user_id", "left").join(
        summary.drop("cohort_month"), "user_id", "left"
    )
    orders, last_date = F.col("lifetime_orders"), F.col("most_recent_order_date")
    return joined.select(
        "user_id",
        F.col("signup_timestamp").alias("first_seen_at"),
        "signup_timestamp",
        "signup_date",
        "cohort_month",
        "signup_cohort_month",
        "country",
        "device_preference",
        "customer_segment",
        "acquisition_channel",
        "first_order_timestamp",
        "first_order_date",
        "most_recent_order_timestamp",
        last_date.alias("last_order_date"),
        "most_recent_order_date",
        F.coalesce("lifetime_sessions", F.lit(0)).alias("lifetime_sessions"),
        F.coalesce(orders, F.lit(0)).alias("lifetime_orders"),
        F.coalesce("lifetime_revenue", zero).alias("lifetime_revenue"),
        F.coalesce("lifetime_gross_profit", zero).alias("lifetime_gross_profit"),
        F.coalesce("avg_order_value", F.lit(0.0)).alias("avg_order_value"),
        F.coalesce("avg_days_between_orders", F.lit(0.0)).alias("avg_days_between_orders"),
        day_diff(F.coalesce(last_date, F.col("signup_date")), today).alias("recency_days"),
        frequency_band(orders).alias("frequency_band"),
        monetary_tier(F.col("lifetime_revenue"), monetary_cuts).alias("monetary_tier"),
        lifecycle(orders, day_diff("most_recent_order_timestamp", today), active_days, dormant_days).alias(
            "customer_lifecycle_status"
        ),
    )
