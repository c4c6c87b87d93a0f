"""Typed, trimmed staging of the six raw tables. Rows without a primary key are dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlens.functions.scalar import (
    clean_key,
    clean_text,
    money,
    money_or_zero,
    month_start,
    safe_divide,
    second_diff,
)


def stg_users(users: DataFrame) -> DataFrame:
    signup = F.col("created_at").cast("timestamp_ntz")
    return users.where(F.col("user_id").isNotNull()).select(
        clean_key(users, "user_id").alias("user_id"),
        signup.alias("signup_timestamp"),
        F.to_date(signup).alias("signup_date"),
        month_start(signup).alias("signup_cohort_month"),
        month_start(signup).alias("cohort_month"),
        F.upper(clean_text("country")).alias("country"),
        clean_text("acquisition_channel").alias("acquisition_channel"),
        clean_text("customer_segment").alias("customer_segment"),
        clean_text("device_preference").alias("device_preference"),
    )


def stg_sessions(sessions: DataFrame) -> DataFrame:
    start = F.col("session_start").cast("timestamp_ntz")
    end = F.col("session_end").cast("timestamp_ntz")
    return sessions.where(F.col("session_id").isNotNull()).select(
        clean_key(sessions, "session_id").alias("session_id"),
        clean_key(sessions, "user_id").alias("user_id"),
        start.alias("session_start"),
        end.alias("session_end"),
        F.to_date(start).alias("session_date"),
        second_diff(start, end).alias("session_duration_seconds"),
        clean_text("device_type").alias("device_type"),
        F.upper(clean_text("country")).alias("country"),
        clean_text("traffic_source").alias("traffic_source"),
        clean_text("channel").alias("channel"),
        F.col("is_bounce").cast("boolean").alias("is_bounce"),
        F.col("is_returning_user").cast("boolean").alias("is_returning_user"),
        F.col("is_new_user").cast("boolean").alias("is_new_user"),
        F.lower(clean_text("ab_variant")).alias("ab_variant"),
        clean_text("experiment_id").alias("experiment_id"),
    )


def clean_events(events: DataFrame, cart_type: str = "decimal(18,2)") -> DataFrame:
    at = F.col("event_timestamp").cast("timestamp_ntz")
    return events.where(F.col("event_id").isNotNull()).select(
        clean_key(events, "event_id").alias("event_id"),
        clean_key(events, "session_id").alias("session_id"),
        clean_key(events, "user_id").alias("user_id"),
        at.alias("event_timestamp"),
        F.to_date(at).alias("event_date"),
        F.lower(clean_text("event_name")).alias("event_name"),
        F.lower(clean_text("event_type")).alias("event_type"),
        F.col("step_number").cast("int").alias("step_number"),
        clean_text("page_url").alias("page_url"),
        F.nullif(clean_text("product_id"), F.lit("")).alias("product_id"),
        F.coalesce(F.col("cart_value").cast(cart_type), F.lit(0).cast(cart_type)).alias("cart_value"),
    )


def stg_events(events: DataFrame) -> DataFrame:
    return clean_events(events)


def stg_orders(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("order_id").isNotNull()).select(
        clean_key(orders, "order_id").alias("order_id"),
        clean_key(orders, "session_id").alias("session_id"),
        clean_key(orders, "user_id").alias("user_id"),
        F.col("order_date").cast("date").alias("order_date"),
        F.col("order_timestamp").cast("timestamp_ntz").alias("order_timestamp"),
        money_or_zero("subtotal").alias("subtotal"),
        money_or_zero("subtotal").alias("subtotal_amount"),
        money_or_zero("tax_amount").alias("tax_amount"),
        money_or_zero("shipping_fee").alias("shipping_fee"),
        money_or_zero("shipping_fee").alias("shipping_amount"),
        money_or_zero("discount_amount").alias("discount_amount"),
        money_or_zero("total_amount").alias("total_amount"),
        clean_text("payment_method").alias("payment_method"),
        F.lower(clean_text("status")).alias("status"),
        F.lower(clean_text("ab_variant")).alias("ab_variant"),
    )


def stg_order_items(items: DataFrame) -> DataFrame:
    return items.where(F.col("order_item_id").isNotNull()).select(
        clean_key(items, "order_item_id").alias("order_item_id"),
        clean_key(items, "order_id").alias("order_id"),
        clean_key(items, "product_id").alias("product_id"),
        F.col("quantity").cast("int").alias("quantity"),
        money("unit_price").alias("unit_price"),
        money("unit_cost").alias("unit_cost"),
        money("line_total").alias("line_total"),
        F.coalesce(money("total_item_price"), money("line_total")).alias("total_item_price"),
        money("line_profit").alias("line_profit"),
    )


def stg_products(products: DataFrame) -> DataFrame:
    cost, price = money("cost"), money("price")
    return products.where(F.col("product_id").isNotNull()).select(
        clean_key(products, "product_id").alias("product_id"),
        clean_text("product_name").alias("product_name"),
        clean_text("category").alias("category"),
        cost.alias("cost"),
        price.alias("price"),
        money("margin").alias("margin"),
        (price - cost).alias("unit_margin"),
        safe_divide(price - cost, price).alias("margin_rate"),
        F.col("inventory_count").cast("int").alias("inventory_count"),
        F.col("created_at").cast("date").alias("created_at"),
    )
