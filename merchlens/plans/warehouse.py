"""Raw tables -> staging -> intermediate -> marts, as one graph of lazy DataFrames."""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame

from merchlens.operators import dimensions, facts, orders, sessions, staging
from merchlens.operators.hotkeys import HOT_ROWS
from merchlens.operators.sessions import STAGES, Stage
from merchlens.sources.bindings import RawTables

# The models of each layer, in build order.
STAGING = ("stg_users", "stg_sessions", "stg_events", "stg_orders", "stg_order_items", "stg_products")
INTERMEDIATE = (
    "int_session_funnel_events",
    "int_order_items_aggregated",
    "int_user_order_summary",
    "int_user_cohort_monthly",
    "int_ab_session_conversions",
)
MARTS = ("dim_date", "dim_products", "dim_users", "fct_funnel", "fct_orders", "fct_user_retention", "fct_ab_test")
MODELS = STAGING + INTERMEDIATE + MARTS


class Warehouse:
    """Models by name. Nothing runs until a model is written or collected."""

    def __init__(
        self,
        raw: RawTables,
        as_of,
        stages: Sequence[Stage] = STAGES,
        entry: str = "checkout_started",
        payment: str = "payment_started",
        purchase: str = "purchase",
        sessions_since=None,
        orders_since=None,
        hot_rows: int = HOT_ROWS,
        **rfm,
    ):
        self.raw, self.as_of, self.stages = raw, as_of, tuple(stages)
        self.arms = {"entry": entry, "payment": payment, "purchase": purchase}
        self.sessions_since, self.orders_since = sessions_since, orders_since
        self.hot_rows, self.rfm = hot_rows, rfm

    def __getitem__(self, model: str) -> DataFrame:
        if model not in MODELS:
            raise KeyError(model)
        return getattr(self, model)

    @cached_property
    def stg_users(self):
        return staging.stg_users(self.raw.users)

    @cached_property
    def stg_sessions(self):
        return staging.stg_sessions(self.raw.sessions)

    @cached_property
    def stg_events(self):
        return staging.stg_events(self.raw.events)

    @cached_property
    def stg_orders(self):
        return staging.stg_orders(self.raw.orders)

    @cached_property
    def stg_order_items(self):
        return staging.stg_order_items(self.raw.order_items)

    @cached_property
    def stg_products(self):
        return staging.stg_products(self.raw.products)

    @cached_property
    def int_session_funnel_events(self):
        return sessions.session_funnel(self.stg_events, self.stages)

    @cached_property
    def int_order_items_aggregated(self):
        return orders.order_items_agg(self.stg_order_items, self.stg_products)

    @cached_property
    def int_user_order_summary(self):
        return orders.user_order_summary(self.stg_orders, self.int_order_items_aggregated)

    @cached_property
    def int_user_cohort_monthly(self):
        return orders.user_cohort_monthly(self.stg_users, self.stg_orders, self.int_order_items_aggregated)

    @cached_property
    def int_ab_session_conversions(self):
        return facts.experiment_sessions(
            self.stg_sessions, self.int_session_funnel_events, self.stg_orders, **self.arms, hot_rows=self.hot_rows
        )

    @cached_property
    def dim_date(self):
        """The calendar that spans the orders."""
        return dimensions.calendar_of(self.stg_orders, "order_date")

    @cached_property
    def dim_products(self):
        return dimensions.dim_products(self.stg_products, self.stg_order_items)

    @cached_property
    def dim_users(self):
        return dimensions.dim_users(
            self.stg_users, self.stg_sessions, self.int_user_order_summary, self.as_of, **self.rfm
        )

    @cached_property
    def fct_funnel(self):
        return facts.fct_funnel(
            self.stg_sessions,
            self.stg_users,
            self.int_session_funnel_events,
            self.stg_orders,
            self.stages,
            self.sessions_since,
            self.hot_rows,
        )

    @cached_property
    def fct_orders(self):
        return facts.fct_orders(
            self.stg_orders,
            self.stg_sessions,
            self.stg_users,
            self.int_order_items_aggregated,
            self.orders_since,
            self.hot_rows,
        )

    @cached_property
    def fct_user_retention(self):
        return facts.fct_user_retention(self.int_user_cohort_monthly)

    @cached_property
    def fct_ab_test(self):
        return facts.fct_ab_test(self.int_ab_session_conversions, self.stg_users)
