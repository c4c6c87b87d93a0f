"""Staging, intermediate and mart models."""

from __future__ import annotations

from checks.registry import clicks, query, shop

# Query name, world, and the columns whose result type the SQL has to state
# (doubles, then bigints).
BOUND = {
    "stg_users": (
        "stg_1_users",
        "orders",
        "",
        "",
    ),
    "stg_sessions": (
        "stg_2_sessions",
        "click",
        "",
        "session_duration_seconds",
    ),
    "stg_events": (
        "stg_3_events",
        "click",
        "cart_value",
        "step_number",
    ),
    "stg_orders": (
        "stg_4_orders",
        "orders",
        "subtotal subtotal_amount tax_amount shipping_fee shipping_amount discount_amount total_amount",
        "",
    ),
    "stg_order_items": (
        "stg_5_order_items",
        "orders",
        "unit_price unit_cost line_total total_item_price line_profit",
        "quantity",
    ),
    "stg_products": (
        "stg_6_products",
        "orders",
        "cost price margin unit_margin margin_rate",
        "inventory_count",
    ),
    "int_session_funnel_events": (
        "agg_1_session_funnel",
        "click",
        "final_cart_value",
        "total_events_count view_events click_events signup_events purchase_events reached_view reached_click reached_signup reached_purchase furthest_step_reached funnel_stage_order",
    ),
    "int_order_items_aggregated": (
        "agg_2_order_items",
        "orders",
        "gross_items_revenue subtotal_sum total_cogs total_cost gross_profit gross_margin_amount margin_rate",
        "total_items_count item_count distinct_products_count",
    ),
    "int_user_order_summary": (
        "agg_3_user_order_summary",
        "orders",
        "lifetime_revenue lifetime_gross_profit lifetime_aov avg_order_value avg_days_between_orders",
        "lifetime_orders lifetime_completed_orders",
    ),
    "int_user_cohort_monthly": (
        "agg_4_user_cohort_monthly",
        "orders",
        "monthly_revenue revenue_in_month monthly_gross_profit",
        "month_number month_offset monthly_orders orders_in_month is_retained is_active",
    ),
    "dim_date": (
        "mrt_1_dim_date",
        "orders",
        "",
        "year quarter month week_of_year day_of_month day_of_week date_key",
    ),
    "dim_products": (
        "mrt_2_dim_products",
        "orders",
        "cost price margin_amount margin_percentage margin unit_margin margin_rate total_revenue_generated total_profit_generated realized_avg_selling_price",
        "inventory_count total_orders_count total_units_sold",
    ),
    "dim_users": (
        "mrt_3_dim_users",
        "orders",
        "lifetime_revenue lifetime_gross_profit avg_order_value avg_days_between_orders",
        "lifetime_sessions lifetime_orders recency_days",
    ),
    "fct_funnel": (
        "mrt_4_fct_funnel",
        "click",
        "order_revenue",
        "session_duration_seconds reached_view reached_click reached_signup reached_purchase furthest_step_reached funnel_stage_order total_events_count is_converting_session",
    ),
    "fct_orders": (
        "mrt_5_fct_orders",
        "orders",
        "subtotal subtotal_amount shipping_fee shipping_amount tax_amount discount_amount total_amount total_cost total_cogs gross_margin_amount gross_profit margin_rate",
        "item_count total_items_count distinct_products_count user_order_sequence days_since_prior_order days_since_user_signup",
    ),
    "fct_user_retention": (
        "mrt_6_fct_user_retention",
        "orders",
        "monthly_revenue revenue_in_month monthly_gross_profit cumulative_revenue cumulative_gross_profit",
        "month_number month_offset monthly_orders orders_in_month is_retained is_active cumulative_orders",
    ),
    "int_ab_session_conversions": (
        "mrt_7_experiment_sessions",
        "click",
        "order_revenue",
        "started_checkout completed_payment completed_purchase",
    ),
    "fct_ab_test": (
        "mrt_8_fct_ab_test",
        "click",
        "order_revenue",
        "entered_checkout started_checkout completed_payment completed_purchase converted_to_purchase days_since_user_signup",
    ),
}


def typed(model: str, doubles: str, bigints: str) -> str:
    casts = [f"CAST({c} AS DOUBLE) AS {c}" for c in doubles.split()]
    casts += [f"CAST({c} AS BIGINT) AS {c}" for c in bigints.split()]
    return f"SELECT * REPLACE ({', '.join(casts)}) FROM {model}" if casts else f"SELECT * FROM {model}"


def _register(model: str, name: str, world: str, doubles: str, bigints: str) -> None:
    @query(name, typed(model, doubles, bigints), world)
    def build(spark, sf_dir):
        return (shop if world == "orders" else clicks)(spark, sf_dir)[model]


for _model, _binding in BOUND.items():
    _register(_model, *_binding)
