"""DuckDB SQL of the bound raw tables and of each model, used as common table expressions."""

from __future__ import annotations

_DEVICE = "CASE {u} % 3 WHEN 0 THEN 'Desktop' WHEN 1 THEN 'Mobile' ELSE 'Tablet' END"
_VARIANT = "CASE WHEN ({u} + day({d})) % 2 = 0 THEN ' Control ' ELSE ' Treatment ' END"
_STEPS = "CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'signup' THEN 3 WHEN 'purchase' THEN 4 ELSE 0 END"
M = "CAST({} AS DECIMAL(18,2))"

_USERS = f"""
SELECT c_custkey AS user_id,
       CAST(DATE '1994-12-01' + CAST(c_custkey % 31 AS INT) AS TIMESTAMP) AS created_at,
       ' ' || lower(n_name) || ' ' AS country, ' ' || r_name || ' ' AS acquisition_channel,
       ' ' || c_mktsegment || ' ' AS customer_segment, {_DEVICE.format(u='c_custkey')} AS device_preference
FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey"""

_PRODUCTS = f"""
SELECT p_partkey AS product_id, ' ' || p_name || ' ' AS product_name, ' ' || p_type || ' ' AS category,
       CAST({M.format('p_retailprice')} * 6 / 10 AS DECIMAL(18,2)) AS cost, {M.format('p_retailprice')} AS price,
       CAST({M.format('p_retailprice')} - CAST({M.format('p_retailprice')} * 6 / 10 AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS margin,
       p_size AS inventory_count, DATE '1994-12-01' AS created_at
FROM part"""

_ITEMS = f"""
SELECT l_orderkey * 100 + l_linenumber AS order_item_id, l_orderkey AS order_id, l_partkey AS product_id,
       CAST(l_quantity AS INT) AS quantity, price AS unit_price, cost AS unit_cost,
       {M.format('l_extendedprice')} AS line_total, CAST(NULL AS DECIMAL(18,2)) AS total_item_price,
       CAST({M.format('l_extendedprice')} - CAST(l_quantity AS INT) * cost AS DECIMAL(18,2)) AS line_profit
FROM lineitem JOIN raw_products ON product_id = l_partkey"""

_EVENTS = f"""
SELECT event_id, user_id || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS session_id, user_id, ts AS event_timestamp,
       ' ' || upper(event_type) || ' ' AS event_name,
       ' ' || upper(event_type[1]) || event_type[2:] || ' ' AS event_type,
       {_STEPS} AS step_number, ' /' || event_type AS page_url,
       CASE WHEN event_id % 5 = 0 THEN ' ' ELSE CAST(event_id % 200 AS VARCHAR) END AS product_id,
       {M.format('value')} AS cart_value
FROM events"""

_COMMON = {"raw_users": _USERS, "raw_products": _PRODUCTS, "raw_order_items": _ITEMS, "raw_events": _EVENTS}

ORDERS = {
    **_COMMON,
    "order_rows": f"""
SELECT o_orderkey AS order_id, o_orderkey AS session_id, o_custkey AS user_id, CAST(o_orderdate AS DATE) AS order_date,
       o_orderdate AS order_timestamp, {M.format('o_totalprice')} AS total_amount, o_orderpriority AS payment_method,
       CASE o_orderstatus WHEN 'F' THEN ' Completed ' WHEN 'O' THEN ' Pending ' ELSE ' Cancelled ' END AS status,
       CASE WHEN o_orderkey % 2 = 0 THEN ' Control ' ELSE ' Treatment ' END AS ab_variant
FROM orders""",
    "raw_orders": f"""
SELECT o.*, s.subtotal, CAST(NULL AS DECIMAL(18,2)) AS tax_amount, CAST(NULL AS DECIMAL(18,2)) AS shipping_fee,
       CAST(NULL AS DECIMAL(18,2)) AS discount_amount
FROM order_rows o
LEFT JOIN (SELECT l_orderkey, SUM({M.format('l_extendedprice')}) AS subtotal FROM lineitem GROUP BY l_orderkey) s
       ON s.l_orderkey = o.order_id""",
    "raw_sessions": f"""
SELECT session_id, user_id, order_timestamp AS session_start, order_timestamp AS session_end,
       {_DEVICE.format(u='user_id')} AS device_type, CAST(NULL AS VARCHAR) AS country,
       ' ' || payment_method || ' ' AS traffic_source, payment_method AS channel, FALSE AS is_bounce,
       CAST(NULL AS BOOLEAN) AS is_returning_user, CAST(NULL AS BOOLEAN) AS is_new_user, ab_variant,
       'checkout_optimization' AS experiment_id
FROM order_rows""",
    "as_of": "SELECT DATE '2001-08-02' AS today",
}

CLICK = {
    **_COMMON,
    "raw_order_items": f"""
SELECT event_id * 100 + 1 AS order_item_id, event_id AS order_id, event_id % 200 AS product_id, 1 AS quantity,
       {M.format('value')} AS unit_price, CAST({M.format('value')} * 6 / 10 AS DECIMAL(18,2)) AS unit_cost,
       {M.format('value')} AS line_total, CAST(NULL AS DECIMAL(18,2)) AS total_item_price,
       CAST({M.format('value')} - CAST({M.format('value')} * 6 / 10 AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS line_profit
FROM events WHERE event_type = 'purchase'""",
    "user_days": """
SELECT session_id, user_id, MIN(event_timestamp) AS session_start, MAX(event_timestamp) AS session_end,
       MAX(step_number) AS furthest_step,
       ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY MIN(event_timestamp)) AS nth
FROM raw_events GROUP BY session_id, user_id""",
    "raw_sessions": f"""
SELECT session_id, user_id, session_start, session_end, {_DEVICE.format(u='user_id')} AS device_type,
       'geo_' || (user_id % 7) AS country,
       ' ' || (['organic', 'paid_search', 'direct', 'social'])[user_id % 4 + 1] || ' ' AS traffic_source,
       (['organic', 'paid_search', 'direct', 'social'])[user_id % 4 + 1] AS channel,
       furthest_step = 1 AS is_bounce, nth > 1 AS is_returning_user, nth = 1 AS is_new_user,
       {_VARIANT.format(u='user_id', d='session_start')} AS ab_variant, 'checkout_optimization' AS experiment_id
FROM user_days""",
    "raw_orders": f"""
SELECT event_id AS order_id, user_id || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS session_id, user_id,
       CAST(ts AS DATE) AS order_date, ts AS order_timestamp, {M.format('value')} AS subtotal,
       CAST(NULL AS DECIMAL(18,2)) AS tax_amount, CAST(NULL AS DECIMAL(18,2)) AS shipping_fee,
       CAST(NULL AS DECIMAL(18,2)) AS discount_amount, {M.format('value')} AS total_amount, 'card' AS payment_method,
       ' Completed ' AS status, {_VARIANT.format(u='user_id', d='ts')} AS ab_variant
FROM events WHERE event_type = 'purchase'""",
    "as_of": "SELECT TIMESTAMP '2024-01-31 00:00:00' AS today",
}

_STAGES = ["view", "click", "signup", "purchase"]


def _each(pattern: str, sep: str = ", ") -> str:
    return sep.join(pattern.format(s=s, n=i) for i, s in enumerate(_STAGES, 1))


MODELS = {
    "stg_users": """
SELECT user_id, created_at AS signup_timestamp, CAST(created_at AS DATE) AS signup_date,
       CAST(date_trunc('month', created_at) AS DATE) AS signup_cohort_month,
       CAST(date_trunc('month', created_at) AS DATE) AS cohort_month, upper(trim(country)) AS country,
       trim(acquisition_channel) AS acquisition_channel, trim(customer_segment) AS customer_segment,
       trim(device_preference) AS device_preference
FROM raw_users WHERE user_id IS NOT NULL""",
    "stg_sessions": """
SELECT session_id, user_id, session_start, session_end, CAST(session_start AS DATE) AS session_date,
       CAST(greatest(0, date_diff('second', session_start, session_end)) AS BIGINT) AS session_duration_seconds,
       trim(device_type) AS device_type, upper(trim(country)) AS country, trim(traffic_source) AS traffic_source,
       trim(channel) AS channel, is_bounce, is_returning_user, is_new_user, lower(trim(ab_variant)) AS ab_variant,
       trim(experiment_id) AS experiment_id
FROM raw_sessions WHERE session_id IS NOT NULL""",
    "stg_events": """
SELECT event_id, session_id, user_id, event_timestamp, CAST(event_timestamp AS DATE) AS event_date,
       lower(trim(event_name)) AS event_name, lower(trim(event_type)) AS event_type, step_number,
       trim(page_url) AS page_url, nullif(trim(product_id), '') AS product_id,
       coalesce(cart_value, CAST(0 AS DECIMAL(18,2))) AS cart_value
FROM raw_events WHERE event_id IS NOT NULL""",
    "stg_orders": """
SELECT order_id, session_id, user_id, order_date, order_timestamp,
       CAST(coalesce(subtotal, 0) AS DECIMAL(18,2)) AS subtotal, CAST(coalesce(subtotal, 0) AS DECIMAL(18,2)) AS subtotal_amount,
       CAST(coalesce(tax_amount, 0) AS DECIMAL(18,2)) AS tax_amount, CAST(coalesce(shipping_fee, 0) AS DECIMAL(18,2)) AS shipping_fee,
       CAST(coalesce(shipping_fee, 0) AS DECIMAL(18,2)) AS shipping_amount,
       CAST(coalesce(discount_amount, 0) AS DECIMAL(18,2)) AS discount_amount,
       CAST(coalesce(total_amount, 0) AS DECIMAL(18,2)) AS total_amount, trim(payment_method) AS payment_method,
       lower(trim(status)) AS status, lower(trim(ab_variant)) AS ab_variant
FROM raw_orders WHERE order_id IS NOT NULL""",
    "stg_order_items": """
SELECT order_item_id, order_id, product_id, quantity, unit_price, unit_cost, line_total,
       coalesce(total_item_price, line_total) AS total_item_price, line_profit
FROM raw_order_items WHERE order_item_id IS NOT NULL""",
    "stg_products": """
SELECT product_id, trim(product_name) AS product_name, trim(category) AS category, cost, price, margin,
       price - cost AS unit_margin, CAST(price - cost AS DOUBLE) / nullif(CAST(price AS DOUBLE), 0) AS margin_rate,
       inventory_count, created_at
FROM raw_products WHERE product_id IS NOT NULL""",
    "int_session_funnel_events": f"""
SELECT session_id, user_id, count(event_id) AS total_events_count,
       {_each("count(*) FILTER (event_type = '{s}') AS {s}_events")},
       {_each("bool_or(event_type = '{s}') AS has_{s}")},
       {_each("CAST(bool_or(event_type = '{s}') AS INT) AS reached_{s}")},
       coalesce(max(step_number), 0) AS furthest_step_reached, coalesce(max(step_number), 0) AS funnel_stage_order,
       CASE max(step_number) {_each("WHEN {n} THEN '{n}_{s}'", " ")} ELSE '0_none' END AS funnel_stage_reached,
       {_each("min(event_timestamp) FILTER (event_type = '{s}') AS first_{s}_at")},
       max(cart_value) AS final_cart_value
FROM stg_events GROUP BY session_id, user_id""",
    "int_order_items_aggregated": """
SELECT order_id, sum(quantity) AS total_items_count, sum(quantity) AS item_count,
       count(DISTINCT i.product_id) AS distinct_products_count, sum(line_total) AS gross_items_revenue,
       sum(line_total) AS subtotal_sum, sum(quantity * unit_cost) AS total_cogs, sum(quantity * unit_cost) AS total_cost,
       sum(line_profit) AS gross_profit, sum(line_profit) AS gross_margin_amount,
       CAST(sum(line_profit) AS DOUBLE) / nullif(CAST(sum(line_total) AS DOUBLE), 0) AS margin_rate,
       max(category) AS primary_product_category
FROM stg_order_items i LEFT JOIN stg_products p ON p.product_id = i.product_id GROUP BY order_id""",
    "done_orders": """
SELECT o.*, coalesce(CAST(i.gross_profit AS DECIMAL(18,2)), o.total_amount * 0.4) AS profit
FROM stg_orders o LEFT JOIN int_order_items_aggregated i ON i.order_id = o.order_id WHERE o.status = 'completed'""",
    "done_gaps": """
SELECT *, date_diff('day', lag(order_timestamp) OVER (PARTITION BY user_id ORDER BY order_timestamp, order_id),
                    order_timestamp) AS gap
FROM done_orders""",
    "int_user_order_summary": """
SELECT user_id, count(order_id) AS lifetime_orders, count(order_id) AS lifetime_completed_orders,
       min(order_timestamp) AS first_order_timestamp, min(order_timestamp) AS first_order_at,
       min(order_date) AS first_order_date,
       CAST(date_trunc('month', min(order_date)) AS DATE) AS first_order_cohort_month,
       CAST(date_trunc('month', min(order_date)) AS DATE) AS cohort_month,
       max(order_timestamp) AS most_recent_order_timestamp, max(order_timestamp) AS last_order_at,
       max(order_date) AS most_recent_order_date, max(order_date) AS last_order_date,
       sum(total_amount) AS lifetime_revenue, sum(profit) AS lifetime_gross_profit,
       CAST(sum(total_amount) AS DOUBLE) / nullif(count(order_id), 0) AS lifetime_aov,
       CAST(sum(total_amount) AS DOUBLE) / nullif(count(order_id), 0) AS avg_order_value,
       avg(gap) AS avg_days_between_orders
FROM done_gaps GROUP BY user_id""",
    "int_user_cohort_monthly": """
SELECT u.user_id, u.customer_segment, u.country, u.acquisition_channel, u.signup_cohort_month,
       s.first_order_cohort_month AS cohort_month, m.activity_month,
       CAST(date_diff('month', s.first_order_cohort_month, m.activity_month) AS BIGINT) AS month_number,
       CAST(date_diff('month', s.first_order_cohort_month, m.activity_month) AS BIGINT) AS month_offset,
       m.n AS monthly_orders, m.n AS orders_in_month, m.revenue AS monthly_revenue, m.revenue AS revenue_in_month,
       m.profit AS monthly_gross_profit, 1 AS is_retained, 1 AS is_active
FROM (SELECT user_id, CAST(date_trunc('month', order_date) AS DATE) AS activity_month, count(DISTINCT order_id) AS n,
             sum(total_amount) AS revenue, sum(profit) AS profit FROM done_orders GROUP BY 1, 2) m
JOIN int_user_order_summary s USING (user_id) JOIN stg_users u USING (user_id)""",
    "dim_date": """
SELECT CAST(d AS DATE) AS date_day, year(d) AS year, quarter(d) AS quarter,
       'Q' || quarter(d) || ' ' || year(d) AS quarter_name, month(d) AS month, strftime(d, '%B') AS month_name,
       strftime(d, '%b') AS month_short, strftime(d, '%Y-%m') AS year_month, week(d) AS week_of_year,
       day(d) AS day_of_month, dayofweek(d) AS day_of_week, strftime(d, '%A') AS day_name,
       strftime(d, '%a') AS day_short, dayofweek(d) IN (0, 6) AS is_weekend,
       CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key
FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d
      FROM (SELECT min(order_date) AS lo, max(order_date) AS hi FROM stg_orders))""",
    "product_sales": """
SELECT product_id, count(DISTINCT order_id) AS n, sum(quantity) AS units, sum(line_total) AS revenue,
       sum(line_profit) AS profit FROM stg_order_items GROUP BY product_id""",
    "dim_products": """
SELECT p.product_id, product_name, category, cost, price, round(price - cost, 2) AS margin_amount,
       round(CAST(price - cost AS DOUBLE) / nullif(CAST(price AS DOUBLE), 0) * 100, 2) AS margin_percentage,
       margin, unit_margin, margin_rate, inventory_count, created_at, coalesce(n, 0) AS total_orders_count,
       coalesce(units, 0) AS total_units_sold, coalesce(revenue, 0) AS total_revenue_generated,
       coalesce(profit, 0) AS total_profit_generated,
       CAST(revenue AS DOUBLE) / nullif(CAST(units AS DOUBLE), 0) AS realized_avg_selling_price
FROM stg_products p LEFT JOIN product_sales s ON s.product_id = p.product_id""",
    "dim_users": """
SELECT u.user_id, signup_timestamp AS first_seen_at, signup_timestamp, signup_date, u.cohort_month, signup_cohort_month,
       country, device_preference, customer_segment, acquisition_channel, first_order_timestamp, first_order_date,
       most_recent_order_timestamp, most_recent_order_date AS last_order_date, most_recent_order_date,
       coalesce(visits, 0) AS lifetime_sessions, coalesce(lifetime_orders, 0) AS lifetime_orders,
       coalesce(lifetime_revenue, 0) AS lifetime_revenue, coalesce(lifetime_gross_profit, 0) AS lifetime_gross_profit,
       coalesce(avg_order_value, 0) AS avg_order_value, coalesce(avg_days_between_orders, 0) AS avg_days_between_orders,
       date_diff('day', coalesce(most_recent_order_date, signup_date), CAST(today AS DATE)) AS recency_days,
       CASE coalesce(lifetime_orders, 0) WHEN 0 THEN '0 Orders' WHEN 1 THEN '1 Order' WHEN 2 THEN '2-3 Orders'
            WHEN 3 THEN '2-3 Orders' ELSE '4+ Orders' END AS frequency_band,
       CASE WHEN coalesce(lifetime_revenue, 0) = 0 THEN 'Tier 0: Non-Buyer' WHEN lifetime_revenue < 100 THEN 'Tier 1: Low Value'
            WHEN lifetime_revenue < 300 THEN 'Tier 2: Mid Value' WHEN lifetime_revenue < 750 THEN 'Tier 3: High Value'
            ELSE 'Tier 4: VIP' END AS monetary_tier,
       CASE WHEN coalesce(lifetime_orders, 0) = 0 THEN 'Registered Non-Purchaser'
            WHEN lifetime_orders = 1 THEN 'Single Purchaser'
            WHEN CAST(today AS DATE) - CAST(most_recent_order_timestamp AS DATE) <= 60 THEN 'Active Repeat'
            WHEN CAST(today AS DATE) - CAST(most_recent_order_timestamp AS DATE) <= 120 THEN 'Dormant Repeat'
            ELSE 'Churned Repeat' END AS customer_lifecycle_status
FROM stg_users u LEFT JOIN int_user_order_summary s ON s.user_id = u.user_id
LEFT JOIN (SELECT user_id, count(session_id) AS visits FROM stg_sessions GROUP BY user_id) v ON v.user_id = u.user_id
CROSS JOIN as_of""",
    "fct_funnel": f"""
SELECT s.session_id, s.user_id, session_start, session_end, session_date, session_duration_seconds, device_type,
       traffic_source, coalesce(u.country, s.country) AS country, coalesce(u.customer_segment, 'Regular') AS customer_segment,
       s.ab_variant, is_returning_user, {_each("coalesce(f.has_{s}, FALSE) AS has_{s}")},
       {_each("coalesce(f.reached_{s}, 0) AS reached_{s}")},
       coalesce(furthest_step_reached, 0) AS furthest_step_reached, coalesce(funnel_stage_order, 0) AS funnel_stage_order,
       coalesce(funnel_stage_reached, '0_none') AS funnel_stage_reached, coalesce(total_events_count, 0) AS total_events_count,
       o.order_id, coalesce(o.total_amount, 0) AS order_revenue, CAST(o.order_id IS NOT NULL AS INT) AS is_converting_session
FROM stg_sessions s LEFT JOIN stg_users u ON u.user_id = s.user_id
LEFT JOIN int_session_funnel_events f ON f.session_id = s.session_id
LEFT JOIN (SELECT * FROM stg_orders WHERE status = 'completed') o ON o.session_id = s.session_id""",
    "numbered_orders": """
SELECT *, row_number() OVER w AS user_order_sequence, lag(order_timestamp) OVER w AS prior_order_timestamp
FROM stg_orders WINDOW w AS (PARTITION BY user_id ORDER BY order_timestamp, order_id)""",
    "fct_orders": """
SELECT o.order_id, o.session_id, o.user_id, order_timestamp, order_date, status, subtotal_amount AS subtotal, subtotal_amount,
       shipping_amount AS shipping_fee, shipping_amount, tax_amount, discount_amount, total_amount, payment_method, o.ab_variant,
       coalesce(total_items_count, 1) AS item_count, coalesce(total_items_count, 1) AS total_items_count,
       coalesce(distinct_products_count, 1) AS distinct_products_count, coalesce(total_cogs, 0) AS total_cost,
       coalesce(total_cogs, 0) AS total_cogs, coalesce(CAST(gross_profit AS DECIMAL(18,2)), total_amount * 0.4) AS gross_margin_amount,
       coalesce(CAST(gross_profit AS DECIMAL(18,2)), total_amount * 0.4) AS gross_profit, coalesce(margin_rate, 0.4) AS margin_rate,
       primary_product_category, user_order_sequence, user_order_sequence = 1 AS is_first_order,
       user_order_sequence > 1 AS is_repeat_order, date_diff('day', prior_order_timestamp, order_timestamp) AS days_since_prior_order,
       date_diff('day', signup_date, CAST(order_timestamp AS DATE)) AS days_since_user_signup, s.device_type, s.traffic_source,
       coalesce(u.country, 'Unknown') AS country, coalesce(u.customer_segment, 'Regular') AS customer_segment
FROM numbered_orders o LEFT JOIN stg_sessions s ON s.session_id = o.session_id
LEFT JOIN stg_users u ON u.user_id = o.user_id
LEFT JOIN int_order_items_aggregated i ON i.order_id = o.order_id""",
    "fct_user_retention": """
SELECT *, sum(monthly_orders) OVER w AS cumulative_orders, sum(monthly_revenue) OVER w AS cumulative_revenue,
       sum(monthly_gross_profit) OVER w AS cumulative_gross_profit
FROM int_user_cohort_monthly
WINDOW w AS (PARTITION BY user_id ORDER BY activity_month ROWS UNBOUNDED PRECEDING)""",
    "int_ab_session_conversions": """
SELECT s.session_id, s.user_id, session_date, session_start, s.ab_variant, device_type, country, traffic_source,
       f.has_click AS has_checkout_started, f.has_signup AS has_payment_started, f.has_purchase, 1 AS started_checkout,
       CAST(f.has_signup AS INT) AS completed_payment, CAST(f.has_purchase AS INT) AS completed_purchase, o.order_id,
       coalesce(o.total_amount, 0) AS order_revenue
FROM int_session_funnel_events f JOIN stg_sessions s ON s.session_id = f.session_id
LEFT JOIN (SELECT * FROM stg_orders WHERE status = 'completed') o ON o.session_id = s.session_id WHERE f.has_click""",
    "fct_ab_test": """
SELECT a.session_id, a.user_id, session_date, session_start, ab_variant, device_type, a.country,
       coalesce(u.customer_segment, 'Regular') AS customer_segment, traffic_source, 1 AS entered_checkout, started_checkout,
       completed_payment, completed_purchase, completed_purchase AS converted_to_purchase, order_id, order_revenue,
       date_diff('day', u.signup_date, a.session_date) AS days_since_user_signup
FROM int_ab_session_conversions a LEFT JOIN stg_users u ON u.user_id = a.user_id""",
}
