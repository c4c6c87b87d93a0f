"""Filters, joins, aggregates, windows, set operations and scalar functions on whole tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from checks.experiments import _ARMS, _STATS, _tails  # the SQL of the arms and of the test
from checks.registry import clicks, query, shop
from checks.sqltext import big, dbl, pct, slices
from merchlens.functions import scalar
from merchlens.operators import dimensions, facts, quality, star
from merchlens.operators.hotkeys import fan_out_join, sequence_rows
from merchlens.operators.sessions import dwell_summary, dwell_times, session_flags
from merchlens.plans import reports
from merchlens.sources import incremental
from merchlens.sources.bindings import CLICK_STAGES, table


@query("flt_1_known_keys", "SELECT count(*) AS orders FROM orders WHERE o_orderkey IS NOT NULL")
def known_keys(spark, sf_dir):
    return shop(spark, sf_dir).stg_orders.agg(F.count(F.lit(1)).alias("orders"))


@query("flt_2_completed_orders", f"SELECT order_id, user_id, {dbl('total_amount')} AS total_amount FROM stg_orders WHERE status = 'completed'")
def completed_orders(spark, sf_dir):
    return shop(spark, sf_dir).stg_orders.where(F.col("status") == "completed").select("order_id", "user_id", "total_amount")


@query(
    "flt_3_entered_sessions",
    "SELECT s.session_id, s.device_type FROM stg_sessions s JOIN int_session_funnel_events f ON f.session_id = s.session_id WHERE f.has_click",
    "click",
)
def entered(spark, sf_dir):
    w = clicks(spark, sf_dir)
    flags = w.int_session_funnel_events.where("has_click").select("session_id")
    return w.stg_sessions.select("session_id", "device_type").join(flags, "session_id")


@query(
    "flt_4_look_back",
    "SELECT session_id, session_start FROM stg_sessions WHERE session_start >= (SELECT max(session_start) - INTERVAL 3 DAY FROM stg_sessions)",
    "click",
)
def look_back(spark, sf_dir):
    sessions = clicks(spark, sf_dir).stg_sessions.select("session_id", "session_start")
    floor = incremental.look_back_floor(sessions, "session_start", 3)
    return sessions.where(F.col("session_start") >= F.lit(floor))


@query("prj_1_constants", "SELECT session_id, 1::BIGINT AS started_checkout, ab_variant, ab_variant AS variant FROM stg_sessions", "click")
def constants(spark, sf_dir):
    return clicks(spark, sf_dir).stg_sessions.select(
        "session_id", F.lit(1).alias("started_checkout"), "ab_variant", F.col("ab_variant").alias("variant")
    )


@query(
    "jn_1_inner",
    "SELECT u.user_id, u.customer_segment, s.cohort_month FROM stg_users u JOIN int_user_order_summary s ON s.user_id = u.user_id",
)
def inner(spark, sf_dir):
    w = shop(spark, sf_dir)
    return w.stg_users.select("user_id", "customer_segment").join(w.int_user_order_summary.select("user_id", "cohort_month"), "user_id")


@query(
    "jn_2_left_with_fan_out",
    f"""
SELECT s.session_id, o.order_id, {dbl('coalesce(o.total_amount, 0)')} AS revenue FROM stg_sessions s
LEFT JOIN (SELECT * FROM stg_orders WHERE status = 'completed') o ON o.session_id = s.session_id""",
    "click",
)
def fan_out(spark, sf_dir):
    """Every session key counts as hot here, so the spread path runs on the whole tables."""
    w = clicks(spark, sf_dir)
    joined = fan_out_join(w.stg_sessions.select("session_id"), facts.completed_by_session(w.stg_orders), "session_id", hot_rows=0, salts=4)
    return joined.select("session_id", "order_id", F.coalesce("total_amount", F.lit(0)).alias("revenue"))


@query(
    "jn_3_star_left",
    "SELECT o.order_id, s.device_type, s.traffic_source, u.country FROM stg_orders o LEFT JOIN stg_sessions s ON s.session_id = o.session_id LEFT JOIN stg_users u ON u.user_id = o.user_id",
)
def star_left(spark, sf_dir):
    w = shop(spark, sf_dir)
    return (
        w.stg_orders.select("order_id", "session_id", "user_id")
        .join(w.stg_sessions.select("session_id", "device_type", "traffic_source"), "session_id", "left")
        .join(w.stg_users.select("user_id", "country"), "user_id", "left")
        .select("order_id", "device_type", "traffic_source", "country")
    )


@query(
    "jn_4_preaggregated_child",
    f"SELECT u.user_id, coalesce(n, 0) AS orders, {dbl('coalesce(v, 0)')} AS spend FROM stg_users u LEFT JOIN (SELECT user_id, count(*) AS n, sum(total_amount) AS v FROM stg_orders GROUP BY 1) o ON o.user_id = u.user_id",
)
def preaggregated(spark, sf_dir):
    w = shop(spark, sf_dir)
    spend = w.stg_orders.groupBy("user_id").agg(F.count("order_id").alias("n"), scalar.sum_exact("total_amount").alias("v"))
    return w.stg_users.select("user_id").join(spend, "user_id", "left").select(
        "user_id", F.coalesce("n", F.lit(0)).alias("orders"), F.coalesce("v", F.lit(0)).alias("spend")
    )


@query("jn_5_orphan_items", "SELECT order_id, count(*) AS rows FROM stg_order_items WHERE order_id NOT IN (SELECT order_id FROM stg_orders) GROUP BY 1")
def orphan_items(spark, sf_dir):
    w = shop(spark, sf_dir)
    return quality.orphans(w.stg_order_items, "order_id", w.stg_orders, "order_id")


@query("jn_6_semi", "SELECT session_id, device_type FROM stg_sessions WHERE session_id IN (SELECT session_id FROM stg_events WHERE event_type = 'purchase')", "click")
def semi(spark, sf_dir):
    w = clicks(spark, sf_dir)
    bought = w.stg_events.where(F.col("event_type") == "purchase").select("session_id").distinct()
    return w.stg_sessions.select("session_id", "device_type").join(bought, "session_id", "left_semi")


@query("jn_7_orders_without_items", "SELECT o_orderkey AS order_id FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def without_items(spark, sf_dir):
    w = shop(spark, sf_dir)
    return quality.childless(w.stg_orders.select("order_id"), "order_id", w.stg_order_items, "order_id")


@query(
    "jn_8_attribute_agreement",
    "SELECT count(*) AS compared, count(*) FILTER (o.user_id IS DISTINCT FROM s.user_id) AS user_id_mismatches, count(*) FILTER (o.ab_variant IS DISTINCT FROM s.ab_variant) AS ab_variant_mismatches FROM stg_orders o JOIN stg_sessions s USING (session_id)",
    "click",
)
def agreement(spark, sf_dir):
    w = clicks(spark, sf_dir)
    return quality.attribute_mismatches(w.stg_orders, "session_id", w.stg_sessions, {"user_id": "user_id", "ab_variant": "ab_variant"})


@query(
    "jn_9_star_revenue",
    f"""
SELECT customer_segment, category, {big('year(order_date)')} AS year, count(DISTINCT o.order_id) AS total_orders,
       {dbl('round(sum(total_item_price), 2)')} AS gross_revenue, {dbl('round(sum(line_profit), 2)')} AS gross_profit,
       {pct('sum(line_profit)', 'sum(total_item_price)')} AS gross_margin_pct
FROM stg_order_items i JOIN stg_products p USING (product_id) JOIN stg_orders o USING (order_id) JOIN stg_users u ON u.user_id = o.user_id GROUP BY 1, 2, 3""",
)
def star_revenue(spark, sf_dir):
    w = shop(spark, sf_dir)
    return star.star_revenue(w.stg_orders, w.stg_users, w.stg_order_items, w.stg_products, w.dim_date)


_ROLE = """
SELECT strftime({d}, '%Y-%m') AS year_month, count(*) AS lines, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1"""


def _role(spark, sf_dir, column):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate", "l_extendedprice")
    placed = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    fact = lines.join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
    wanted = [F.count(F.lit(1)).alias("lines"), scalar.sum_exact(scalar.money("l_extendedprice")).alias("revenue")]
    return star.by_date_role(fact, F.col(column), wanted, ["year_month"])


@query("jn_10_by_order_date", _ROLE.format(d="o_orderdate"))
def by_order_date(spark, sf_dir):
    return _role(spark, sf_dir, "o_orderdate")


@query("jn_10_by_ship_date", _ROLE.format(d="l_shipdate"))
def by_ship_date(spark, sf_dir):
    return _role(spark, sf_dir, "l_shipdate")


@query("jn_10_shipping_pairs", "SELECT order_date, order_date + 2 AS shipping_date, count(*) AS order_count FROM stg_orders GROUP BY 1, 2")
def shipping_pairs(spark, sf_dir):
    return star.shipping_pairs(shop(spark, sf_dir).stg_orders)


@query(
    "jn_11_events_in_session",
    "SELECT count(*) AS events, count(*) FILTER (event_timestamp < session_start) AS before_start, count(*) FILTER (event_timestamp > session_end) AS after_end FROM stg_events JOIN stg_sessions USING (session_id)",
    "click",
)
def in_session(spark, sf_dir):
    w = clicks(spark, sf_dir)
    return quality.outside_session(w.stg_events, w.stg_sessions)


@query(
    "jn_12_lineage",
    """
SELECT 'users' AS "table", count(*) AS linked_rows FROM stg_users UNION ALL SELECT 'sessions', count(*) FROM stg_sessions WHERE user_id IN (SELECT user_id FROM stg_users)
UNION ALL SELECT 'events', count(*) FROM stg_events WHERE session_id IN (SELECT session_id FROM stg_sessions)
UNION ALL SELECT 'orders', count(*) FROM stg_orders WHERE session_id IN (SELECT session_id FROM stg_sessions)
UNION ALL SELECT 'order_items', count(*) FROM stg_order_items WHERE order_id IN (SELECT order_id FROM stg_orders)""",
    "click",
)
def lineage(spark, sf_dir):
    w = clicks(spark, sf_dir)
    return star.lineage(w.stg_users, w.stg_sessions, w.stg_events, w.stg_orders, w.stg_order_items)


@query(
    "agg_7_product_sales",
    f"SELECT product_id, n AS total_orders_count, {big('units')} AS total_units_sold, {dbl('revenue')} AS total_revenue_generated, {dbl('profit')} AS total_profit_generated FROM product_sales",
)
def product_sales(spark, sf_dir):
    return dimensions.product_sales(shop(spark, sf_dir).stg_order_items)


@query("agg_8_sessions_per_user", "SELECT user_id, count(*) AS lifetime_sessions FROM stg_sessions GROUP BY 1", "click")
def sessions_per_user(spark, sf_dir):
    return dimensions.sessions_per_user(clicks(spark, sf_dir).stg_sessions)


@query("agg_9_repeated_days", "SELECT user_id, order_date, count(*) AS rows FROM stg_orders GROUP BY 1, 2 HAVING count(*) > 1")
def repeated_days(spark, sf_dir):
    return quality.duplicated_values(shop(spark, sf_dir).stg_orders, "user_id", "order_date")


@query("agg_10_bool_or", "SELECT user_id, bool_or(event_type = 'purchase') AS ever_bought, bool_or(event_type = 'signup') AS ever_signed_up FROM stg_events GROUP BY 1", "click")
def any_true(spark, sf_dir):
    return clicks(spark, sf_dir).stg_events.groupBy("user_id").agg(
        F.bool_or(F.col("event_type") == "purchase").alias("ever_bought"),
        F.bool_or(F.col("event_type") == "signup").alias("ever_signed_up"),
    )


@query(
    "agg_11_mean_gap",
    "SELECT round(avg(avg_days_between_orders), 6) AS mean_gap, count(avg_days_between_orders) AS users_with_gap FROM int_user_order_summary",
)
def mean_gap(spark, sf_dir):
    return shop(spark, sf_dir).int_user_order_summary.agg(
        F.round(F.avg("avg_days_between_orders"), 6).alias("mean_gap"), F.count("avg_days_between_orders").alias("users_with_gap")
    )


_SEQUENCE = "SELECT order_id, user_id, user_order_sequence, prior_order_timestamp FROM numbered_orders"


@query("win_1_order_sequence", _SEQUENCE)
def order_sequence(spark, sf_dir):
    return facts.sequenced_orders(shop(spark, sf_dir).stg_orders).select("order_id", "user_id", "user_order_sequence", "prior_order_timestamp")


@query("win_2_hot_user_sequence", _SEQUENCE)
def hot_sequence(spark, sf_dir):
    """The same with every user treated as hot: each row a part of its own, carried over between parts."""
    numbered = facts.sequenced_orders(shop(spark, sf_dir).stg_orders, hot_rows=0)
    return numbered.select("order_id", "user_id", "user_order_sequence", "prior_order_timestamp")


_RUNNING = f"SELECT order_id, user_id, {dbl('sum(total_amount) OVER (PARTITION BY user_id ORDER BY order_timestamp, order_id ROWS UNBOUNDED PRECEDING)')} AS spent_so_far FROM stg_orders"


def _running(spark, sf_dir, hot_rows):
    orders = shop(spark, sf_dir).stg_orders.select("order_id", "user_id", "order_timestamp", "total_amount")
    rows = sequence_rows(
        orders, "user_id", ["order_timestamp", "order_id"], running={"total_amount": "spent_so_far"}, hot_rows=hot_rows
    )
    return rows.select("order_id", "user_id", "spent_so_far")


@query("win_3_running_sum", _RUNNING)
def running_sum(spark, sf_dir):
    return _running(spark, sf_dir, 1_000_000)


@query("win_3_hot_running_sum", _RUNNING)
def hot_running_sum(spark, sf_dir):
    return _running(spark, sf_dir, 0)


@query(
    "win_5_range_frame",
    f"""
WITH d AS (SELECT order_date, sum(total_amount) AS v FROM stg_orders GROUP BY 1)
SELECT order_date, {dbl("sum(v) OVER (PARTITION BY date_trunc('month', order_date) ORDER BY order_date)")} AS month_to_date FROM d""",
)
def range_frame(spark, sf_dir):
    daily = shop(spark, sf_dir).stg_orders.groupBy("order_date").agg(scalar.sum_exact("total_amount").alias("v"))
    month = Window.partitionBy(F.trunc("order_date", "MM")).orderBy("order_date")
    return daily.select("order_date", F.sum("v").over(month).alias("month_to_date"))


_DWELL = "d AS (SELECT *, lag(event_timestamp) OVER (PARTITION BY session_id ORDER BY step_number, event_timestamp, event_id) AS prior FROM stg_events)"
_SECONDS = "round((epoch_us(event_timestamp) - epoch_us(prior)) / 1000000.0::DOUBLE, 3)"


@query("win_9_dwell_times", f"WITH {_DWELL} SELECT event_id, session_id, prior AS prior_event_timestamp, {_SECONDS} AS seconds_since_prior FROM d", "click")
def dwell(spark, sf_dir):
    return dwell_times(clicks(spark, sf_dir).stg_events).select("event_id", "session_id", "prior_event_timestamp", "seconds_since_prior")


@query(
    "win_9_dwell_summary",
    f"WITH {_DWELL} SELECT count(*) AS transitions, count(*) FILTER (event_timestamp <= prior) AS non_increasing, min({_SECONDS}) AS min_dwell_seconds, max({_SECONDS}) AS max_dwell_seconds FROM d WHERE prior IS NOT NULL",
    "click",
)
def dwell_range(spark, sf_dir):
    return dwell_summary(clicks(spark, sf_dir).stg_events, hot_rows=0)


@query("win_12_global_share", f"WITH c AS (SELECT status, count(*) AS n FROM stg_orders GROUP BY 1) SELECT status, n AS orders, {pct('n', 'sum(n) OVER ()')} AS share_pct FROM c")
def global_share(spark, sf_dir):
    counts = shop(spark, sf_dir).stg_orders.groupBy("status").agg(F.count(F.lit(1)).alias("orders"))
    return counts.withColumn("share_pct", scalar.pct("orders", F.sum("orders").over(Window.partitionBy())))


@query("srt_1_sorted_segments", "SELECT customer_segment, count(*) AS users FROM stg_users GROUP BY 1 ORDER BY users DESC, customer_segment")
def sorted_segments(spark, sf_dir):
    counts = shop(spark, sf_dir).stg_users.groupBy("customer_segment").agg(F.count(F.lit(1)).alias("users"))
    return counts.orderBy(F.desc("users"), "customer_segment")


@query(
    "srt_2_top_stage",
    """
WITH n AS (SELECT sum(reached_view) AS v, sum(reached_click) AS c, sum(reached_signup) AS s, sum(reached_purchase) AS p FROM fct_funnel),
d AS (SELECT unnest(['click', 'signup', 'purchase']) AS stage, unnest([2, 3, 4]) AS step, unnest([greatest(0, v - c), greatest(0, c - s), greatest(0, s - p)]) AS lost FROM n)
SELECT stage AS top_dropoff_stage FROM d ORDER BY lost DESC, step LIMIT 1""",
    "click",
)
def top_stage(spark, sf_dir):
    from merchlens.operators.funnel import evaluate_funnel, top_drop_off

    return top_drop_off(evaluate_funnel(clicks(spark, sf_dir).fct_funnel, CLICK_STAGES))


@query(
    "set_1_tagged_union",
    "SELECT 'users' AS entity, count(*) AS rows FROM stg_users UNION ALL SELECT 'orders', count(*) FROM stg_orders UNION ALL SELECT 'items', count(*) FROM stg_order_items",
)
def tagged_union(spark, sf_dir):
    w = shop(spark, sf_dir)
    parts = [
        w[model].agg(F.count(F.lit(1)).alias("rows")).select(F.lit(tag).alias("entity"), "rows")
        for tag, model in (("users", "stg_users"), ("orders", "stg_orders"), ("items", "stg_order_items"))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "set_2_key_difference",
    """
SELECT session_id, 'left' AS only_in FROM (SELECT session_id FROM stg_events WHERE event_type = 'click' EXCEPT SELECT session_id FROM stg_orders)
UNION ALL SELECT session_id, 'right' FROM (SELECT session_id FROM stg_orders EXCEPT SELECT session_id FROM stg_events WHERE event_type = 'click')""",
    "click",
)
def key_difference(spark, sf_dir):
    w = clicks(spark, sf_dir)
    return quality.key_difference(w.stg_events.where(F.col("event_type") == "click"), w.stg_orders, "session_id")


@query(
    "set_3_keep_last",
    "SELECT user_id, arg_max(event_type, event_id) AS event_type, max(event_id) AS event_id FROM stg_events GROUP BY 1",
    "click",
)
def keep_last(spark, sf_dir):
    """Two batches of the same users stacked, the last row per user kept."""
    events = clicks(spark, sf_dir).stg_events.select("user_id", "event_type", "event_id")
    early, late = events.where(F.col("event_type") == "view"), events.where(F.col("event_type") != "view")
    return incremental.latest_rows(early.unionByName(late), ["user_id"], ["event_id"])


@query(
    "mrt_3_rfm_classes",
    "SELECT frequency_band, monetary_tier, customer_lifecycle_status, count(*) AS users, min(recency_days) AS min_recency, max(recency_days) AS max_recency FROM dim_users GROUP BY 1, 2, 3",
    "click",
)
def rfm_classes(spark, sf_dir):
    return clicks(spark, sf_dir).dim_users.groupBy("frequency_band", "monetary_tier", "customer_lifecycle_status").agg(
        F.count(F.lit(1)).alias("users"), F.min("recency_days").alias("min_recency"), F.max("recency_days").alias("max_recency")
    )


@query(
    "mrt_3_rfm_own_cuts",
    """
SELECT CASE WHEN lifetime_revenue = 0 THEN 'Tier 0: Non-Buyer' WHEN lifetime_revenue < 200000 THEN 'Tier 1: Low Value' WHEN lifetime_revenue < 500000 THEN 'Tier 2: Mid Value'
            WHEN lifetime_revenue < 900000 THEN 'Tier 3: High Value' ELSE 'Tier 4: VIP' END AS monetary_tier, count(*) AS users FROM dim_users GROUP BY 1""",
)
def own_cuts(spark, sf_dir):
    users = shop(spark, sf_dir, monetary_cuts=(200_000, 500_000, 900_000)).dim_users
    return users.groupBy("monetary_tier").agg(F.count(F.lit(1)).alias("users"))


@query(
    "mrt_9_session_flags",
    f"SELECT session_id, user_id, nth AS session_sequence, furthest_step = 1 AS is_bounce, nth > 1 AS is_returning_user, nth = 1 AS is_new_user FROM user_days",
    "click",
)
def flags(spark, sf_dir):
    w = clicks(spark, sf_dir)
    return session_flags(w.stg_sessions, w.stg_events)


@query(
    "mrt_9_flag_agreement",
    "SELECT count(*) AS compared, count(*) FILTER (s.is_bounce IS DISTINCT FROM (d.furthest_step = 1)) AS is_bounce_mismatches, count(*) FILTER (s.is_returning_user IS DISTINCT FROM (d.nth > 1)) AS is_returning_user_mismatches FROM user_days d JOIN stg_sessions s USING (session_id)",
    "click",
)
def flag_agreement(spark, sf_dir):
    w = clicks(spark, sf_dir)
    derived = session_flags(w.stg_sessions, w.stg_events)
    same = {"is_bounce": "is_bounce", "is_returning_user": "is_returning_user"}
    return quality.attribute_mismatches(derived, "session_id", w.stg_sessions, same)


@query(
    "udf_1_portable_helpers",
    f"""
SELECT order_id, CAST(date_trunc('month', order_date) AS DATE) AS month, date_diff('day', DATE '1995-01-01', order_date) AS days, order_timestamp - INTERVAL 3 DAY AS three_days_before,
       {dbl('total_amount')} / nullif({dbl('subtotal')}, 0) AS ratio FROM stg_orders""",
)
def portable(spark, sf_dir):
    from datetime import date

    return shop(spark, sf_dir).stg_orders.select(
        "order_id",
        scalar.month_start("order_date").alias("month"),
        scalar.day_diff(F.lit(date(1995, 1, 1)), "order_date").alias("days"),
        scalar.subtract_days("order_timestamp", 3).alias("three_days_before"),
        scalar.safe_divide("total_amount", "subtotal").alias("ratio"),
    )


@query(
    "udf_2_sql_functions",
    f"SELECT user_id, {dbl('sum(total_amount)')} / nullif(count(*), 0) AS mean_total, bool_or(status = 'pending') AS any_pending, min(strftime(order_date, '%Y-%m')) AS first_month FROM stg_orders GROUP BY 1",
)
def sql_functions(spark, sf_dir):
    """The helpers as temporary SQL functions."""
    scalar.register_sql_functions(spark)
    shop(spark, sf_dir).stg_orders.createOrReplaceTempView("helper_orders")
    return spark.sql(
        "SELECT user_id, safe_divide(CAST(sum(total_amount) AS DOUBLE), CAST(count(*) AS DOUBLE)) AS mean_total, "
        "bool_or(status = 'pending') AS any_pending, min(format_month(order_date)) AS first_month FROM helper_orders GROUP BY user_id"
    )


@query(
    "fn_text_and_dates",
    """
SELECT user_id, concat(customer_segment, ' / ', country) AS label, upper(acquisition_channel) AS channel, strftime(signup_date, '%B') AS month_name, strftime(signup_date, '%a') AS day_short,
       'Q' || quarter(signup_date) AS quarter, week(signup_date) AS week, CAST(signup_date + INTERVAL 1 MONTH AS DATE) AS next_month, customer_segment IN ('BUILDING', 'MACHINERY') AS chosen FROM stg_users""",
)
def text_and_dates(spark, sf_dir):
    day = F.col("signup_date")
    return shop(spark, sf_dir).stg_users.select(
        "user_id",
        F.concat("customer_segment", F.lit(" / "), "country").alias("label"),
        F.upper("acquisition_channel").alias("channel"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "EEE").alias("day_short"),
        F.concat(F.lit("Q"), F.quarter(day)).alias("quarter"),
        F.weekofyear(day).alias("week"),
        F.add_months(day, 1).alias("next_month"),
        F.col("customer_segment").isin("BUILDING", "MACHINERY").alias("chosen"),
    )





def _summary(spark, sf_dir):
    c, s = clicks(spark, sf_dir), shop(spark, sf_dir)
    return reports.statistical_summary(c.fct_funnel, s.fct_user_retention, s.stg_orders, c.fct_ab_test, CLICK_STAGES)


@query("ab_14_master_summary")
def master_summary(spark, sf_dir):
    """Funnel and experiment of the click world, retention of the orders world."""
    return _summary(spark, sf_dir)


@query(
    "ab_14_experiment_part",
    f"WITH a AS ({slices('fct_ab_test', [], _ARMS)}), {_STATS} SELECT n_c AS n_control, n_t AS n_treatment, p_c AS conversion_rate_control, p_t AS conversion_rate_treatment, rel AS relative_lift, lift / se AS z_score FROM t",
    "click",
)
def experiment_part(spark, sf_dir):
    return reports.experiment_summary(clicks(spark, sf_dir).fct_ab_test).select(
        "n_control", "n_treatment", "conversion_rate_control", "conversion_rate_treatment", "relative_lift", "z_score"
    )


_CHOSEN = "n_control, n_treatment, ci_abs_lower, ci_abs_upper, srm_p_value, srm_passed, p_value, statistically_significant"


@query(
    "cfg_1_parameters",
    f"""
WITH a AS ({slices('fct_ab_test', [], _ARMS)}), {_STATS}, {_tails('', 0.55, 0.1, 0.05, '1.6448536269514722::DOUBLE')}
SELECT {_CHOSEN} FROM v""",
    "click",
)
def parameters(spark, sf_dir):
    """Parameters reach the analysis: alpha 0.10, allocation alpha 0.05 and a 55 % control share."""
    from merchlens.operators.experiment import compute_ab_test

    tested = compute_ab_test(clicks(spark, sf_dir).fct_ab_test, [], alpha=0.10, srm_alpha=0.05, share=0.55)
    return tested.select(*_CHOSEN.split(", "))
