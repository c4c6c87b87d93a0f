"""Retention, repeat purchase and lifetime value over the orders world."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query, shop
from checks.sqltext import big, dbl, mean_money, pct
from merchlens.operators import retention

_ACTIVE = """
active AS (SELECT cohort_month, month_offset, count(DISTINCT user_id) AS users, sum(orders_in_month) AS orders,
                  sum(revenue_in_month) AS revenue FROM fct_user_retention GROUP BY 1, 2),
size AS (SELECT cohort_month, users AS base FROM active WHERE month_offset = 0)"""
_WIDE = ", ".join(f"max(rate) FILTER (month_offset = {k}) AS m{k}_retention_pct" for k in range(7))
_MATRIX = f"""
WITH {_ACTIVE}, rates AS (SELECT a.*, base, {pct('users', 'base')} AS rate FROM active a JOIN size s USING (cohort_month)),
plus AS (SELECT cohort_month, count(DISTINCT user_id) FILTER (month_offset >= 6) AS later FROM fct_user_retention GROUP BY 1)
SELECT cohort_month, base AS cohort_initial_users, {{wide}}, round(avg(rate) FILTER (month_offset = 1), 2) AS avg_m1_retention,
       any_value({pct('later', 'base')}) AS m6_plus_retention_pct
FROM rates JOIN plus USING (cohort_month) GROUP BY cohort_month, base"""


@query("ret_1_matrix", _MATRIX.format(wide=_WIDE))
def matrix(spark, sf_dir):
    return retention.retention_matrix(shop(spark, sf_dir).fct_user_retention).orderBy("cohort_month")


@query(
    "ret_1_matrix_filled",
    _MATRIX.format(
        wide=", ".join(f"coalesce(max(rate) FILTER (month_offset = {k}), 0) AS m{k}_retention_pct" for k in range(7))
    ),
)
def matrix_filled(spark, sf_dir):
    return retention.retention_matrix(shop(spark, sf_dir).fct_user_retention, fill=0.0)


@query(
    "ret_1_rates",
    f"""
WITH {_ACTIVE}
SELECT cohort_month, base AS cohort_initial_users, {big('month_offset')} AS month_offset, users AS active_users,
       {pct('users', 'base')} AS retention_rate_pct, {big('orders')} AS total_orders, {dbl('revenue')} AS total_revenue,
       {mean_money('revenue', 'base')} AS ltv_per_cohort_user
FROM active JOIN size USING (cohort_month)""",
)
def rates(spark, sf_dir):
    return retention.retention_rates(shop(spark, sf_dir).fct_user_retention)


@query(
    "ret_1_late_months",
    f"""
SELECT cohort_month, {big('count(DISTINCT user_id) FILTER (month_offset = 0)')} AS cohort_initial_users,
       {big('count(DISTINCT user_id) FILTER (month_offset = 6)')} AS m6_users,
       {big('count(DISTINCT user_id) FILTER (month_offset >= 6)')} AS m6_plus_users
FROM fct_user_retention GROUP BY cohort_month""",
)
def late(spark, sf_dir):
    return retention.late_retention(shop(spark, sf_dir).fct_user_retention)


_TWO = "count(*) FILTER (lifetime_orders >= 2)"


@query(
    "ret_2_repeat_summary",
    f"""
SELECT count(*) AS total_purchasing_customers, {_TWO} AS repeat_customers, count(*) FILTER (lifetime_orders = 1) AS one_time_buyers,
       {pct(_TWO, 'count(*)')} AS repeat_purchase_rate_pct, {mean_money('sum(lifetime_revenue)', 'count(*)')} AS overall_customer_aov,
       {mean_money('sum(lifetime_revenue) FILTER (lifetime_orders >= 2)', _TWO)} AS repeat_customer_arpu
FROM dim_users WHERE lifetime_orders > 0""",
)
def repeat_summary(spark, sf_dir):
    return retention.repeat_summary(shop(spark, sf_dir).dim_users)


@query(
    "ret_3_repeat_by_segment",
    f"""
SELECT customer_segment, count(*) AS total_customers, {_TWO} AS repeat_customers, {pct(_TWO, 'count(*)')} AS repeat_purchase_rate_pct,
       {mean_money('sum(lifetime_orders)', 'count(*)')} AS avg_orders_per_customer,
       {mean_money('sum(lifetime_revenue)', 'count(*)')} AS avg_lifetime_revenue
FROM dim_users WHERE lifetime_orders > 0 GROUP BY 1""",
)
def repeat_by_segment(spark, sf_dir):
    return retention.repeat_by_segment(shop(spark, sf_dir).dim_users).orderBy(F.desc("avg_lifetime_revenue"))


@query(
    "ret_4_repeat_by_channel",
    f"""
SELECT acquisition_channel, count(*) AS total_customers, {_TWO} AS repeat_customers, {pct(_TWO, 'count(*)')} AS repeat_purchase_rate_pct,
       {mean_money('sum(lifetime_revenue)', 'count(*)')} AS avg_ltv, {dbl('round(sum(lifetime_revenue), 2)')} AS channel_total_revenue
FROM dim_users WHERE lifetime_orders > 0 GROUP BY 1""",
)
def repeat_by_channel(spark, sf_dir):
    return retention.repeat_by_channel(shop(spark, sf_dir).dim_users).orderBy(F.desc("channel_total_revenue"))


@query(
    "ret_5_cohort_ltv",
    f"""
WITH {_ACTIVE}, run AS (SELECT *, sum(revenue) OVER (PARTITION BY cohort_month ORDER BY month_offset ROWS UNBOUNDED PRECEDING) AS total
                        FROM active JOIN size USING (cohort_month))
SELECT cohort_month, base AS cohort_size, {big('month_offset')} AS month_offset, {dbl('revenue')} AS month_revenue,
       {dbl('total')} AS cumulative_cohort_revenue, {mean_money('total', 'base')} AS cumulative_ltv_per_user FROM run""",
)
def cohort_ltv(spark, sf_dir):
    return retention.cohort_ltv(shop(spark, sf_dir).fct_user_retention)


_PY_RATES = f"""
f AS (SELECT user_id, strftime(cohort_month, '%Y-%m') AS cohort_month, month_offset, revenue_in_month AS revenue, customer_segment FROM fct_user_retention),
rates AS (SELECT cohort_month, month_offset, users AS active_users, base, revenue, {pct('users', 'base')} AS rate
          FROM (SELECT cohort_month, month_offset, count(DISTINCT user_id) AS users, sum(revenue) AS revenue FROM f GROUP BY 1, 2)
          JOIN (SELECT cohort_month, coalesce(nullif(count(DISTINCT user_id) FILTER (month_offset = 0), 0), count(DISTINCT user_id)) AS base
                FROM f GROUP BY 1) USING (cohort_month))"""


@query(
    "ret_6_cohort_retention",
    f"""
WITH {_PY_RATES}
SELECT cohort_month, {big('month_offset')} AS month_offset, active_users, base AS initial_cohort_size, rate AS retention_rate,
       {dbl('revenue')} AS total_revenue FROM rates""",
)
def cohort_retention(spark, sf_dir):
    return retention.compute_cohort_retention(shop(spark, sf_dir).fct_user_retention)


_GRID = f"""{_PY_RATES},
grid AS (SELECT c.cohort_month, o.month_offset, coalesce(r.rate, 0) AS rate
         FROM (SELECT DISTINCT cohort_month FROM rates) c CROSS JOIN (SELECT DISTINCT month_offset FROM rates) o
         LEFT JOIN rates r ON r.cohort_month = c.cohort_month AND r.month_offset = o.month_offset),
step AS (SELECT *, lag(rate) OVER (PARTITION BY cohort_month ORDER BY month_offset) AS prior FROM grid),
broken AS (SELECT *, 'month_0_not_100' AS rule FROM step WHERE month_offset = 0 AND abs(rate - 100) > 0.01
           UNION ALL SELECT *, 'above_100' FROM step WHERE month_offset > 0 AND rate > 100
           UNION ALL SELECT *, 'rise' FROM step WHERE rate > prior + 0.01)"""


@query(
    "ret_7_violations",
    f"WITH {_GRID} SELECT cohort_month, {big('month_offset')} AS month_offset, rate AS retention_rate, prior AS prior_rate, rule FROM broken",
)
def violations(spark, sf_dir):
    return retention.retention_violations(retention.compute_cohort_retention(shop(spark, sf_dir).fct_user_retention))


@query(
    "ret_7_invariants",
    f"""
WITH {_GRID}
SELECT (SELECT count(*) = 0 FROM broken WHERE rule = 'month_0_not_100') AS month_0_is_100_percent,
       (SELECT count(*) = 0 FROM broken WHERE rule = 'above_100') AS decay_monotonic_vs_m0,
       (SELECT count(*) = 0 FROM broken WHERE rule = 'rise') AS all_decay_monotonic,
       (SELECT count(DISTINCT cohort_month) FROM rates) AS cohort_count""",
)
def invariants(spark, sf_dir):
    return retention.retention_invariants(retention.compute_cohort_retention(shop(spark, sf_dir).fct_user_retention))


def _repeat_sql(dimensions: list[str]) -> str:
    parts = []
    for d in [None, *dimensions]:
        value = f"CAST({d} AS VARCHAR)" if d else "'overall'"
        parts.append(
            f"SELECT '{d or 'overall'}' AS dimension, v AS value, count(*) AS total_users, count(*) FILTER (n >= 2) AS repeat_users "
            f"FROM (SELECT user_id, {value} AS v, count(DISTINCT order_id) AS n FROM done GROUP BY ALL) "
            f"WHERE v IS NOT NULL GROUP BY v"
        )
    union = "\nUNION ALL\n".join(parts)
    return f"WITH done AS (SELECT * FROM fct_orders WHERE status = 'completed'), r AS ({union})\nSELECT *, {pct('repeat_users', 'total_users')} AS repeat_purchase_rate FROM r"


@query("ret_8_repeat_purchase_rate", _repeat_sql(["customer_segment", "country"]))
def repeat_rate(spark, sf_dir):
    return retention.repeat_purchase_rate(shop(spark, sf_dir).fct_orders, ["customer_segment", "country"])


@query(
    "ret_9_ltv_curves",
    f"""
WITH {_PY_RATES},
a AS (SELECT customer_segment, cohort_month, month_offset, count(DISTINCT user_id) AS users, sum(revenue) AS revenue FROM f GROUP BY 1, 2, 3),
b AS (SELECT customer_segment, cohort_month,
             greatest(1, coalesce(nullif(count(DISTINCT user_id) FILTER (month_offset = 0), 0), count(DISTINCT user_id))) AS base FROM f GROUP BY 1, 2),
c AS (SELECT *, sum(revenue) OVER (PARTITION BY customer_segment, cohort_month ORDER BY month_offset ROWS UNBOUNDED PRECEDING) AS total
      FROM a JOIN b USING (customer_segment, cohort_month))
SELECT customer_segment, cohort_month, {big('month_offset')} AS month_offset, users AS active_users, {dbl('revenue')} AS revenue,
       {big('base')} AS cohort_initial_size, {dbl('total')} AS cumulative_revenue, {mean_money('total', 'base')} AS cumulative_ltv FROM c""",
)
def ltv_curves(spark, sf_dir):
    return retention.ltv_curves(shop(spark, sf_dir).fct_user_retention)


_FIRST = """
first AS (SELECT user_id, CAST(date_trunc('month', min(order_timestamp)) AS DATE) AS cohort_month FROM stg_orders GROUP BY user_id),
act AS (SELECT f.cohort_month, o.user_id, o.total_amount,
               date_diff('month', f.cohort_month, CAST(date_trunc('month', o.order_timestamp) AS DATE)) AS month_offset
        FROM stg_orders o JOIN first f ON f.user_id = o.user_id)"""


@query(
    "ret_10_first_order_cohorts",
    f"""
WITH {_FIRST}, m AS (SELECT cohort_month, month_offset, count(DISTINCT user_id) AS n, sum(total_amount) AS revenue FROM act GROUP BY 1, 2),
s AS (SELECT cohort_month, count(*) AS base FROM first GROUP BY 1),
r AS (SELECT *, sum(revenue) OVER (PARTITION BY cohort_month ORDER BY month_offset) AS total FROM m JOIN s USING (cohort_month))
SELECT cohort_month, {big('month_offset')} AS month_offset, n AS active_users, base AS initial_users, {pct('n', 'base')} AS retention_rate,
       {dbl('total')} AS cumulative_revenue, {mean_money('total', 'base')} AS cumulative_ltv_per_user FROM r""",
)
def first_order_cohorts(spark, sf_dir):
    return retention.first_order_cohorts(shop(spark, sf_dir).stg_orders)


@query(
    "ret_10_segment_ltv",
    f"""
WITH {_FIRST}
SELECT act.cohort_month, customer_segment, {big('month_offset')} AS month_offset, count(DISTINCT act.user_id) AS active_users,
       {dbl('sum(total_amount)')} AS revenue, {mean_money('sum(total_amount)', 'count(DISTINCT act.user_id)')} AS ltv_per_acquired_user
FROM act JOIN stg_users u ON u.user_id = act.user_id GROUP BY 1, 2, 3""",
)
def segment_ltv(spark, sf_dir):
    w = shop(spark, sf_dir)
    return retention.segment_ltv(w.stg_orders, w.stg_users)


@query(
    "ret_11_cohort_definition_gap",
    f"""
WITH {_FIRST}
SELECT count(*) AS ordering_users, count(*) FILTER (u.cohort_month <> f.cohort_month) AS different_month
FROM first f JOIN stg_users u ON u.user_id = f.user_id""",
)
def definition_gap(spark, sf_dir):
    w = shop(spark, sf_dir)
    return retention.cohort_definition_gap(w.stg_users, w.stg_orders)


@query(
    "ret_12_order_frequency",
    """
SELECT CASE WHEN lifetime_orders >= 5 THEN '5+' ELSE CAST(lifetime_orders AS VARCHAR) END AS order_frequency, count(*) AS users
FROM dim_users WHERE lifetime_orders > 0 GROUP BY 1""",
)
def order_frequency(spark, sf_dir):
    return retention.order_frequency(shop(spark, sf_dir).dim_users)


@query(
    "ret_13_revenue_layers",
    f"""
SELECT strftime(activity_month, '%Y-%m') AS year_month, cohort_month, {dbl('sum(monthly_revenue)')} AS monthly_revenue
FROM fct_user_retention GROUP BY 1, 2""",
)
def revenue_layers(spark, sf_dir):
    return retention.revenue_layers(shop(spark, sf_dir).fct_user_retention)


@query(
    "agg_13_pivot",
    f"""
WITH {_ACTIVE}
SELECT cohort_month, {', '.join(f'max(users) FILTER (month_offset = {k}) AS m{k}' for k in range(7))} FROM active GROUP BY 1""",
)
def pivot(spark, sf_dir):
    active = retention.cohort_activity(shop(spark, sf_dir).fct_user_retention)
    wide = active.groupBy("cohort_month").pivot("month_offset", list(range(7))).agg(F.max("active_users"))
    return wide.select("cohort_month", *[F.col(str(k)).alias(f"m{k}") for k in range(7)])


@query(
    "udf_4_retention_report",
    f"""
WITH {_GRID}, per AS (SELECT user_id, count(DISTINCT order_id) AS n FROM stg_orders WHERE status = 'completed' GROUP BY 1)
SELECT (SELECT count(*) = 0 FROM broken WHERE rule = 'month_0_not_100') AS month_0_is_100_percent,
       (SELECT count(*) = 0 FROM broken WHERE rule = 'above_100') AS decay_monotonic_vs_m0,
       (SELECT count(*) = 0 FROM broken WHERE rule = 'rise') AS all_decay_monotonic,
       (SELECT count(DISTINCT cohort_month) FROM rates) AS cohort_count,
       (SELECT count(*) FROM per) AS total_purchasing_users, (SELECT count(*) FROM per WHERE n >= 2) AS repeat_purchasing_users,
       (SELECT {pct('count(*) FILTER (n >= 2)', 'count(*)')} FROM per) AS repeat_purchase_rate""",
)
def report(spark, sf_dir):
    w = shop(spark, sf_dir)
    return retention.retention_report(w.fct_user_retention, w.stg_orders)
