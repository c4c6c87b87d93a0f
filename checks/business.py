"""Business measures over both worlds."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import ORDERS_AS_OF, clicks, query, shop
from checks.sqltext import big, dbl, ratio
from merchlens.operators import measures as msr
from merchlens.operators.cubes import number_entities
from merchlens.session import work_dir

CLICK_STAGE_COLUMNS = ("view", "view", "click", "click", "signup", "purchase")
FACTS = ("fct_orders", "fct_funnel", "fct_user_retention", "fct_ab_test", "dim_users", "dim_date")


class Tables(dict):
    """Models by name, built only when a measure needs them."""

    def __init__(self, warehouse):
        super().__init__()
        self.warehouse = warehouse

    def __missing__(self, name):
        return self.warehouse[name]


def evaluate(warehouse, names, by=(), filters=None, as_of=None):
    return msr.measures(Tables(warehouse), names, by, filters, as_of, CLICK_STAGE_COLUMNS)


EXECUTIVE = [
    "Gross Revenue",
    "Net Revenue",
    "Total Orders",
    "Average Order Value (AOV)",
    "Total Units Sold",
    "Average Units Per Order (UPT)",
    "Gross Profit Amount",
    "Gross Margin %",
    "Returning User Order Share %",
]
_DONE = "count(DISTINCT order_id) FILTER (status = 'completed')"
_EXECUTIVE_SQL = f"""
SELECT {{key}} {dbl('sum(subtotal_amount)')} AS gross_revenue, {dbl('sum(total_amount)')} AS net_revenue, {_DONE} AS total_orders,
       coalesce({ratio('sum(subtotal_amount)', _DONE)}, 0) AS average_order_value_aov, {big('sum(total_items_count)')} AS total_units_sold,
       coalesce({ratio('sum(total_items_count)', _DONE)}, 0) AS average_units_per_order_upt,
       {dbl('sum(gross_margin_amount)')} AS gross_profit_amount,
       coalesce({ratio('sum(gross_margin_amount)', 'sum(subtotal_amount)')}, 0) AS gross_margin_pct,
       coalesce({ratio("count(DISTINCT order_id) FILTER (status = 'completed' AND is_repeat_order)", _DONE)}, 0) AS returning_user_order_share_pct
FROM fct_orders {{tail}}"""


@query("msr_01_executive_total", _EXECUTIVE_SQL.format(key="", tail=""))
def executive(spark, sf_dir):
    return evaluate(shop(spark, sf_dir), EXECUTIVE)


@query("msr_01_executive_by_segment", _EXECUTIVE_SQL.format(key="customer_segment,", tail="GROUP BY customer_segment"))
def executive_by_segment(spark, sf_dir):
    return evaluate(shop(spark, sf_dir), EXECUTIVE, ["customer_segment"])


@query(
    "msr_01_executive_filtered",
    _EXECUTIVE_SQL.format(key="device_type,", tail="WHERE customer_segment IN ('BUILDING', 'MACHINERY') GROUP BY device_type"),
)
def executive_filtered(spark, sf_dir):
    return evaluate(shop(spark, sf_dir), EXECUTIVE, ["device_type"], {"customer_segment": ["BUILDING", "MACHINERY"]})


_COUNTED = ["order_id", "user_id", "status", "is_first_order", "is_repeat_order", "subtotal_amount", "total_amount", "total_items_count", "gross_margin_amount"]
_SLICES = ["order_month", "customer_segment", "device_type"]


def _orders_by_month(spark, sf_dir):
    """Written once: numbering and cubes of all batches read it instead of building the fact each time."""
    orders = shop(spark, sf_dir).fct_orders.withColumn("order_month", F.trunc("order_date", "MM"))
    path = work_dir(spark, "orders-by-month")
    orders.select(*_SLICES, "order_date", *_COUNTED).write.parquet(path)
    return spark.read.parquet(path)


def _order_cube(spark, sf_dir):
    orders = _orders_by_month(spark, sf_dir)
    numbers = number_entities(orders, "order_id", _SLICES)
    return msr.measure_cube(orders, "fct_orders", EXECUTIVE, _SLICES, numbers)


@query("msr_02_cube_by_segment", _EXECUTIVE_SQL.format(key="customer_segment,", tail="GROUP BY customer_segment"))
def cube_by_segment(spark, sf_dir):
    """All segments from the cube of months, segments and devices."""
    return msr.measures({"fct_orders": _order_cube(spark, sf_dir)}, EXECUTIVE, ["customer_segment"])


@query(
    "msr_02_cube_filtered",
    _EXECUTIVE_SQL.format(
        key="device_type,",
        tail="WHERE customer_segment IN ('BUILDING', 'MACHINERY') AND order_date >= DATE '1996-03-01' GROUP BY device_type",
    ),
)
def cube_filtered(spark, sf_dir):
    """A range of months and a filter, answered without the fact."""
    cube = _order_cube(spark, sf_dir).where(F.col("order_month") >= F.lit("1996-03-01").cast("date"))
    return msr.measures({"fct_orders": cube}, EXECUTIVE, ["device_type"], {"customer_segment": ["BUILDING", "MACHINERY"]})


@query(
    "msr_07_cube_of_batches",
    _EXECUTIVE_SQL.format(key="customer_segment,", tail="GROUP BY customer_segment"),
)
def cube_of_batches(spark, sf_dir):
    """Three batches that share months; the second one's numbers continue the first one's, and so on."""
    orders, numbers, cube = _orders_by_month(spark, sf_dir), None, None
    for i in range(3):
        batch = orders.where(F.pmod(F.dayofmonth("order_date"), F.lit(3)) == i)
        numbers = number_entities(batch, "order_id", _SLICES, numbers)
        part = msr.measure_cube(batch, "fct_orders", EXECUTIVE, _SLICES, numbers)
        cube = part if cube is None else cube.merged(part)
    return msr.measures({"fct_orders": cube.compacted()}, EXECUTIVE, ["customer_segment"])


@query(
    "msr_04_sessions_and_users",
    f"""
WITH f AS (SELECT customer_segment, count(*) AS n, count(DISTINCT user_id) AS u FROM fct_funnel GROUP BY 1),
o AS (SELECT customer_segment, {_DONE} AS n FROM fct_orders GROUP BY 1),
d AS (SELECT customer_segment, count(*) FILTER (lifetime_orders > 1) AS n FROM dim_users GROUP BY 1)
SELECT d.customer_segment, coalesce(f.n, 0) AS total_sessions, coalesce(u, 0) AS total_unique_users,
       coalesce({ratio('o.n', 'f.n')}, 0) AS overall_conversion_rate_pct, d.n AS returning_users_count
FROM d LEFT JOIN f USING (customer_segment) LEFT JOIN o USING (customer_segment)""",
    "click",
)
def sessions_and_users(spark, sf_dir):
    names = ["Total Sessions", "Total Unique Users", "Overall Conversion Rate %", "Returning Users Count"]
    return evaluate(clicks(spark, sf_dir), names, ["customer_segment"])


@query(
    "msr_04_cube_users",
    f"""
SELECT device_type, {big('count(*)')} AS total_sessions, count(DISTINCT user_id) AS total_unique_users
FROM fct_funnel GROUP BY 1""",
    "click",
)
def cube_users(spark, sf_dir):
    """A user who comes on many days counts once."""
    sessions, slices = clicks(spark, sf_dir).fct_funnel, ["session_month", "device_type", "customer_segment"]
    sessions = sessions.withColumn("session_month", F.trunc("session_date", "MM"))
    names = ["Total Sessions", "Total Unique Users"]
    numbers = number_entities(sessions, "user_id", slices)
    cube = msr.measure_cube(sessions, "fct_funnel", names, slices, numbers, CLICK_STAGE_COLUMNS)
    return msr.measures({"fct_funnel": cube}, names, ["device_type"])


@query(
    "msr_05_monthly_growth",
    f"""
WITH m AS (SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, sum(subtotal_amount) AS r FROM fct_orders GROUP BY 1)
SELECT a.month, {dbl('a.r')} AS gross_revenue, {ratio('a.r - p.r', 'p.r')} AS mom_revenue_growth_pct, {ratio('a.r - y.r', 'y.r')} AS yoy_revenue_growth_pct
FROM m a LEFT JOIN m p ON p.month = a.month - INTERVAL 1 MONTH LEFT JOIN m y ON y.month = a.month - INTERVAL 1 YEAR""",
)
def monthly_growth(spark, sf_dir):
    return msr.monthly_growth(shop(spark, sf_dir).fct_orders)


_MEAN = "CAST(sum(r) OVER {w} AS DOUBLE) / count(*) OVER {w}"


def _trend_sql(key: str) -> str:
    part = f"PARTITION BY {key}" if key else ""
    comma = f"{key}," if key else ""
    keys = f"CROSS JOIN (SELECT DISTINCT {key} FROM fct_orders)" if key else ""
    match = f"AND d.{key} = s.{key}" if key else ""
    return f"""
WITH d AS (SELECT {comma} order_date, sum(subtotal_amount) AS r FROM fct_orders GROUP BY ALL),
s AS (SELECT * FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS order_date
                     FROM (SELECT min(order_date) AS lo, max(order_date) AS hi FROM fct_orders)) {keys}),
f AS (SELECT s.*, coalesce(d.r, 0) AS r FROM s LEFT JOIN d ON d.order_date = s.order_date {match})
SELECT {comma} order_date, {dbl('r')} AS gross_revenue, {_MEAN.format(w='a')} AS revenue_7_day_moving_avg, {_MEAN.format(w='b')} AS revenue_30_day_moving_avg
FROM f WINDOW a AS ({part} ORDER BY order_date ROWS 6 PRECEDING), b AS ({part} ORDER BY order_date ROWS 29 PRECEDING)"""


@query("msr_06_daily_trend", _trend_sql(""))
def daily_trend(spark, sf_dir):
    return msr.daily_trend(shop(spark, sf_dir).fct_orders)


@query("msr_06_daily_trend_by_segment", _trend_sql("customer_segment"))
def daily_trend_by_segment(spark, sf_dir):
    return msr.daily_trend(shop(spark, sf_dir).fct_orders, by=["customer_segment"])


_STAGE = [f"Stage {i} {n} Sessions" for i, n in enumerate(msr.STAGE_NAMES, 1)]
_RATES = ["Overall Funnel Conversion Rate %"] + [f"Stage {i} to {i + 1} Conversion Rate %" for i in range(1, 6)]
_DROPS = [f"Drop-off {d}" for d in msr.DROP_OFFS]
_S = dict(zip(range(1, 7), ("v", "v", "c", "c", "s", "p")))


@query(
    "msr_08_funnel_measures",
    f"""
WITH t AS (SELECT device_type, sum(reached_view) AS v, sum(reached_click) AS c, sum(reached_signup) AS s, sum(reached_purchase) AS p FROM fct_funnel GROUP BY 1)
SELECT device_type, {', '.join(f'{big(_S[i])} AS {msr.slug(n)}' for i, n in enumerate(_STAGE, 1))},
       coalesce({ratio('p', 'v')}, 0) AS overall_funnel_conversion_rate_pct,
       {', '.join(f'coalesce({ratio(_S[i + 1], _S[i])}, 0) AS stage_{i}_to_{i + 1}_conversion_rate_pct' for i in range(1, 6))},
       {', '.join(f'{big(f"{_S[i]} - {_S[i + 1]}")} AS {msr.slug(d)}' for i, d in enumerate(_DROPS, 1))}
FROM t""",
    "click",
)
def funnel_measures(spark, sf_dir):
    return evaluate(clicks(spark, sf_dir), _STAGE + _RATES + _DROPS, ["device_type"])


_KEPT = [f"M{k} Retained Users" for k in range(7)]
_KEPT_RATES = [f"M{k} Retention Rate %" for k in range(1, 7)]
_M = {k: f"count(DISTINCT user_id) FILTER (month_offset {'>=' if k == 6 else '='} {k})" for k in range(7)}


_RETENTION_SQL = f"""
WITH r AS (SELECT customer_segment, {', '.join(f'{_M[k]} AS u{k}' for k in range(7))}, sum(cumulative_revenue) AS cum FROM fct_user_retention GROUP BY 1),
d AS (SELECT customer_segment, count(*) AS n, count(*) FILTER (lifetime_orders > 1) AS again FROM dim_users GROUP BY 1)
SELECT customer_segment, u0 AS cohort_size_m0_users, {', '.join(f'u{k} AS m{k}_retained_users' for k in range(7))},
       {', '.join(f'coalesce({ratio(f"u{k}", "u0")}, 0) AS m{k}_retention_rate_pct' for k in range(1, 7))},
       coalesce({ratio('again', 'n')}, 0) AS repeat_purchase_rate_pct, coalesce({ratio('cum', 'u0')}, 0) AS cohort_cumulative_ltv_per_user
FROM r JOIN d USING (customer_segment)"""


@query(
    "msr_11_retention_measures",
    _RETENTION_SQL,
)
def retention_measures(spark, sf_dir):
    names = ["Cohort Size (M0 Users)", *_KEPT, *_KEPT_RATES, "Repeat Purchase Rate %", "Cohort Cumulative LTV per User"]
    return evaluate(shop(spark, sf_dir), names, ["customer_segment"], as_of=ORDERS_AS_OF)


_EXPERIMENT = [n for n in msr.measure_names() if n.startswith("AB ")]
_EXPERIMENT_SQL = """
WITH a AS (SELECT {key} count(*) FILTER (ab_variant = 'control') AS n1, count(*) FILTER (ab_variant = 'treatment') AS n2,
    count(*) FILTER (ab_variant = 'control' AND completed_purchase = 1) AS x1, count(*) FILTER (ab_variant = 'treatment' AND completed_purchase = 1) AS x2 FROM fct_ab_test {tail}),
b AS (SELECT *, coalesce(CAST(x1 AS DOUBLE) / nullif(n1, 0), 0) AS p1, coalesce(CAST(x2 AS DOUBLE) / nullif(n2, 0), 0) AS p2,
             coalesce(CAST(x1 + x2 AS DOUBLE) / nullif(n1 + n2, 0), 0) AS p, CAST(n1 + n2 AS DOUBLE) / 2 AS half FROM a),
c AS (SELECT *, (p2 - p1) / nullif(p1, 0) AS rel, CASE WHEN n1 > 0 AND n2 > 0 AND p > 0 AND p < 1
             THEN sqrt(p * (1 - p) * (1 / CAST(n1 AS DOUBLE) + 1 / CAST(n2 AS DOUBLE))) ELSE 0 END AS se,
             (n1 - half) * (n1 - half) / nullif(half, 0) + (n2 - half) * (n2 - half) / nullif(half, 0) AS chi FROM b),
d AS (SELECT *, coalesce((p2 - p1) / nullif(se, 0), 0) AS z FROM c)
SELECT {key} n1 AS ab_control_sessions, n2 AS ab_treatment_sessions, n1 + n2 AS ab_total_experiment_sessions, x1 AS ab_control_purchases,
       x2 AS ab_treatment_purchases, p1 AS ab_control_conversion_rate_pct, p2 AS ab_treatment_conversion_rate_pct, p2 - p1 AS ab_absolute_uplift,
       rel AS ab_relative_uplift_pct, p AS ab_pooled_proportion, se AS ab_pooled_standard_error, z AS ab_z_score,
       CASE WHEN z = 0 THEN 1 ELSE 2 * (1 - 1 / (1 + exp(-0.07056::DOUBLE * pow(abs(z), 3) - 1.5976::DOUBLE * abs(z)))) END AS ab_two_sided_p_value_approx,
       CASE WHEN abs(z) >= 1.96 THEN 'Statistically Significant (p < 0.05)' ELSE 'Inconclusive (p >= 0.05)' END AS ab_statistically_significant_flag,
       half AS ab_srm_expected_sessions, chi AS ab_srm_chi_square_statistic,
       CASE WHEN chi IS NULL THEN 'Unknown' WHEN chi > 6.635 THEN 'SRM FAILED - BIASED (p < 0.01)' ELSE 'SRM PASSED - BALANCED' END AS ab_srm_status,
       rel - 1.96::DOUBLE * coalesce(se / nullif(p1, 0), 0) AS ab_95_pct_ci_lower_bound, rel + 1.96::DOUBLE * coalesce(se / nullif(p1, 0), 0) AS ab_95_pct_ci_upper_bound
FROM d"""


@query("msr_11_cube_retention", _RETENTION_SQL)
def cube_retention(spark, sf_dir):
    """The same from a cube of cohort months and segments; users are counted once over the cohorts."""
    warehouse, slices = shop(spark, sf_dir), ["cohort_month", "customer_segment"]
    tables, rows = Tables(warehouse), warehouse.fct_user_retention
    names = ["Cohort Size (M0 Users)", *_KEPT, *_KEPT_RATES, "Repeat Purchase Rate %", "Cohort Cumulative LTV per User"]
    numbers = number_entities(rows, "user_id", slices)
    tables["fct_user_retention"] = msr.measure_cube(rows, "fct_user_retention", names, slices, numbers)
    return msr.measures(tables, names, ["customer_segment"], as_of=ORDERS_AS_OF)


@query("msr_14_experiment_measures", _EXPERIMENT_SQL.format(key="", tail=""), "click")
def experiment_measures(spark, sf_dir):
    return evaluate(clicks(spark, sf_dir), _EXPERIMENT)


@query("msr_15_experiment_by_device", _EXPERIMENT_SQL.format(key="device_type,", tail="GROUP BY device_type"), "click")
def experiment_by_device(spark, sf_dir):
    return evaluate(clicks(spark, sf_dir), _EXPERIMENT, ["device_type"])


@query(
    "msr_18_helpers",
    """
WITH d AS (SELECT min(date_day) AS lo, max(date_day) AS hi FROM dim_date),
r AS (SELECT CAST(sum(subtotal_amount) AS DOUBLE) AS v FROM fct_orders WHERE customer_segment = 'BUILDING')
SELECT 1.95996::DOUBLE AS standard_normal_inverse_approx, 6.6349::DOUBLE AS chi_square_critical_value_99_pct, hi AS max_observed_date,
       TRUE AS has_filter_applied, 'Period: ' || lo || ' to ' || hi AS card_subtitle_date_range, 1::DOUBLE AS divide_safe_helper,
       'Valid Date' AS blank_guard_helper, 'Customer Segment: BUILDING' AS segment_filter_slicer_title, '$' || format('{:,.2f}', v) AS currency_formatter
FROM d, r""",
)
def helpers(spark, sf_dir):
    names = [
        "Standard Normal Inverse Approx",
        "Chi-Square Critical Value 99%",
        "Max Observed Date",
        "Has Filter Applied",
        "Card Subtitle Date Range",
        "Divide Safe Helper",
        "Blank Guard Helper",
        "Segment Filter Slicer Title",
        "Currency Formatter",
    ]
    return evaluate(shop(spark, sf_dir), names, filters={"customer_segment": "BUILDING"})


@query(
    "msr_20_status_color",
    """
WITH a AS (SELECT device_type, count(*) FILTER (ab_variant = 'control') AS n1, count(*) FILTER (ab_variant = 'treatment') AS n2 FROM fct_ab_test GROUP BY 1),
h AS (SELECT *, (n1 + n2) / 2.0 AS half FROM a)
SELECT device_type, CASE WHEN (n1 - half) ** 2 / half + (n2 - half) ** 2 / half > 6.635 THEN '#F43F5E' ELSE '#10B981' END AS wcag_formatted_status_color FROM h""",
    "click",
)
def status_color(spark, sf_dir):
    return evaluate(clicks(spark, sf_dir), ["WCAG Formatted Status Color"], ["device_type"])


@query(
    "msr_21_report_state",
    f"""SELECT count(*) AS total_sessions, FALSE AS has_filter_applied, 'Customer Segment: All Segments' AS segment_filter_slicer_title FROM fct_funnel""",
    "click",
)
def report_state(spark, sf_dir):
    return evaluate(clicks(spark, sf_dir), ["Total Sessions", "Has Filter Applied", "Segment Filter Slicer Title"])


@query(
    "msr_22_revenue_by_category",
    f"SELECT primary_product_category, {dbl('sum(subtotal_amount)')} AS gross_revenue FROM fct_orders GROUP BY 1",
)
def revenue_by_category(spark, sf_dir):
    return evaluate(shop(spark, sf_dir), ["Gross Revenue"], ["primary_product_category"])


@query(
    "msr_22_order_share",
    f"""
WITH o AS (SELECT customer_segment, {_DONE} AS n FROM fct_orders GROUP BY 1)
SELECT customer_segment, n AS total_orders, {ratio('n', 'sum(n) OVER ()')} AS order_share FROM o""",
)
def order_share(spark, sf_dir):
    return msr.order_share(shop(spark, sf_dir).fct_orders)
