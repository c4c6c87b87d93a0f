"""Experiment queries: click-world fact, and the orders world as a second experiment."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import clicks, query, shop
from checks.sqltext import big, dbl, erfc, pct, ratio, slices
from merchlens.operators import experiment
from merchlens.operators.orders import completed

_ARMS = """SELECT {dim} AS dimension, {val} AS value, count(*) FILTER (ab_variant = 'control') AS n_c,
       count(*) FILTER (ab_variant = 'control' AND completed_purchase = 1) AS x_c,
       count(*) FILTER (ab_variant = 'treatment') AS n_t,
       count(*) FILTER (ab_variant = 'treatment' AND completed_purchase = 1) AS x_t
FROM {src} GROUP BY ALL"""
_ONE = slices("fct_ab_test", [], _ARMS)


@query(
    "ab_1_variant_summary",
    f"""
WITH s AS (SELECT ab_variant, count(DISTINCT session_id) AS n, count(DISTINCT session_id) FILTER (completed_purchase = 1) AS x
           FROM fct_ab_test GROUP BY 1)
SELECT ab_variant, n AS sample_size, x AS conversions, round({ratio('x', 'n')}, 6) AS conversion_rate,
       round(round({ratio('x', 'n')}, 6) * 100, 2) AS conversion_rate_pct FROM s""",
    "click",
)
def variant_summary(spark, sf_dir):
    return experiment.variant_summary(clicks(spark, sf_dir).fct_ab_test).orderBy("ab_variant")


_CHI = "(n_c - (n_c + n_t) / 2.0) ** 2 / nullif((n_c + n_t) / 2.0, 0) + (n_t - (n_c + n_t) / 2.0) ** 2 / nullif((n_c + n_t) / 2.0, 0)"


@query(
    "ab_2_srm",
    f"""
WITH a AS ({_ONE}), c AS (SELECT *, round(CAST({_CHI} AS DOUBLE), 4) AS chi FROM a)
SELECT n_c AS n_control, n_t AS n_treatment, n_c + n_t AS n_total, chi AS chi2_statistic,
       CASE WHEN chi < 6.635 THEN 'PASS: No SRM Detected (Allocation Balanced)'
            ELSE 'FAIL: Sample Ratio Mismatch Detected (Invalid Experiment)' END AS srm_verdict FROM c""",
    "click",
)
def srm(spark, sf_dir):
    return experiment.srm_check(clicks(spark, sf_dir).fct_ab_test)


_STATS = """
r AS (SELECT *, CAST(x_c AS DOUBLE) / nullif(n_c, 0) AS p_c, CAST(x_t AS DOUBLE) / nullif(n_t, 0) AS p_t,
             CAST(x_c + x_t AS DOUBLE) / nullif(n_c + n_t, 0) AS p FROM a),
t AS (SELECT *, p_t - p_c AS lift, (p_t - p_c) / nullif(p_c, 0) AS rel,
             sqrt(p * (1 - p) * (1 / nullif(CAST(n_c AS DOUBLE), 0) + 1 / nullif(CAST(n_t AS DOUBLE), 0))) AS se,
             sqrt(p_c * (1 - p_c) / nullif(n_c, 0) + p_t * (1 - p_t) / nullif(n_t, 0)) AS su FROM r)"""


@query(
    "ab_3_z_test",
    f"""
WITH a AS ({_ONE}), {_STATS}
SELECT n_c AS control_sessions, x_c AS control_conversions, round(p_c * 100, 2) AS control_conversion_rate_pct,
       n_t AS treatment_sessions, x_t AS treatment_conversions, round(p_t * 100, 2) AS treatment_conversion_rate_pct,
       round(lift * 100, 2) AS absolute_lift_pct_pts, round(rel * 100, 2) AS relative_lift_pct,
       round(lift / nullif(se, 0), 4) AS z_score,
       round((lift - 1.95996::DOUBLE * su) * 100, 2) AS ci_abs_lower_pct, round((lift + 1.95996::DOUBLE * su) * 100, 2) AS ci_abs_upper_pct,
       round((rel - 1.95996::DOUBLE * su / p_c) * 100, 2) AS ci_rel_lower_pct, round((rel + 1.95996::DOUBLE * su / p_c) * 100, 2) AS ci_rel_upper_pct,
       CASE WHEN abs(lift / nullif(se, 0)) >= 1.96 THEN 'REJECT H0: Statistically Significant (p < 0.05)'
            ELSE 'FAIL TO REJECT H0: Not Statistically Significant' END AS statistical_conclusion
FROM t""",
    "click",
)
def z_test(spark, sf_dir):
    return experiment.z_test(clicks(spark, sf_dir).fct_ab_test)


@query(
    "ab_4_covariate_balance",
    f"""
WITH a AS (SELECT device_type, count(*) FILTER (ab_variant = 'control') AS n_c, count(*) FILTER (ab_variant = 'control' AND completed_purchase = 1) AS x_c,
    count(*) FILTER (ab_variant = 'treatment') AS n_t, count(*) FILTER (ab_variant = 'treatment' AND completed_purchase = 1) AS x_t FROM fct_ab_test GROUP BY 1)
SELECT device_type, n_c AS control_sessions, n_t AS treatment_sessions,
       {pct('n_c', '(SELECT sum(n_c) FROM a)')} AS control_device_share_pct, {pct('n_t', '(SELECT sum(n_t) FROM a)')} AS treatment_device_share_pct,
       {pct('x_c', 'n_c')} AS control_conv_rate_pct, {pct('x_t', 'n_t')} AS treatment_conv_rate_pct FROM a""",
    "click",
)
def covariates(spark, sf_dir):
    return experiment.covariate_balance(clicks(spark, sf_dir).fct_ab_test).orderBy("device_type")


@query(
    "ab_5_daily_lift",
    f"""
WITH a AS (SELECT session_date, count(*) FILTER (ab_variant = 'control') AS n_c, count(*) FILTER (ab_variant = 'control' AND completed_purchase = 1) AS x_c,
    count(*) FILTER (ab_variant = 'treatment') AS n_t, count(*) FILTER (ab_variant = 'treatment' AND completed_purchase = 1) AS x_t FROM fct_ab_test GROUP BY 1),
r AS (SELECT *, {ratio('x_c', 'n_c')} AS p_c, {ratio('x_t', 'n_t')} AS p_t FROM a)
SELECT session_date, n_c AS daily_control_n, x_c AS daily_control_conv, {pct('x_c', 'n_c')} AS daily_control_conv_rate,
       n_t AS daily_treatment_n, x_t AS daily_treatment_conv, {pct('x_t', 'n_t')} AS daily_treatment_conv_rate,
       round((p_t - p_c) * 100 / nullif(p_c, 0), 2) AS daily_relative_lift_pct FROM r""",
    "click",
)
def daily(spark, sf_dir):
    return experiment.daily_lift(clicks(spark, sf_dir).fct_ab_test)


_TESTED = """
SELECT {keys} n_c AS n_control, x_c AS conversions_control, n_t AS n_treatment, x_t AS conversions_treatment,
       coalesce(p_c, 0) AS conversion_rate_control, coalesce(p_t, 0) AS conversion_rate_treatment,
       coalesce(p_t, 0) - coalesce(p_c, 0) AS absolute_difference, coalesce((coalesce(p_t, 0) - p_c) / nullif(p_c, 0), 0) AS relative_lift,
       CASE WHEN n_c > 0 AND n_t > 0 AND p > 0 AND p < 1 THEN se ELSE 0 END AS pooled_se,
       CASE WHEN n_c > 0 AND n_t > 0 AND p > 0 AND p < 1 THEN lift / se ELSE 0 END AS z_score
FROM t"""
_PLAIN = [
    "n_control",
    "conversions_control",
    "n_treatment",
    "conversions_treatment",
    "conversion_rate_control",
    "conversion_rate_treatment",
    "absolute_difference",
    "relative_lift",
    "pooled_se",
    "z_score",
]


@query(
    "ab_8_sliced_statistics",
    f"WITH a AS ({slices('fct_ab_test', ['device_type', 'country'], _ARMS)}), {_STATS} {_TESTED.format(keys='dimension, value,')}",
    "click",
)
def sliced(spark, sf_dir):
    """Everything of the sliced test that needs no normal tail."""
    return experiment.compute_ab_test(clicks(spark, sf_dir).fct_ab_test).select("dimension", "value", *_PLAIN)


def _tails(keys: str, share: float = 0.5, alpha: float = 0.05, srm_alpha: float = 0.01, z: str = "1.959963984540054::DOUBLE") -> str:
    """CTEs that end in ``v``: the tested rows with intervals, allocation check and p-value."""
    total = "CAST(n_control + n_treatment AS DOUBLE)"
    return f"""
f AS ({_TESTED.format(keys=keys + ' coalesce(CASE WHEN n_c > 0 AND n_t > 0 THEN su END, 0) AS spread,')}),
h AS (SELECT *, CASE WHEN {total} = 0 THEN 0 ELSE (n_control - {total} * {share}) ** 2 / ({total} * {share})
                     + (n_treatment - {total} * {1 - share}) ** 2 / ({total} * {1 - share}) END AS srm_chi2_statistic FROM f),
i AS (SELECT *, sqrt(srm_chi2_statistic / 2) AS srm_x, abs(z_score) / sqrt(2) AS z_x FROM h),
j AS (SELECT *, {erfc('srm_x')} AS srm_p_value, {erfc('z_x')} AS p_value FROM i),
v AS (SELECT * EXCLUDE (spread, srm_x, z_x), absolute_difference - {z} * spread AS ci_abs_lower, absolute_difference + {z} * spread AS ci_abs_upper,
             coalesce((absolute_difference - {z} * spread) / nullif(conversion_rate_control, 0), 0) AS ci_rel_lower,
             coalesce((absolute_difference + {z} * spread) / nullif(conversion_rate_control, 0), 0) AS ci_rel_upper,
             srm_p_value >= {srm_alpha} AS srm_passed, p_value < {alpha} AS statistically_significant FROM j)"""


@query(
    "ab_8_sliced_p_values",
    f"WITH a AS ({slices('fct_ab_test', ['device_type', 'country'], _ARMS)}), {_STATS}, {_tails('dimension, value,')} SELECT * FROM v",
    "click",
)
def sliced_p(spark, sf_dir):
    """p-values and intervals of the sliced test."""
    return experiment.compute_ab_test(clicks(spark, sf_dir).fct_ab_test)


def order_experiment(spark, sf_dir):
    """Orders as experiment rows: a completed order is a conversion."""
    w = shop(spark, sf_dir)
    orders = w.stg_orders.select("session_id", "user_id", "ab_variant", (F.col("status") == "completed").alias("completed_purchase"))
    devices = w.stg_sessions.select("session_id", "device_type")
    return orders.join(devices, "session_id", "left")


_ORDER_ARMS = _ARMS.replace("completed_purchase = 1", "status = 'completed'")
_ORDER_ROWS = "rows AS (SELECT o.ab_variant, o.status, s.device_type FROM stg_orders o LEFT JOIN stg_sessions s ON s.session_id = o.session_id)"


@query(
    "ab_9_orders_by_device",
    f"WITH {_ORDER_ROWS}, a AS ({slices('rows', ['device_type'], _ORDER_ARMS)}), {_STATS} {_TESTED.format(keys='dimension, value,')}",
)
def orders_by_device(spark, sf_dir):
    tested = experiment.compute_ab_test(order_experiment(spark, sf_dir), ["device_type"])
    return tested.select("dimension", "value", *_PLAIN)


_ORDER_ONE = f"{_ORDER_ROWS}, a AS ({slices('rows', [], _ORDER_ARMS)}), {_STATS}"
_SRM = "n_control, n_treatment, srm_chi2_statistic, srm_p_value, srm_passed"


@query(
    "ab_6_srm_p_value",
    f"""
SELECT 0.5::DOUBLE AS share, {_SRM} FROM (WITH {_ORDER_ONE}, {_tails('')} SELECT * FROM v)
UNION ALL SELECT 0.55::DOUBLE AS share, {_SRM} FROM (WITH {_ORDER_ONE}, {_tails('', 0.55)} SELECT * FROM v)""",
)
def srm_p(spark, sf_dir):
    """Allocation check with its p-value, for the default and for a 55 % control share."""
    counts = experiment.arm_counts(order_experiment(spark, sf_dir))
    even = experiment.evaluate_counts(counts).withColumn("share", F.lit(0.5))
    skewed = experiment.evaluate_counts(counts, share=0.55).withColumn("share", F.lit(0.55))
    columns = ["share", "n_control", "n_treatment", "srm_chi2_statistic", "srm_p_value", "srm_passed"]
    return even.select(*columns).unionByName(skewed.select(*columns))


@query("ab_7_z_test_p_value", f"WITH {_ORDER_ONE}, {_tails('')} SELECT * FROM v")
def z_p(spark, sf_dir):
    return experiment.evaluate_counts(experiment.arm_counts(order_experiment(spark, sf_dir)))


_DECIDE = f"""CASE WHEN abs(z_score) >= 1.96 AND relative_lift > 0 AND ({_CHI}) < 6.635
     THEN 'DEPLOY TREATMENT: Statistically significant positive lift observed without SRM.'
     ELSE 'DO NOT DEPLOY: Results inconclusive or SRM detected.' END"""


@query(
    "ab_10_decision",
    f"""
WITH a AS ({slices('fct_ab_test', ['device_type'], _ARMS)}), {_STATS},
v AS ({_TESTED.format(keys='dimension, value, n_c, x_c, n_t, x_t,')})
SELECT dimension, value, n_c, x_c, n_t, x_t, {_DECIDE} AS recommendation FROM v""",
    "click",
)
def decide(spark, sf_dir):
    return experiment.decision_from_counts(experiment.slice_counts(clicks(spark, sf_dir).fct_ab_test, ["device_type"]))


@query(
    "ab_10_decision_p_value",
    f"""
WITH a AS ({slices('fct_ab_test', ['device_type', 'country'], _ARMS)}), {_STATS}, {_tails('dimension, value,')}
SELECT dimension, value, z_score, p_value, srm_passed,
       CASE WHEN statistically_significant AND srm_passed AND relative_lift > 0
            THEN 'DEPLOY TREATMENT: Statistically significant positive lift observed without SRM.'
            ELSE 'DO NOT DEPLOY: Results inconclusive or SRM detected.' END AS recommendation FROM v""",
    "click",
)
def decide_p(spark, sf_dir):
    return experiment.decision(experiment.compute_ab_test(clicks(spark, sf_dir).fct_ab_test)).select(
        "dimension", "value", "z_score", "p_value", "srm_passed", "recommendation"
    )


@query(
    "ab_11_srm_table",
    """
WITH c AS (SELECT ab_variant, count(*) AS n FROM fct_ab_test GROUP BY 1), e AS (SELECT *, CAST(sum(n) OVER () AS DOUBLE) / count(*) OVER () AS want FROM c)
SELECT ab_variant, n AS observed, want AS expected, n - want AS difference, round((n - want) * (n - want) / nullif(want, 0), 6) AS chi_square_part FROM e""",
    "click",
)
def srm_rows(spark, sf_dir):
    return experiment.srm_table(clicks(spark, sf_dir).fct_ab_test)


@query(
    "ab_12_revenue_by_variant",
    f"""
SELECT ab_variant, count(*) AS sessions_at_checkout, {big('coalesce(sum(n), 0)')} AS conversions, {dbl('coalesce(sum(revenue), 0)')} AS total_revenue
FROM stg_sessions s LEFT JOIN (SELECT session_id, count(*) AS n, sum(total_amount) AS revenue FROM stg_orders GROUP BY 1) o ON o.session_id = s.session_id
WHERE s.session_id IN (SELECT session_id FROM stg_events WHERE event_type = 'click') GROUP BY 1""",
    "click",
)
def revenue_by_variant(spark, sf_dir):
    w = clicks(spark, sf_dir)
    return experiment.revenue_by_variant(w.stg_sessions, w.stg_events, w.stg_orders, entry="click")


@query(
    "ab_13_revenue_impact",
    f"""
WITH a AS ({_ONE}), {_STATS}, {_tails('')},
o AS (SELECT avg(CAST(total_amount AS DOUBLE)) AS aov FROM stg_orders WHERE status = 'completed'),
s AS (SELECT 'low' AS scenario, ci_rel_lower AS lift FROM v UNION ALL SELECT 'expected', relative_lift FROM v UNION ALL SELECT 'high', ci_rel_upper FROM v),
x AS (SELECT scenario, lift, 100000 * conversion_rate_control AS base, aov FROM s, v, o)
SELECT scenario, round(lift, 6) AS relative_lift, round(base, 4) AS baseline_orders, round(base * lift, 4) AS incremental_orders,
       round(base * lift * aov, 2) AS incremental_revenue, round(base * lift * aov * 0.52::DOUBLE, 2) AS incremental_profit FROM x""",
    "click",
)
def impact(spark, sf_dir):
    """Low, expected and high scenario from the observed arms, order value and margin."""
    w = clicks(spark, sf_dir)
    counts = experiment.arm_counts(w.fct_ab_test)
    value = completed(w.stg_orders).agg(F.avg(F.col("total_amount").cast("double"))).scalar()
    return experiment.revenue_impact(counts, 100_000, value, 0.52)


@query(
    "ab_13_expected_impact",
    f"""
WITH a AS ({_ONE}), {_STATS}, v AS (SELECT CAST(sum(total_amount) AS DOUBLE) / count(*) AS aov FROM stg_orders)
SELECT round(rel, 6) AS relative_lift, round(100000 * p_c, 4) AS baseline_orders, round(100000 * p_c * rel, 4) AS incremental_orders
FROM t, v""",
    "click",
)
def expected_impact(spark, sf_dir):
    counts = experiment.arm_counts(clicks(spark, sf_dir).fct_ab_test)
    rows = experiment.revenue_impact(counts, 100_000, 1.0, 1.0)
    return rows.where(F.col("scenario") == "expected").select("relative_lift", "baseline_orders", "incremental_orders")


@query(
    "agg_5_conditional_counts",
    f"WITH a AS ({_ONE}) SELECT n_c, x_c, n_t, x_t FROM a",
    "click",
)
def conditional_counts(spark, sf_dir):
    return experiment.arm_counts(clicks(spark, sf_dir).fct_ab_test)


@query(
    "agg_12_share_of_total",
    f"""
WITH c AS (SELECT traffic_source, count(*) AS n FROM fct_ab_test GROUP BY 1)
SELECT traffic_source, n AS sessions, {pct('n', 'sum(n) OVER ()')} AS share_pct FROM c""",
    "click",
)
def share_of_total(spark, sf_dir):
    from pyspark.sql import Window

    from merchlens.functions.scalar import pct as share

    counts = clicks(spark, sf_dir).fct_ab_test.groupBy("traffic_source").agg(F.count(F.lit(1)).alias("sessions"))
    # One row per source.
    return counts.withColumn("share_pct", share("sessions", F.sum("sessions").over(Window.partitionBy())))
