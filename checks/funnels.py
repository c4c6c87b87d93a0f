"""Funnel queries over the click world."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import clicks, query
from checks.sqltext import big, dbl, pct, ratio, slices
from merchlens.operators import funnel
from merchlens.sources.bindings import CLICK_STAGES

STEPS = dict(view=1, cart=2, checkout=3, payment=3, purchase=4)
SHORT = dict(cart=2, checkout=3, purchase=4)

_N = "count(DISTINCT session_id)"
_R = "count(DISTINCT session_id) FILTER (reached_{} = 1)"
_LONG = f"""
SELECT unnest([1, 2, 3, 4]) AS stage_order,
       unnest(['1_sessions', '2_click', '3_signup', '4_purchase']) AS stage_name,
       unnest([n, c, s, p]) AS sessions_entered, n AS base
FROM (SELECT {_N} AS n, {_R.format('click')} AS c, {_R.format('signup')} AS s, {_R.format('purchase')} AS p FROM fct_funnel)"""


@query(
    "fun_1_stage_progression",
    f"""
WITH stage AS ({_LONG}), prior AS (SELECT *, lag(sessions_entered) OVER (ORDER BY stage_order) AS before FROM stage)
SELECT {big('stage_order')} AS stage_order, stage_name, sessions_entered,
       coalesce(before - sessions_entered, 0) AS absolute_drop_off,
       coalesce({pct('sessions_entered', 'before')}, 100) AS stage_conversion_rate_pct,
       coalesce({pct('before - sessions_entered', 'before')}, 0) AS stage_drop_off_rate_pct,
       {pct('sessions_entered', 'base')} AS overall_conversion_rate_pct
FROM prior""",
    "click",
)
def stage_progression(spark, sf_dir):
    return funnel.stage_progression(clicks(spark, sf_dir).fct_funnel, CLICK_STAGES)


@query(
    "fun_2_by_device",
    f"""
SELECT device_type, {_N} AS total_sessions, {_R.format('view')} AS product_views, {_R.format('click')} AS cart_additions,
       {_R.format('signup')} AS checkout_starts, {_R.format('signup')} AS payment_starts, {_R.format('purchase')} AS purchases,
       {pct(_R.format('view'), _N)} AS view_rate_pct,
       {pct(_R.format('click'), _R.format('view'))} AS cart_conversion_rate_pct,
       {pct(_R.format('signup'), _R.format('click'))} AS checkout_initiation_rate_pct,
       {pct(_R.format('purchase'), _R.format('signup'))} AS checkout_completion_rate_pct,
       {pct(_R.format('purchase'), _N)} AS overall_conversion_rate_pct
FROM fct_funnel GROUP BY device_type""",
    "click",
)
def by_device(spark, sf_dir):
    return funnel.step_rates(clicks(spark, sf_dir).fct_funnel, "device_type", CLICK_STAGES, **STEPS).orderBy(
        F.desc("total_sessions")
    )


def _conversion_sql(key: str, names: dict[str, str], source: str = "fct_funnel") -> str:
    values = {
        "total_sessions": _N,
        "cart_sessions": _R.format("click"),
        "checkout_sessions": _R.format("signup"),
        "purchasing_sessions": _R.format("purchase"),
        "add_to_cart_rate_pct": pct(_R.format("click"), _N),
        "checkout_to_purchase_rate_pct": pct(_R.format("purchase"), _R.format("signup")),
        "overall_conversion_rate_pct": pct(_R.format("purchase"), _N),
    }
    columns = ", ".join(f"{values[v]} AS {n}" for n, v in names.items())
    return f"SELECT {key}, {columns} FROM {source} GROUP BY ALL"


_SAME = {c: c for c in ("total_sessions", "cart_sessions", "checkout_sessions", "purchasing_sessions", "overall_conversion_rate_pct")}


@query(
    "fun_3_by_source",
    _conversion_sql(
        "traffic_source",
        _SAME
        | {c: c for c in ("add_to_cart_rate_pct", "checkout_to_purchase_rate_pct")},
    ),
    "click",
)
def by_source(spark, sf_dir):
    fact = clicks(spark, sf_dir).fct_funnel
    return funnel.conversion_by(fact, "traffic_source", CLICK_STAGES, **SHORT).orderBy(
        F.desc("overall_conversion_rate_pct")
    )


@query(
    "fun_4_by_segment",
    _conversion_sql("customer_segment", _SAME | {"checkout_completion_rate_pct": "checkout_to_purchase_rate_pct"}),
    "click",
)
def by_segment(spark, sf_dir):
    return funnel.segment_conversion(clicks(spark, sf_dir).fct_funnel, stages=CLICK_STAGES, **SHORT)


@query(
    "fun_5_new_vs_returning",
    _conversion_sql(
        "CASE WHEN is_returning_user THEN 'Returning User' ELSE 'New User' END AS user_type",
        {
            "total_sessions": "total_sessions",
            "cart_sessions": "cart_sessions",
            "checkout_sessions": "checkout_sessions",
            "purchase_sessions": "purchasing_sessions",
            "overall_conversion_rate_pct": "overall_conversion_rate_pct",
            "checkout_conversion_rate_pct": "checkout_to_purchase_rate_pct",
        },
    ),
    "click",
)
def new_vs_returning(spark, sf_dir):
    return funnel.new_vs_returning(clicks(spark, sf_dir).fct_funnel, stages=CLICK_STAGES, **SHORT)


@query(
    "fun_6_leak_ranking",
    f"""
WITH t AS (SELECT {_N} AS n, {_R.format('click')} AS c, {_R.format('signup')} AS s, {_R.format('purchase')} AS p FROM fct_funnel),
pairs AS (SELECT unnest(['1. View -> Click', '2. Click -> Signup', '3. Signup -> Purchase']) AS stage_transition,
                 unnest([n, c, s]) AS entered_sessions, unnest([c, s, p]) AS completed_sessions FROM t)
SELECT stage_transition, entered_sessions, completed_sessions, entered_sessions - completed_sessions AS lost_sessions,
       {pct('entered_sessions - completed_sessions', 'entered_sessions')} AS drop_off_pct,
       dense_rank() OVER (ORDER BY entered_sessions - completed_sessions DESC) AS leak_severity_rank
FROM pairs""",
    "click",
)
def leak_ranking(spark, sf_dir):
    return funnel.leak_ranking(clicks(spark, sf_dir).fct_funnel, CLICK_STAGES)


def _clamped(source: str, keys: str = "") -> str:
    """Stage rows from one row per slice holding total and n1..n4."""
    return f"""
SELECT {keys} {big('step_number')} AS step_number, stage_name, {big('n')} AS sessions_count,
       coalesce({pct('n', 'before')}, 0) AS step_conversion_rate, coalesce({pct('n', 'total')}, 0) AS overall_conversion_rate,
       {big('greatest(0, before - n)')} AS absolute_drop_off, coalesce({pct('greatest(0, before - n)', 'before')}, 0) AS drop_off_rate
FROM (SELECT *, unnest([1, 2, 3, 4]) AS step_number, unnest(['view', 'click', 'signup', 'purchase']) AS stage_name,
             unnest([n1, n2, n3, n4]) AS n, unnest([total, n1, n2, n3]) AS before FROM {source})"""


_EVENT_COUNTS = """SELECT {dim} AS dimension, {val} AS value, count(*) AS total,
       count(DISTINCT session_id) FILTER (event_type = 'view') AS n1, count(DISTINCT session_id) FILTER (event_type = 'click') AS n2,
       count(DISTINCT session_id) FILTER (event_type = 'signup') AS n3, count(DISTINCT session_id) FILTER (event_type = 'purchase') AS n4
FROM {src} GROUP BY ALL"""
_FLAG_COUNTS = """SELECT {dim} AS dimension, {val} AS value, count(*) AS total,
       count(*) FILTER (reached_view = 1) AS n1, count(*) FILTER (reached_click = 1) AS n2,
       count(*) FILTER (reached_signup = 1) AS n3, count(*) FILTER (reached_purchase = 1) AS n4
FROM {src} GROUP BY ALL"""


@query("fun_7_evaluate_events", f"WITH counts AS ({slices('stg_events', [], _EVENT_COUNTS)}) {_clamped('counts')}", "click")
def evaluate_events(spark, sf_dir):
    return funnel.evaluate_funnel(clicks(spark, sf_dir).stg_events, CLICK_STAGES)


@query("fun_7_evaluate_flags", f"WITH counts AS ({slices('fct_funnel', [], _FLAG_COUNTS)}) {_clamped('counts')}", "click")
def evaluate_flags(spark, sf_dir):
    return funnel.evaluate_funnel(clicks(spark, sf_dir).fct_funnel, CLICK_STAGES)


@query(
    "fun_7_evaluate_furthest_step",
    f"""
WITH counts AS (SELECT count(*) AS total, count(*) FILTER (furthest_step_reached >= 1) AS n1,
    count(*) FILTER (furthest_step_reached >= 2) AS n2, count(*) FILTER (furthest_step_reached >= 3) AS n3,
    count(*) FILTER (furthest_step_reached >= 4) AS n4 FROM fct_funnel) {_clamped('counts')}""",
    "click",
)
def evaluate_furthest(spark, sf_dir):
    fact = clicks(spark, sf_dir).fct_funnel.select("session_id", "furthest_step_reached")
    return funnel.evaluate_funnel(fact, CLICK_STAGES)


_DIMENSIONS = ["device_type", "traffic_source", "country", "customer_segment"]


@query(
    "fun_8_slices",
    f"WITH counts AS ({slices('fct_funnel', _DIMENSIONS, _FLAG_COUNTS)}) {_clamped('counts', 'dimension, value,')}",
    "click",
)
def slice_report(spark, sf_dir):
    return funnel.evaluate_slices(clicks(spark, sf_dir).fct_funnel, CLICK_STAGES)


@query(
    "fun_9_events_and_sessions",
    f"""
WITH c AS ({slices('stg_events', [], _EVENT_COUNTS)}), b AS (SELECT count(*) AS base FROM stg_sessions),
s AS (SELECT unnest([1, 2, 3, 4]) AS step_number, unnest(['view', 'click', 'signup', 'purchase']) AS stage_name,
             unnest([n1, n2, n3, n4]) AS n, unnest([base, n1, n2, n3]) AS before, base FROM c, b)
SELECT {big('step_number')} AS step_number, stage_name, n AS sessions_count, coalesce({pct('n', 'before')}, 0) AS step_conversion_rate,
       coalesce({pct('n', 'base')}, 0) AS overall_conversion_rate, before - n AS absolute_drop_off,
       coalesce({pct('before - n', 'before')}, 0) AS drop_off_rate FROM s""",
    "click",
)
def events_and_sessions(spark, sf_dir):
    w = clicks(spark, sf_dir)
    return funnel.compute_funnel_metrics(w.stg_events, w.stg_sessions, CLICK_STAGES)


@query(
    "fun_10_report",
    f"""
WITH counts AS ({slices('fct_funnel', _DIMENSIONS, _FLAG_COUNTS)}),
stage AS ({_clamped('counts', 'dimension, value,')}),
worst AS (SELECT *, row_number() OVER (PARTITION BY dimension, value ORDER BY absolute_drop_off DESC, step_number) AS place
          FROM stage WHERE step_number > 1)
SELECT s.*, w.stage_name AS top_dropoff_stage FROM stage s
JOIN worst w ON w.place = 1 AND w.dimension = s.dimension AND w.value = s.value""",
    "click",
)
def report(spark, sf_dir):
    return funnel.funnel_report(clicks(spark, sf_dir).fct_funnel, CLICK_STAGES)


@query(
    "fun_10_summary",
    f"""
WITH counts AS ({slices('fct_funnel', [], _FLAG_COUNTS)}), stage AS ({_clamped('counts')})
SELECT (SELECT total FROM counts) AS total_sessions,
       (SELECT overall_conversion_rate FROM stage WHERE step_number = 4) AS overall_conversion_rate,
       (SELECT stage_name FROM stage WHERE step_number > 1 ORDER BY absolute_drop_off DESC, step_number LIMIT 1) AS top_dropoff_stage""",
    "click",
)
def summary(spark, sf_dir):
    return funnel.funnel_summary(clicks(spark, sf_dir).fct_funnel, CLICK_STAGES)


@query(
    "fun_11_invariants",
    """
SELECT count(*) AS sessions,
       count(*) FILTER (reached_click > reached_view OR reached_signup > reached_click OR reached_purchase > reached_signup) AS sessions_out_of_order,
       count(*) FILTER (reached_click > reached_view) AS click_without_view,
       count(*) FILTER (reached_signup > reached_click) AS signup_without_click,
       count(*) FILTER (reached_purchase > reached_signup) AS purchase_without_signup,
       sum(reached_view) >= sum(reached_click) AND sum(reached_click) >= sum(reached_signup)
         AND sum(reached_signup) >= sum(reached_purchase) AS population_monotonic
FROM fct_funnel""",
    "click",
)
def invariants(spark, sf_dir):
    return funnel.funnel_invariants(clicks(spark, sf_dir).fct_funnel, CLICK_STAGES)


@query(
    "fun_12_channel_matrix",
    f"""
WITH v AS (SELECT traffic_source, {_N} AS n FROM fct_funnel GROUP BY 1),
s AS (SELECT traffic_source, count(*) FILTER (status = 'completed') AS orders, sum(subtotal_amount) AS revenue FROM fct_orders GROUP BY 1)
SELECT v.traffic_source, n AS total_sessions, coalesce(orders, 0) AS total_orders, {dbl('coalesce(revenue, 0)')} AS gross_revenue,
       coalesce({ratio('revenue', 'orders')}, 0) AS average_order_value, coalesce({ratio('orders', 'n')}, 0) AS conversion_rate
FROM v LEFT JOIN s ON s.traffic_source = v.traffic_source""",
    "click",
)
def channel_matrix(spark, sf_dir):
    w = clicks(spark, sf_dir)
    return funnel.channel_matrix(w.fct_funnel, w.fct_orders)


@query(
    "fun_13_stage_by_device",
    f"""
WITH n AS (SELECT device_type, {_N} AS n, {_R.format('click')} AS c, {_R.format('signup')} AS s, {_R.format('purchase')} AS p FROM fct_funnel GROUP BY 1),
stage AS (SELECT device_type, n AS base, unnest([1, 2, 3, 4]) AS stage_order,
     unnest(['1_sessions', '2_click', '3_signup', '4_purchase']) AS stage_name, unnest([n, c, s, p]) AS sessions_entered, unnest([NULL, n, c, s]) AS before FROM n)
SELECT device_type, {big('stage_order')} AS stage_order, stage_name, sessions_entered, coalesce(before - sessions_entered, 0) AS absolute_drop_off,
       coalesce({pct('sessions_entered', 'before')}, 100) AS stage_conversion_rate_pct,
       coalesce({pct('before - sessions_entered', 'before')}, 0) AS stage_drop_off_rate_pct,
       {pct('sessions_entered', 'base')} AS overall_conversion_rate_pct
FROM stage""",
    "click",
)
def stage_by_device(spark, sf_dir):
    return funnel.stage_progression(clicks(spark, sf_dir).fct_funnel, CLICK_STAGES, ["device_type"])


@query(
    "fun_13_drop_off_grid",
    f"""
SELECT country, customer_segment, {_N} AS total_sessions,
       coalesce({ratio(_R.format('purchase'), _R.format('view'))}, 0) AS overall_funnel_conversion,
       {_R.format('click')} - {_R.format('signup')} AS drop_off_sessions
FROM fct_funnel GROUP BY ALL""",
    "click",
)
def drop_off_grid(spark, sf_dir):
    return funnel.drop_off_grid(clicks(spark, sf_dir).fct_funnel, stages=CLICK_STAGES, before=2, after=3)


@query(
    "agg_6_distinct_counts",
    f"""
SELECT {_N} AS total_sessions, {_R.format('view')} AS reached_view, {_R.format('click')} AS reached_click,
       {_R.format('signup')} AS reached_signup, {_R.format('purchase')} AS reached_purchase FROM fct_funnel""",
    "click",
)
def distinct_counts(spark, sf_dir):
    return funnel.stage_counts(clicks(spark, sf_dir).fct_funnel, CLICK_STAGES)


@query(
    "agg_14_unpivot",
    """
SELECT session_id, unnest(['view', 'click', 'signup', 'purchase']) AS stage,
       unnest([view_events, click_events, signup_events, purchase_events]) AS events FROM int_session_funnel_events""",
    "click",
)
def unpivot(spark, sf_dir):
    counts = clicks(spark, sf_dir).int_session_funnel_events
    long = counts.unpivot("session_id", [f"{s.name}_events" for s in CLICK_STAGES], "stage", "events")
    return long.withColumn("stage", F.regexp_replace("stage", "_events$", ""))


@query(
    "agg_16_device_segment_grid",
    f"""
SELECT device_type, customer_segment, count(*) AS sessions, {ratio('sum(is_converting_session)', 'count(*)')} AS conversion_rate
FROM fct_funnel GROUP BY ALL""",
    "click",
)
def conversion_grid(spark, sf_dir):
    return funnel.conversion_grid(clicks(spark, sf_dir).fct_funnel, ["device_type", "customer_segment"])


@query(
    "agg_16_device_segment_cube",
    f"""
SELECT device_type, customer_segment, count(*) AS sessions, {ratio('sum(is_converting_session)', 'count(*)')} AS conversion_rate
FROM fct_funnel GROUP BY CUBE (device_type, customer_segment)""",
    "click",
)
def conversion_cube(spark, sf_dir):
    return funnel.conversion_cube(clicks(spark, sf_dir).fct_funnel, ["device_type", "customer_segment"])


@query(
    "agg_15_event_slices",
    f"WITH counts AS ({slices('stg_events', ['event_date', 'page_url'], _EVENT_COUNTS)}) {_clamped('counts', 'dimension, value,')}",
    "click",
)
def event_slices(spark, sf_dir):
    events = clicks(spark, sf_dir).stg_events
    return funnel.evaluate_slices(events, CLICK_STAGES, ["event_date", "page_url"])


@query(
    "prj_2_resolved_columns",
    f"WITH counts AS ({slices('stg_events', [], _EVENT_COUNTS)}) {_clamped('counts')}",
    "click",
)
def resolved(spark, sf_dir):
    """The event name column under its other name."""
    events = clicks(spark, sf_dir).stg_events.select("session_id", "event_name")
    return funnel.evaluate_funnel(events, CLICK_STAGES)
