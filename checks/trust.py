"""Data-quality queries. The test data breaks many rules on purpose: counts must agree."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import clicks, query, shop
from checks.sqltext import big, dbl, erfc
from merchlens.operators import quality
from merchlens.plans.publish import materialise
from merchlens.session import work_dir

STAGED = ("stg_users", "stg_sessions", "stg_events", "stg_orders", "stg_order_items", "stg_products")
# Models of each suite, per world.
SHOP_MODELS = (
    "int_order_items_aggregated",
    "int_user_order_summary",
    "int_user_cohort_monthly",
    "dim_users",
    "dim_products",
    "dim_date",
    "fct_user_retention",
)
CLICK_MODELS = ("int_session_funnel_events", "int_ab_session_conversions", "fct_funnel", "fct_orders", "fct_ab_test", "dim_users")
ABSENT = {("int_session_funnel_events", "reached_landing_page")}


def _literal(value) -> str:
    return f"'{value}'" if isinstance(value, str) else str(value)


def check_sql(check: quality.Check) -> str:
    table, column = check.table, check.column
    if (table, column) in ABSENT:
        return f"SELECT '{table}' AS \"table\", '{column}' AS \"column\", '{check.kind}' AS kind, CAST(1 AS BIGINT) AS failures, TRUE AS errored"
    if check.kind == "unique":
        found = f"SELECT count(*) FROM (SELECT {column} FROM {table} WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"
    elif check.kind == "not_null":
        found = f"SELECT count(*) FROM {table} WHERE {column} IS NULL"
    elif check.kind == "accepted_values":
        found = f"SELECT count(*) FROM {table} WHERE {column} NOT IN ({', '.join(map(_literal, check.values))})"
    else:
        parent, key = check.parent
        found = f"SELECT count(*) FROM {table} WHERE {column} IS NOT NULL AND CAST({column} AS VARCHAR) NOT IN (SELECT CAST({key} AS VARCHAR) FROM {parent} WHERE {key} IS NOT NULL)"
    return (
        f"SELECT '{table}' AS \"table\", '{column}' AS \"column\", '{check.kind}' AS kind, "
        f"({found}) AS failures, FALSE AS errored"
    )


def suite_sql(models) -> str:
    union = "\nUNION ALL\n".join(check_sql(c) for c in quality.declared_checks(models))
    return f"SELECT *, failures = 0 AS passed FROM (\n{union})"


@query("dq_5_staging_suite", suite_sql(STAGED))
def staging_suite(spark, sf_dir):
    """Declared assertions of the staging models; order sessions stand in for sessions."""
    w = shop(spark, sf_dir)
    tables = {m: w[m] for m in STAGED}
    # Click events carry text session ids, orders carry numbers: compare as text.
    for model in ("stg_sessions", "stg_events", "stg_orders"):
        tables[model] = tables[model].withColumn("session_id", F.col("session_id").cast("string"))
    return quality.run_checks(tables, quality.declared_checks(STAGED))


def _suite(world, name, models, spark, sf_dir):
    tables = materialise(world(spark, sf_dir), work_dir(spark, name), models)
    return quality.run_checks(tables, quality.declared_checks(models))


@query("dq_5_order_marts_suite", suite_sql(SHOP_MODELS))
def order_marts_suite(spark, sf_dir):
    return _suite(shop, "order-marts", SHOP_MODELS, spark, sf_dir)


BUILT = (*CLICK_MODELS, "stg_orders", "fct_user_retention", "int_user_cohort_monthly", "int_user_order_summary")
KEYED = ("int_session_funnel_events", "fct_orders", "dim_users", "stg_orders", "int_user_order_summary")
EXPORTED = [m for m in BUILT if m[:4] not in ("int_", "stg_")]
REPORTS = ("funnel_analysis_report", "cohort_retention_report", "ab_test_results_report", "statistical_summary_report")


@query(
    "cfg_1_ordered_build",
    " UNION ALL ".join(f"SELECT '{m}' AS \"table\", count(*) AS \"rows\", TRUE AS made FROM {m}" for m in EXPORTED)
    + "".join(f" UNION ALL SELECT '{r}', CAST(NULL AS BIGINT), TRUE" for r in REPORTS),
    "click",
)
def ordered_build(spark, sf_dir):
    """Models, assertions, gate, exports and reports in one call, with the keys of this shop as assertions.

    The rows of every exported mart, read from its CSV form, and that each report was written.
    """
    from merchlens.plans.build import ordered_build as build

    folder, out = work_dir(spark, "build"), None
    # Sessions with several orders have several rows in the funnel and experiment tables of this data.
    keys = [c for c in quality.declared_checks(KEYED) if c.kind == "unique"]
    build(clicks(spark, sf_dir), folder, BUILT, checks=keys)
    for mart in EXPORTED:
        rows = spark.read.option("header", True).option("multiLine", True).csv(f"{folder}/export/{mart}.csv")
        one = rows.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(mart).alias("table"), "rows", F.lit(True).alias("made"))
        out = one if out is None else out.union(one)
    for name in REPORTS:
        made = not spark.read.parquet(f"{folder}/reports/{name}.parquet").isEmpty()
        out = out.union(spark.range(1).select(F.lit(name), F.lit(None).cast("bigint"), F.lit(made)))
    return out


@query(
    "cfg_1_gate",
    f"""SELECT kind || '_' || "table" || '_' || "column" AS assertion, failures, CASE WHEN errored THEN 'ERROR' ELSE 'FAIL' END AS state,
       FALSE AS exported FROM ({suite_sql(CLICK_MODELS)}) WHERE failures > 0""",
    "click",
)
def gated_build(spark, sf_dir):
    """The declared assertions stop the build of this data: the incidents, and that nothing behind the gate was written."""
    from merchlens.plans.build import ordered_build as build
    from merchlens.sources.incremental import committed

    folder = work_dir(spark, "gated")
    try:
        build(clicks(spark, sf_dir), folder, CLICK_MODELS)
        found = []
    except quality.GateTripped as tripped:
        found = tripped.incidents
    exported = committed(spark, f"{folder}/export/fct_orders.parquet")
    rows = spark.createDataFrame(found, "assertion string, failures bigint, state string")
    return rows.withColumn("exported", F.lit(exported))


@query("dq_5_click_marts_suite", suite_sql(CLICK_MODELS), "click")
def click_marts_suite(spark, sf_dir):
    return _suite(clicks, "click-marts", CLICK_MODELS, spark, sf_dir)


@query(
    "dq_6_incidents",
    f"""
SELECT kind || '_' || "table" || '_' || "column" AS assertion, failures, CASE WHEN errored THEN 'ERROR' ELSE 'FAIL' END AS state
FROM ({suite_sql(STAGED)}) WHERE failures > 0""",
)
def incidents(spark, sf_dir):
    return quality.incidents(staging_suite(spark, sf_dir))


@query(
    "dq_1_duplicate_line_references",
    "SELECT order_item_id, count(*) AS rows FROM stg_order_items GROUP BY 1 HAVING count(*) > 1",
)
def duplicates(spark, sf_dir):
    return quality.duplicated_values(shop(spark, sf_dir).stg_order_items, "order_item_id")


@query(
    "dq_2_null_counts",
    """
SELECT count(*) FILTER (subtotal IS NULL) AS subtotal, count(*) FILTER (tax_amount IS NULL) AS tax_amount,
       count(*) FILTER (shipping_fee IS NULL) AS shipping_fee, count(*) FILTER (total_amount IS NULL) AS total_amount FROM raw_orders""",
)
def null_counts(spark, sf_dir):
    columns = ["subtotal", "tax_amount", "shipping_fee", "total_amount"]
    raw = shop(spark, sf_dir).raw.orders
    return raw.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


@query(
    "dq_3_accepted_values",
    f"SELECT * FROM ({suite_sql(('fct_funnel',))}) WHERE kind = 'accepted_values'",
    "click",
)
def accepted(spark, sf_dir):
    wanted = [c for c in quality.declared_checks(("fct_funnel",)) if c.kind == "accepted_values"]
    return quality.run_checks({"fct_funnel": clicks(spark, sf_dir).fct_funnel}, wanted)


@query(
    "dq_4_relationships",
    """
SELECT l_orderkey AS order_id, count(*) AS rows FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY 1""",
)
def relationships(spark, sf_dir):
    """Lines whose order is not a completed one, by order."""
    w = shop(spark, sf_dir)
    done = w.stg_orders.where(F.col("status") == "completed")
    return quality.orphans(w.stg_order_items, "order_id", done, "order_id")


@query(
    "dq_7_row_floor",
    "SELECT count(*) AS rows, CAST(100000 AS BIGINT) AS required, count(*) >= 100000 AS passed FROM stg_sessions",
    "click",
)
def row_floor(spark, sf_dir):
    return quality.row_floor(clicks(spark, sf_dir).stg_sessions, 100_000)


def _fk_sql(child, column, parent, target):
    return (
        f"SELECT '{child}.{column}' AS foreign_key, (SELECT count(*) FROM stg_{child} WHERE {column} IS NOT NULL AND CAST({column} AS VARCHAR) "
        f"NOT IN (SELECT CAST({target} AS VARCHAR) FROM stg_{parent} WHERE {target} IS NOT NULL)) AS orphan_rows"
    )


_FK = "\nUNION ALL\n".join(_fk_sql(*k) for k in quality.FOREIGN_KEYS)


@query(
    "dq_8_orphans",
    f"WITH r AS ({_FK}) SELECT * FROM r UNION ALL SELECT 'total', {big('sum(orphan_rows)')} FROM r",
    "click",
)
def orphans(spark, sf_dir):
    w = clicks(spark, sf_dir)
    tables = {name: w[f"stg_{name}"] for name in ("users", "sessions", "events", "orders", "products", "order_items")}
    tables["products"] = tables["products"].withColumn("product_id", F.col("product_id").cast("string"))
    return quality.orphan_report(tables)


@query(
    "dq_9_temporal_order",
    """
SELECT 'session_before_signup' AS rule, (SELECT count(*) FROM stg_sessions s JOIN stg_users u USING (user_id) WHERE session_start < signup_timestamp) AS violations
UNION ALL SELECT 'session_ends_before_start', (SELECT count(*) FROM stg_sessions WHERE session_end < session_start)
UNION ALL SELECT 'event_outside_session', (SELECT count(*) FROM stg_events e JOIN stg_sessions s USING (session_id) WHERE event_timestamp NOT BETWEEN session_start AND session_end)
UNION ALL SELECT 'order_time_not_purchase_time', (SELECT count(*) FROM stg_orders o JOIN (SELECT session_id, min(event_timestamp) AS t FROM stg_events WHERE event_type = 'purchase' GROUP BY 1) p USING (session_id) WHERE order_timestamp <> t)
UNION ALL SELECT 'order_date_not_timestamp_date', (SELECT count(*) FROM stg_orders WHERE order_date <> CAST(order_timestamp AS DATE))
UNION ALL SELECT 'item_before_product', (SELECT count(*) FROM stg_order_items i JOIN stg_products p USING (product_id) JOIN stg_orders o USING (order_id) WHERE CAST(order_timestamp AS DATE) < p.created_at)""",
    "click",
)
def temporal(spark, sf_dir):
    w = clicks(spark, sf_dir)
    return quality.temporal_order(w.stg_users, w.stg_sessions, w.stg_events, w.stg_orders, w.stg_order_items, w.stg_products)


@query(
    "dq_9_shipped_before_ordered",
    "SELECT count(*) AS lines, count(*) FILTER (l_shipdate < o_orderdate) AS shipped_before_ordered FROM lineitem JOIN orders ON o_orderkey = l_orderkey",
)
def shipped(spark, sf_dir):
    from merchlens.sources.bindings import table

    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate")
    placed = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    joined = lines.join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.col("l_shipdate") < F.col("o_orderdate")).alias("shipped_before_ordered"),
    )


@query(
    "dq_10_funnel_validity",
    f"""
WITH s AS (SELECT session_id, min(step_number) AS lo, max(step_number) AS hi, count(step_number) AS n, count(*) FILTER (event_type = 'purchase') AS p,
    {', '.join(f'max(CAST(step_number = {k} AS INT)) AS s{k}' for k in range(1, 5))} FROM stg_events GROUP BY 1),
t AS (SELECT {', '.join(f'{big(f"sum(s{k})")} AS step_{k}_sessions' for k in range(1, 5))}, count(*) FILTER (lo <> 1 OR hi <> n) AS sessions_with_skipped_steps, {big('sum(p)')} AS purchase_events FROM s)
SELECT *, step_1_sessions > step_2_sessions AND step_2_sessions > step_3_sessions AND step_3_sessions > step_4_sessions AS strictly_decreasing,
       (SELECT count(*) FROM stg_orders) AS orders, purchase_events = (SELECT count(*) FROM stg_orders) AS purchases_match_orders FROM t""",
    "click",
)
def funnel_validity(spark, sf_dir):
    w = clicks(spark, sf_dir)
    return quality.funnel_validity(w.stg_events, w.stg_orders, steps=4)


_GAPS = """
gaps AS (SELECT 'subtotal_is_sum_of_lines' AS rule, abs(s.v - o.subtotal) AS gap FROM stg_orders o JOIN (SELECT order_id, sum(line_total) AS v FROM stg_order_items GROUP BY 1) s USING (order_id)
UNION ALL SELECT 'total_is_sum_of_parts', abs(total_amount - (subtotal + tax_amount + shipping_fee - discount_amount)) FROM stg_orders
UNION ALL SELECT 'line_is_quantity_times_price', abs(line_total - quantity * unit_price) FROM stg_order_items
UNION ALL SELECT 'profit_is_quantity_times_margin', abs(line_profit - quantity * (unit_price - unit_cost)) FROM stg_order_items)"""


@query(
    "dq_11_financial_reconciliation",
    f"WITH {_GAPS} SELECT rule, count(gap) AS compared, count(*) FILTER (gap >= 0.01) AS violations, {dbl('max(gap)')} AS max_difference FROM gaps GROUP BY 1",
)
def financial(spark, sf_dir):
    w = shop(spark, sf_dir)
    return quality.financial_reconciliation(w.stg_orders, w.stg_order_items)


@query(
    "dq_12_priced_orders",
    f"""
WITH r AS (SELECT o.order_id, subtotal, customer_segment,
    CAST(round(subtotal * CASE WHEN customer_segment = 'BUILDING' THEN 0.10 ELSE 0.00 END, 2) AS DECIMAL(18,2)) AS d,
    CASE WHEN subtotal >= 75 THEN 0.00 ELSE 5.99 END AS s FROM stg_orders o JOIN stg_users u USING (user_id)),
t AS (SELECT *, CAST(round(CAST(greatest(0, subtotal - d) AS DECIMAL(18,2)) * 0.0825, 2) AS DECIMAL(18,2)) AS x FROM r)
SELECT order_id, {dbl('d')} AS expected_discount, {dbl('s')} AS expected_shipping, {dbl('x')} AS expected_tax, {dbl('subtotal + x + s - d')} AS expected_total FROM t""",
)
def priced(spark, sf_dir):
    w = shop(spark, sf_dir)
    orders = w.stg_orders.select("order_id", "user_id", "subtotal").join(
        w.stg_users.select("user_id", "customer_segment"), "user_id"
    )
    rule = quality.Pricing(vip_segment="BUILDING")
    columns = ["order_id", "expected_discount", "expected_shipping", "expected_tax", "expected_total"]
    return quality.priced(orders, rule).select(*columns)


@query(
    "dq_12_pricing_violations",
    """
SELECT count(*) AS orders, count(*) FILTER (shipping_fee <> CASE WHEN subtotal >= 75 THEN 0 ELSE 5.99 END) AS shipping_violations,
       count(*) FILTER (abs(tax_amount - round(CAST(greatest(0, subtotal - discount_amount) AS DECIMAL(18,2)) * 0.0825, 2)) > 0.01) AS tax_violations,
       count(*) FILTER (total_amount <= 0) AS non_positive_totals FROM stg_orders""",
)
def pricing_violations(spark, sf_dir):
    return quality.pricing_violations(shop(spark, sf_dir).stg_orders)


@query(
    "dq_13_catalog_agreement",
    """
SELECT count(*) AS compared, count(*) FILTER (i.unit_price IS DISTINCT FROM p.price) AS unit_price_mismatches,
       count(*) FILTER (i.unit_cost IS DISTINCT FROM p.cost) AS unit_cost_mismatches FROM stg_order_items i JOIN stg_products p USING (product_id)""",
)
def catalog(spark, sf_dir):
    w = shop(spark, sf_dir)
    return quality.attribute_mismatches(
        w.stg_order_items, "product_id", w.stg_products, {"unit_price": "price", "unit_cost": "cost"}
    )


@query(
    "dq_14_allocation",
    """
WITH a AS (SELECT count(*) FILTER (ab_variant = 'control') AS n1, count(*) FILTER (ab_variant = 'treatment') AS n2 FROM stg_sessions
    WHERE session_id IN (SELECT session_id FROM stg_events WHERE event_type = 'click')),
o AS (SELECT count(*) FILTER (ab_variant = 'control') AS x1, count(*) FILTER (ab_variant = 'treatment') AS x2 FROM stg_orders),
h AS (SELECT *, CAST(n1 + n2 AS DOUBLE) / 2 AS half FROM a, o)
SELECT n1 AS n_control, n2 AS n_treatment, x1 AS conversions_control, x2 AS conversions_treatment,
       round((n1 - half) * (n1 - half) / half + (n2 - half) * (n2 - half) / half, 4) AS srm_chi2,
       round((CAST(x2 AS DOUBLE) / n2 - CAST(x1 AS DOUBLE) / n1) / (CAST(x1 AS DOUBLE) / n1) * 100, 2) AS empirical_relative_lift_pct FROM h""",
    "click",
)
def allocation(spark, sf_dir):
    w = clicks(spark, sf_dir)
    return quality.allocation_check(w.stg_events, w.stg_sessions, w.stg_orders, "click").drop("srm_p_value", "passed")


@query(
    "dq_14_allocation_p_value",
    f"""
WITH a AS (SELECT count(*) FILTER (ab_variant = 'control') AS n1, count(*) FILTER (ab_variant = 'treatment') AS n2 FROM stg_sessions
    WHERE session_id IN (SELECT session_id FROM stg_events WHERE event_type = 'click')),
o AS (SELECT count(*) FILTER (ab_variant = 'control') AS x1, count(*) FILTER (ab_variant = 'treatment') AS x2 FROM stg_orders),
h AS (SELECT *, CAST(n1 + n2 AS DOUBLE) / 2 AS half FROM a, o),
c AS (SELECT n1 AS n_control, n2 AS n_treatment, x1 AS conversions_control, x2 AS conversions_treatment,
       round((n1 - half) * (n1 - half) / half + (n2 - half) * (n2 - half) / half, 4) AS srm_chi2,
       round((CAST(x2 AS DOUBLE) / n2 - CAST(x1 AS DOUBLE) / n1) / (CAST(x1 AS DOUBLE) / n1) * 100, 2) AS empirical_relative_lift_pct FROM h),
x AS (SELECT *, sqrt(srm_chi2 / 2) AS srm_x FROM c), p AS (SELECT * EXCLUDE (srm_x), round({erfc('srm_x')}, 6) AS srm_p_value FROM x)
SELECT *, srm_p_value >= 0.01 AND n_control > 0 AND n_treatment > 0 AS passed FROM p""",
    "click",
)
def allocation_p(spark, sf_dir):
    w = clicks(spark, sf_dir)
    return quality.allocation_check(w.stg_events, w.stg_sessions, w.stg_orders, "click")


@query(
    "dq_15_profit_identity",
    f"""
WITH o AS (SELECT *, round(CAST(gross_profit AS DECIMAL(22,4)), 2) AS p FROM fct_orders)
SELECT count(*) AS orders, count(*) FILTER (p <> subtotal_amount - total_cogs) AS subtotal_mismatches,
       count(*) FILTER (p <> total_amount - tax_amount - shipping_amount + discount_amount - total_cogs) AS total_mismatches,
       {dbl('max(abs(p - (subtotal_amount - total_cogs)))')} AS max_difference, count(*) FILTER (margin_rate < 0 OR margin_rate > 1) AS margins_out_of_bounds FROM o""",
)
def profit(spark, sf_dir):
    return quality.profit_identity(shop(spark, sf_dir).fct_orders)


@query(
    "dq_16_mart_keys",
    f"SELECT * FROM ({suite_sql(('dim_users', 'dim_products', 'fct_user_retention'))}) WHERE kind IN ('unique', 'relationships')",
)
def mart_keys(spark, sf_dir):
    w = shop(spark, sf_dir)
    models = ("dim_users", "dim_products", "fct_user_retention")
    wanted = [c for c in quality.declared_checks(models) if c.kind in ("unique", "relationships")]
    return quality.run_checks({m: w[m] for m in models}, wanted)


@query(
    "dq_17_column_constraints",
    """
SELECT 'stg_order_items' AS "table", 'quantity_positive' AS "column", 'check' AS kind, (SELECT count(*) FROM stg_order_items WHERE quantity <= 0) AS failures, FALSE AS errored, (SELECT count(*) = 0 FROM stg_order_items WHERE quantity <= 0) AS passed
UNION ALL SELECT 'stg_order_items', 'profit_not_negative', 'check', (SELECT count(*) FROM stg_order_items WHERE line_profit < 0), FALSE, (SELECT count(*) = 0 FROM stg_order_items WHERE line_profit < 0)
UNION ALL SELECT 'stg_orders', 'total_not_negative', 'check', (SELECT count(*) FROM stg_orders WHERE total_amount < 0), FALSE, (SELECT count(*) = 0 FROM stg_orders WHERE total_amount < 0)
UNION ALL SELECT 'stg_products', 'price_positive', 'check', (SELECT count(*) FROM stg_products WHERE price <= 0), FALSE, (SELECT count(*) = 0 FROM stg_products WHERE price <= 0)""",
)
def constraints(spark, sf_dir):
    w = shop(spark, sf_dir)
    rules = [
        quality.value_check("stg_order_items", "quantity_positive", F.col("quantity") > 0),
        quality.value_check("stg_order_items", "profit_not_negative", F.col("line_profit") >= 0),
        quality.value_check("stg_orders", "total_not_negative", F.col("total_amount") >= 0),
        quality.value_check("stg_products", "price_positive", F.col("price") > 0),
    ]
    return quality.run_checks({r.table: w[r.table] for r in rules}, rules)


_PAYLOAD = """
req AS (SELECT user_id, CAST(event_id % 5 AS VARCHAR) AS request_key, event_id, '{"event_type":"' || event_type || '","step_number":' || step_number || '}' AS body FROM stg_events),
hashed AS (SELECT *, sha256(body) AS h FROM req),
first AS (SELECT user_id, request_key, arg_min(h, event_id) AS h1 FROM hashed GROUP BY 1, 2)"""


def _requests(spark, sf_dir):
    events = clicks(spark, sf_dir).stg_events
    return events.withColumn("request_key", (F.col("event_id") % 5).cast("string"))


@query(
    "dq_18_first_requests",
    f"""
WITH {_PAYLOAD}
SELECT user_id, request_key, max(h1) AS request_hash, min(event_id) AS first_at, count(*) AS requests, count(*) FILTER (h <> h1) AS conflicts
FROM hashed JOIN first USING (user_id, request_key) GROUP BY 1, 2""",
    "click",
)
def first_requests(spark, sf_dir):
    return quality.first_requests(_requests(spark, sf_dir), "user_id", "request_key", "event_id", ["event_type", "step_number"])


@query(
    "dq_18_conflicts",
    f"WITH {_PAYLOAD} SELECT user_id, request_key, event_id, h AS request_hash, h1 AS first_hash FROM hashed JOIN first USING (user_id, request_key) WHERE h <> h1",
    "click",
)
def conflicts(spark, sf_dir):
    found = quality.conflicting_requests(
        _requests(spark, sf_dir), "user_id", "request_key", "event_id", ["event_type", "step_number"]
    )
    return found.select("user_id", "request_key", "event_id", "request_hash", "first_hash")


@query(
    "dq_18_ledger",
    f"""
WITH {_PAYLOAD},
half AS (SELECT count(*) // 2 AS n FROM stg_events),
arrived AS (SELECT 0 AS batch, h.* FROM hashed h WHERE event_id < (SELECT n FROM half)
  UNION ALL SELECT 1, h.* FROM hashed h WHERE event_id >= (SELECT n FROM half) OR event_id % 10 = 0),
earliest AS (SELECT user_id, request_key, arg_min(struct_pack(b := batch, e := event_id, h := h), struct_pack(b := batch, e := event_id)) AS f FROM arrived GROUP BY ALL)
SELECT CAST(batch AS BIGINT) AS batch, event_id, user_id, request_key,
       CASE WHEN batch = f.b AND event_id = f.e THEN 'first' WHEN h = f.h THEN 'replay' ELSE 'conflict' END AS outcome
FROM arrived JOIN earliest USING (user_id, request_key)""",
    "click",
)
def ledger_outcomes(spark, sf_dir):
    """Two batches; the second brings a tenth of the first again and reuses its keys."""
    from merchlens.streaming.ledger import Ledger

    requests = _requests(spark, sf_dir).select("event_id", "user_id", "request_key", "event_type", "step_number")
    half = requests.agg(F.count(F.lit(1))).first()[0] // 2
    ledger = Ledger(spark, work_dir(spark, "ledger"), "user_id", "request_key", "event_id", ["event_type", "step_number"])
    ledger.add(0, requests.where(F.col("event_id") < half))
    again = requests.where((F.col("event_id") >= half) | (F.col("event_id") % 10 == 0))
    for _ in range(2):  # the second time it is the same batch again
        ledger.add(1, again)
    return ledger.outcomes().select("batch", "event_id", "user_id", "request_key", "outcome")


@query(
    "agg_17_layer_totals",
    f"""
WITH t AS (SELECT 'raw' AS layer, sum(total_amount) AS total FROM raw_orders UNION ALL SELECT 'staging', sum(total_amount) FROM stg_orders
UNION ALL SELECT 'fact', sum(total_amount) FROM fct_orders UNION ALL SELECT 'dimension', sum(lifetime_revenue) FROM dim_users)
SELECT layer, {dbl('total')} AS total, {dbl('(SELECT max(total) - min(total) FROM t)')} AS spread FROM t""",
    "click",
)
def layers(spark, sf_dir):
    w = clicks(spark, sf_dir)
    return quality.layer_totals(
        {
            "raw": (w.raw.orders, "total_amount"),
            "staging": (w.stg_orders, "total_amount"),
            "fact": (w.fct_orders, "total_amount"),
            "dimension": (w.dim_users, "lifetime_revenue"),
        }
    )


@query(
    "agg_18_audit",
    f"SELECT count(*) AS rows, {dbl('sum(total_amount)')} AS total, round({dbl('sum(total_amount)')} / count(*), 2) AS mean FROM fct_orders",
)
def audit(spark, sf_dir):
    return quality.audit(shop(spark, sf_dir).fct_orders)
