from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from merchlens.operators import dimensions, hotkeys
from merchlens.operators.funnel import stage_progression
from merchlens.plans.warehouse import MODELS, Warehouse


@pytest.fixture
def shop(shop_tables):
    return Warehouse(shop_tables, datetime(2024, 5, 1))


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_every_model_builds(shop):
    for model in MODELS:
        assert shop[model].columns, model
    with pytest.raises(KeyError):
        shop["unknown"]


def test_staging_cleans(shop):
    users = by(shop.stg_users, "user_id")
    assert set(users) == {"USR-1", "USR-2", "USR-3", "USR-4"}
    assert users["USR-1"].country == "US" and users["USR-1"].customer_segment == "VIP"
    assert users["USR-1"].cohort_month == date(2024, 1, 1)
    sessions = by(shop.stg_sessions, "session_id")
    assert sessions["SES-1"].session_duration_seconds == 70
    assert sessions["SES-2"].session_duration_seconds == 0  # ends before it starts
    assert sessions["SES-2"].ab_variant == "treatment"
    events = by(shop.stg_events, "event_id")
    assert events["EVT-1"].product_id is None and events["EVT-1"].cart_value == 0
    assert events["EVT-1"].event_type == "landing_page"
    orders = by(shop.stg_orders, "order_id")
    assert orders["ORD-2"].tax_amount == 0 and orders["ORD-1"].status == "completed"
    products = by(shop.stg_products, "product_id")
    assert products["PRD-0"].margin_rate is None and products["PRD-1"].margin_rate == pytest.approx(0.6)
    items = by(shop.stg_order_items, "order_item_id")
    assert items["ITM-1"].total_item_price == Decimal("10.00")


def test_session_funnel_default_stages(shop):
    funnel = by(shop.int_session_funnel_events, "session_id")
    one = funnel["SES-1"]
    assert one.funnel_stage_reached == "6_purchase" and one.reached_purchase == 1 and one.total_events_count == 6
    assert one.first_checkout_at == datetime(2024, 2, 2, 0, 0, 20)
    three = funnel["SES-3"]
    assert three.has_checkout_started and not three.has_product_view and three.furthest_step_reached == 4


def test_order_summary_and_profit_fallback(shop):
    summary = by(shop.int_user_order_summary, "user_id")
    one = summary["USR-1"]
    assert one.lifetime_orders == 3 and one.lifetime_revenue == Decimal("165.73")
    # 6 + 26 from items, 40 % of 100 for the order without items
    assert one.lifetime_gross_profit == Decimal("72.0000")
    assert one.avg_days_between_orders == pytest.approx((date(2024, 4, 1) - date(2024, 2, 2)).days / 2)
    assert summary["USR-2"].avg_days_between_orders is None


def test_order_fact(shop):
    fact = by(shop.fct_orders, "order_id")
    assert [fact[f"ORD-{i}"].user_order_sequence for i in (1, 2, 3)] == [1, 2, 3]
    assert fact["ORD-2"].days_since_prior_order == 18 and fact["ORD-1"].days_since_prior_order is None
    assert fact["ORD-3"].gross_profit == Decimal("40.0000") and fact["ORD-3"].margin_rate == 0.4
    assert fact["ORD-3"].device_type is None and fact["ORD-3"].total_items_count == 1
    assert fact["ORD-2"].primary_product_category == "Home"
    # sequence counts orders of every status
    assert fact["ORD-5"].user_order_sequence == 2 and fact["ORD-5"].is_repeat_order


def test_funnel_fact_keeps_sessions_without_user_or_order(shop):
    fact = by(shop.fct_funnel, "session_id")
    assert fact["SES-4"].customer_segment == "Regular" and fact["SES-4"].country == "US"
    assert fact["SES-4"].funnel_stage_reached == "0_none" and fact["SES-4"].is_converting_session == 0
    assert fact["SES-1"].order_revenue == Decimal("15.73")


def test_since_limits_rows_but_not_the_sequence(shop_tables):
    recent = Warehouse(shop_tables, date(2024, 5, 1), orders_since=datetime(2024, 2, 20)).fct_orders
    got = {r.order_id: r.user_order_sequence for r in recent.collect()}
    assert got == {"ORD-2": 2, "ORD-3": 3, "ORD-4": 1, "ORD-5": 2}


def exchanges(df):
    """(what rows are dealt by, columns of the rows) of every shuffle."""
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "Exchange":
            found.append((node.outputPartitioning().toString(), node.output().mkString(" ")))
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_order_fact_deals_out_keys_only(spark, shop_tables):
    """By user and by session go keys and what was found by them; the money and the items go by order alone."""
    wanted = sorted(map(repr, Warehouse(shop_tables, datetime(2024, 5, 1)).fct_orders.collect()))
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        fact = Warehouse(shop_tables, datetime(2024, 5, 1)).fct_orders
        dealt = exchanges(fact)
        hot = Warehouse(shop_tables, datetime(2024, 5, 1), hot_rows=1).fct_orders
        got = [sorted(map(repr, df.collect())) for df in (fact, hot)]
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    by_others = [columns for by, columns in dealt if "user_id" in by or "session_id" in by]
    assert len(by_others) >= 4  # orders and users, orders and sessions
    assert not [c for c in by_others if "total_amount" in c or "payment_method" in c or "gross_profit" in c]
    assert got == [wanted, wanted]


def test_items_go_by_product_and_by_order_once(spark, shop):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        made = shop.int_order_items_aggregated
        keys = sorted("order_id" in dealt for dealt, _ in exchanges(made))
        got = by(made, "order_id")
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert keys == [False, False, True]  # items and catalog by product, sums by order
    assert got["ORD-2"].distinct_products_count == 2 and got["ORD-2"].primary_product_category == "Home"
    assert got["ORD-2"].gross_profit == Decimal("26.00") and got["ORD-1"].total_items_count == 1


def test_rfm_classes(shop):
    users = by(shop.dim_users, "user_id")
    assert users["USR-1"].frequency_band == "2-3 Orders" and users["USR-1"].monetary_tier == "Tier 2: Mid Value"
    assert users["USR-1"].customer_lifecycle_status == "Active Repeat" and users["USR-1"].recency_days == 30
    assert users["USR-2"].customer_lifecycle_status == "Single Purchaser"
    assert users["USR-3"].frequency_band == "0 Orders" and users["USR-3"].monetary_tier == "Tier 0: Non-Buyer"
    assert users["USR-3"].recency_days == (date(2024, 5, 1) - date(2024, 1, 3)).days
    assert users["USR-1"].lifetime_sessions == 2


@pytest.mark.parametrize("idle,expected", [(60, "Active Repeat"), (61, "Dormant Repeat"), (120, "Dormant Repeat"), (121, "Churned Repeat")])
def test_lifecycle_edges(spark, idle, expected):
    df = spark.range(1).select(dimensions.lifecycle(F.lit(2), F.lit(idle)).alias("s"))
    assert df.first().s == expected


@pytest.mark.parametrize("spent,tier", [("0", 0), ("99.99", 1), ("100", 2), ("300", 3), ("749.99", 3), ("750", 4)])
def test_tier_edges(spark, spent, tier):
    value = F.lit(spent).cast("decimal(18,2)")
    assert spark.range(1).select(dimensions.monetary_tier(value).alias("t")).first().t == dimensions.MONETARY_TIERS[tier]


def test_retention_fact_runs_up(shop):
    got = [(r.month_offset, r.cumulative_orders, r.cumulative_revenue) for r in shop.fct_user_retention.orderBy("user_id", "activity_month").collect()]
    assert got == [(0, 2, Decimal("65.73")), (2, 3, Decimal("165.73")), (0, 1, Decimal("200.00"))]


def test_experiment_keeps_entered_sessions(shop):
    fact = by(shop.fct_ab_test, "session_id")
    assert set(fact) == {"SES-1", "SES-3"}
    assert fact["SES-1"].completed_purchase == 1 and fact["SES-3"].completed_payment == 0
    assert fact["SES-3"].order_revenue == Decimal("200.00") and fact["SES-3"].days_since_user_signup == 59


def test_default_calendar(spark):
    days = dimensions.dim_date(spark)
    assert days.count() == 1096
    row = days.where(F.col("date_day") == date(2024, 1, 6)).first()
    assert row.is_weekend and row.quarter_name == "Q1 2024" and row.day_short == "Sat" and row.date_key == 20240106


def test_progression_on_empty_input(spark, shop):
    nothing = stage_progression(shop.fct_funnel.where(F.lit(False)))
    first = nothing.orderBy("stage_order").first()
    assert first.sessions_entered == 0 and first.overall_conversion_rate_pct is None


def brute_sequence(data):
    out, seen = {}, {}
    for user, at, key, amount in sorted(data, key=lambda r: (str(r[0]), r[1], r[2])):
        n, last, total = seen.get(user, (0, None, 0))
        out[key] = (n + 1, last, total + amount)
        seen[user] = (n + 1, at, total + amount)
    return out


@pytest.mark.parametrize("hot_rows", [0, 3, 10**6])
def test_sequence_matches_brute_force_for_hot_and_null_keys(spark, hot_rows):
    days = [datetime(2024, 1, 1 + (i * 7) % 5, i % 3) for i in range(40)]
    users = ["hot" if i % 3 else None if i % 2 else f"u{i % 4}" for i in range(40)]
    data = [(users[i], days[i], i, i) for i in range(40)]
    df = spark.createDataFrame(data, "user string, at timestamp_ntz, id int, amount int")
    result = hotkeys.sequence_rows(
        df, "user", ["at", "id"], sequence="n", previous={"at": "before"}, running={"amount": "total"}, hot_rows=hot_rows
    )
    got = {r.id: (r.n, r.before, r.total) for r in result.collect()}
    assert got == brute_sequence(data)


def test_parts_of_a_hot_key_are_even_within_one_minute(spark):
    """Nine tenths of the rows are one key's, all in one minute, most in one instant."""
    n = 40_000
    at = F.expr("timestamp_ntz'2024-01-01 10:00:00' + make_dt_interval(0, 0, 0, cast(if(id % 4 = 0, id % 60, 7) as decimal(18,6)))")
    df = spark.range(n).select(F.when(F.col("id") % 10 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), at.alias("at"), "id")
    bounds = hotkeys.hot_bounds(df, "k", ["at", "id"], hot_rows=1000)
    placed = hotkeys.place_rows(df, "k", ["at", "id"], bounds)
    sizes = sorted(r["count"] for r in placed.where("k = 'hot'").groupBy("__part").count().collect())
    assert len(sizes) == 36 and sum(sizes) == 36_000 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    assert placed.where("k <> 'hot' AND __part IS NOT NULL").isEmpty()
    got = hotkeys.sequence_rows(df, "k", ["at", "id"], sequence="n", previous={"id": "before"}, running={"id": "total"}, hot_rows=1000)
    expected = df.selectExpr(
        "id",
        "row_number() over (partition by k order by at, id) n",
        "lag(id) over (partition by k order by at, id) before",
        "sum(id) over (partition by k order by at, id rows unbounded preceding) total",
    )
    assert got.select("id", "n", "before", "total").exceptAll(expected.select("id", F.col("n").cast("bigint"), "before", "total")).isEmpty()


@pytest.mark.parametrize("hot_rows", [0, 5, 10**6])
def test_fan_out_join_matches_plain_left_join(spark, hot_rows):
    left = spark.createDataFrame([(k, i) for i, k in enumerate(["a", "b", "c", None, "d"])], "k string, l int")
    right = spark.createDataFrame([("a", i) for i in range(30)] + [("b", 99), (None, 7), ("z", 8)], "k string, r int")
    plain = sorted(map(tuple, left.join(right, "k", "left").select("k", "l", "r").collect()), key=repr)
    spread = hotkeys.fan_out_join(left, right, "k", hot_rows=hot_rows, salts=4).select("k", "l", "r")
    assert sorted(map(tuple, spread.collect()), key=repr) == plain


def test_a_long_hot_list_is_not_broadcast(spark):
    """With every key hot the list is as long as the keys: above Spark's threshold it goes through shuffles."""
    df = spark.range(400).selectExpr("id", "id % 50 AS k", "id % 7 AS v")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        got = hotkeys.sequence_rows(df, "k", ["id"], running={"v": "total"}, hot_rows=0)
        spread = hotkeys.fan_out_join(spark.range(60).withColumnRenamed("id", "k"), df, "k", hot_rows=0, salts=3)
        for made in (got, spread):
            assert "BroadcastHashJoin" not in made._jdf.queryExecution().executedPlan().toString()
        expected = df.selectExpr("id", "k", "v", "sum(v) over (partition by k order by id rows unbounded preceding) total")
        assert got.exceptAll(expected).isEmpty() and got.count() == 400 and spread.count() == 410
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_hot_list_is_bounded(spark):
    df = spark.range(1000).select((F.col("id") % 500).alias("k"))
    assert hotkeys.hot_keys(df, ["k"], hot_rows=1).count() == 500
    assert hotkeys.hot_keys(df, ["k"], hot_rows=2).count() == 0
