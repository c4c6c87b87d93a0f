from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from merchlens.operators import experiment, funnel, measures, retention
from merchlens.operators.sessions import STAGES
from merchlens.plans import reports

FLAGS = [s.reached for s in STAGES]


@pytest.fixture
def hundred(spark):
    """100 sessions reaching the stages 100, 80, 50, 30, 20 and 15 times."""
    reached = (100, 80, 50, 30, 20, 15)
    flags = [F.when(F.col("id") < n, 1).otherwise(0).alias(name) for n, name in zip(reached, FLAGS)]
    return spark.range(100).select(
        F.concat(F.lit("s"), "id").alias("session_id"), F.when(F.col("id") < 60, "Desktop").otherwise("Mobile").alias("device_type"), *flags
    )


def test_evaluate_funnel(hundred):
    rows = {r.step_number: r for r in funnel.evaluate_funnel(hundred).collect()}
    assert [rows[i].sessions_count for i in range(1, 7)] == [100, 80, 50, 30, 20, 15]
    assert rows[2].step_conversion_rate == 80.0 and rows[6].overall_conversion_rate == 15.0
    assert rows[3].absolute_drop_off == 30 and rows[3].drop_off_rate == 37.5
    assert funnel.top_drop_off(funnel.evaluate_funnel(hundred)).first()[0] == "add_to_cart"


def test_null_flags_count_as_not_reached(spark):
    df = spark.createDataFrame([(1, 1, None), (1, None, None), (None, None, None)], ", ".join(f"{c} int" for c in FLAGS[:3]))
    counts = [r.sessions_count for r in funnel.evaluate_funnel(df).orderBy("step_number").collect()]
    assert counts == [2, 1, 0, 0, 0, 0]


def test_empty_funnel_gives_zero_rows_per_stage(hundred):
    rows = funnel.evaluate_funnel(hundred.where("false")).collect()
    assert len(rows) == 6 and all(r.sessions_count == 0 and r.step_conversion_rate == 0.0 for r in rows)


def test_rising_funnel_clamps_or_stays_signed(spark):
    df = spark.createDataFrame([("a", 0, 1), ("b", 1, 1)], "session_id string, reached_landing_page int, reached_product_view int")
    clamped = {r.step_number: r for r in funnel.evaluate_funnel(df, STAGES[:2]).collect()}
    assert clamped[2].absolute_drop_off == 0 and clamped[2].drop_off_rate == 0.0
    events = spark.createDataFrame([("a", "product_view"), ("b", "product_view"), ("b", "landing_page")], "session_id string, event_type string")
    signed = {r.step_number: r for r in funnel.compute_funnel_metrics(events, df.select("session_id"), STAGES[:2]).collect()}
    assert signed[2].absolute_drop_off == -1 and signed[2].drop_off_rate == -100.0


def test_slices_drop_null_values(hundred):
    masked = hundred.withColumn("country", F.when(F.col("device_type") == "Mobile", "US"))
    got = {(r.dimension, r.value): r.sessions_count for r in funnel.evaluate_slices(masked).where("step_number = 1").collect()}
    assert got == {("overall", "overall"): 100, ("device_type", "Desktop"): 60, ("device_type", "Mobile"): 40, ("country", "US"): 40}


def test_leaks_and_labels(hundred):
    first = funnel.leak_ranking(hundred).orderBy("leak_severity_rank", "stage_transition").first()
    assert first.stage_transition == "2. Product View -> Add to Cart" and first.lost_sessions == 30
    names = {r.stage_transition for r in funnel.leak_ranking(hundred).collect()}
    assert "5. Payment Started -> Purchase Completed" in names


def cohort(spark):
    data = [(f"u{i}", "2024-01-01", k, 10.0) for k, n in ((0, 10), (1, 5), (2, 2)) for i in range(n)]
    df = spark.createDataFrame(data, "user_id string, cohort_month string, month_offset int, revenue_in_month double")
    return df


def test_cohort_retention(spark):
    rates = retention.compute_cohort_retention(cohort(spark))
    assert {r.month_offset: r.retention_rate for r in rates.collect()} == {0: 100.0, 1: 50.0, 2: 20.0}
    assert retention.retention_invariants(rates).first().asDict() == {
        "month_0_is_100_percent": True,
        "decay_monotonic_vs_m0": True,
        "all_decay_monotonic": True,
        "cohort_count": 1,
    }


def test_cohort_without_first_month_uses_all_its_users(spark):
    late = cohort(spark).where("month_offset > 0")
    rates = retention.compute_cohort_retention(late)
    assert {r.month_offset: r.retention_rate for r in rates.collect()} == {1: 100.0, 2: 40.0}
    assert not retention.retention_invariants(rates).first().month_0_is_100_percent


def test_empty_cohorts_hold_every_invariant(spark):
    row = retention.retention_invariants(retention.compute_cohort_retention(cohort(spark).where("false"))).first()
    assert row.month_0_is_100_percent and row.all_decay_monotonic and row.cohort_count == 0


def test_repeat_rate_and_its_fallback(spark):
    orders = spark.createDataFrame(
        [("a", 1, "completed"), ("a", 2, "completed"), ("b", 3, "completed"), ("b", 4, "completed"), ("c", 5, "completed"), ("c", 6, "pending")],
        "user_id string, order_id int, status string",
    )
    row = retention.repeat_purchase_rate(orders, []).first()
    assert (row.total_users, row.repeat_users, row.repeat_purchase_rate) == (3, 2, 66.67)
    none_done = orders.withColumn("status", F.lit("pending"))
    assert retention.repeat_purchase_rate(none_done, []).first().repeat_users == 3


def test_ltv_curves(spark):
    curve = {r.month_offset: r.cumulative_ltv for r in retention.ltv_curves(cohort(spark)).collect()}
    assert curve == {0: 10.0, 1: 15.0, 2: 17.0}


def counts(spark, n_c, x_c, n_t, x_t):
    return spark.createDataFrame([(n_c, x_c, n_t, x_t)], "n_c bigint, x_c bigint, n_t bigint, x_t bigint")


def test_published_experiment(spark):
    row = experiment.evaluate_counts(counts(spark, 8151, 4769, 8279, 5253)).first()
    assert row.conversion_rate_control == pytest.approx(0.585081585, abs=1e-9)
    assert row.conversion_rate_treatment == pytest.approx(0.634496920, abs=1e-9)
    assert row.absolute_difference == pytest.approx(0.049415335, abs=1e-9)
    assert row.relative_lift == pytest.approx(0.084458879, abs=1e-9)
    assert row.pooled_se == pytest.approx(0.007610712, abs=1e-9)
    assert row.z_score == pytest.approx(6.492866319, abs=1e-8)
    assert row.p_value == pytest.approx(8.4218e-11, rel=1e-4)
    assert row.ci_abs_lower == pytest.approx(0.034515110, abs=1e-8)
    assert row.ci_abs_upper == pytest.approx(0.064315560, abs=1e-8)
    assert row.ci_rel_lower == pytest.approx(0.058991961, abs=1e-8)
    assert row.ci_rel_upper == pytest.approx(0.109925797, abs=1e-8)
    assert row.srm_chi2_statistic == pytest.approx(0.997200243, abs=1e-8)
    assert row.srm_p_value == pytest.approx(0.317988917, abs=1e-8)
    assert row.srm_passed and row.statistically_significant
    assert experiment.decision(experiment.evaluate_counts(counts(spark, 8151, 4769, 8279, 5253))).first().recommendation.startswith("DEPLOY")


@pytest.mark.parametrize("arms", [(0, 0, 0, 0), (100, 0, 100, 0), (0, 0, 10, 5), (50, 50, 50, 50)])
def test_degenerate_arms_never_fail(spark, arms):
    row = experiment.evaluate_counts(counts(spark, *arms)).first()
    assert row.z_score == 0.0 and row.p_value == 1.0 and not row.statistically_significant


def test_allocation_edges(spark):
    def srm(n_c, n_t, **options):
        return experiment.evaluate_counts(counts(spark, n_c, 0, n_t, 0), **options).first()

    assert srm(50_000, 50_000).srm_p_value == 1.0 and srm(0, 0).srm_passed
    assert not srm(40_000, 60_000).srm_passed
    impossible = srm(10, 10, share=1.0)
    assert impossible.srm_chi2_statistic == 999.0 and not impossible.srm_passed


def test_negative_lift_is_not_deployed(spark):
    tested = experiment.evaluate_counts(counts(spark, 1000, 600, 1000, 400))
    assert tested.first().statistically_significant
    assert experiment.decision(tested).first().recommendation.startswith("DO NOT")
    assert experiment.decision(tested, need_positive=False).first().recommendation.startswith("DEPLOY")


def test_slices_of_rows(spark):
    rows = [("control", i < 100, "Mobile") for i in range(1000)] + [("treatment", i < 120, None) for i in range(1000)]
    df = spark.createDataFrame(rows, "variant string, reached_purchase boolean, device_type string")
    got = {(r.dimension, r.value): r for r in experiment.compute_ab_test(df).collect()}
    assert got[("overall", "overall")].relative_lift == pytest.approx(0.20)
    assert set(got) == {("overall", "overall"), ("device_type", "Mobile")}
    with pytest.raises(KeyError):
        experiment.compute_ab_test(df.drop("reached_purchase"))


def test_impact_scales_with_lift(spark):
    rows = {r.scenario: r for r in experiment.revenue_impact(counts(spark, 8151, 4769, 8279, 5253), 100_000, 119.82, 0.52).collect()}
    assert rows["low"].incremental_orders < rows["expected"].incremental_orders < rows["high"].incremental_orders
    assert rows["expected"].incremental_orders == pytest.approx(4941.53, abs=0.01)
    assert rows["expected"].incremental_profit == pytest.approx(rows["expected"].incremental_revenue * 0.52, abs=0.01)


def test_library_is_complete():
    assert len(measures.measure_names()) == 78
    assert len(measures.library()) == 78 + len(measures.PARTS)


def fact(spark):
    return spark.createDataFrame(
        [("o1", "completed", 10.0, True, "A"), ("o1", "completed", 5.0, True, "A"), ("o2", "pending", 7.0, False, "A"), ("o3", None, 1.0, False, "B")],
        "order_id string, status string, subtotal_amount double, is_first_order boolean, customer_segment string",
    ).withColumn("subtotal_amount", F.col("subtotal_amount").cast("decimal(18,2)")).withColumn("is_repeat_order", ~F.col("is_first_order"))


def test_measures_share_one_aggregate(spark):
    tables = {"fct_orders": fact(spark)}
    got = {r.customer_segment: r for r in measures.measures(tables, ["Gross Revenue", "Total Orders", "Average Order Value (AOV)"], ["customer_segment"]).collect()}
    assert float(got["A"].gross_revenue) == 22.0 and got["A"].total_orders == 1 and got["A"].average_order_value_aov == 22.0
    assert got["B"].total_orders == 1  # a missing status counts as completed
    share = measures.measures(tables, ["Returning User Order Share %"], filters={"customer_segment": "B"}).first()
    assert share[0] == 1.0


def test_measures_refuse_what_they_cannot_answer(spark):
    with pytest.raises(ValueError):
        measures.measures({"fct_orders": fact(spark)}, ["MoM Revenue Growth %"])
    with pytest.raises(KeyError):
        measures.measures({"fct_orders": fact(spark)}, ["Gross Revenue"], ["device_type"])


def test_constants_need_no_fact(spark):
    row = measures.measures({"fct_orders": fact(spark)}, ["Divide Safe Helper", "Chi-Square Critical Value 99%"]).first()
    assert tuple(row) == (1.0, 6.6349)


def test_future_months_are_blank(spark):
    from datetime import date

    tables = {
        "fct_user_retention": spark.createDataFrame([("u", 0, 1, 1), ("u", 1, 1, 1)], "user_id string, month_offset int, is_retained int, is_active int"),
        "dim_date": spark.createDataFrame([(date(2024, 1, 1),)], "date_day date"),
    }
    assert measures.measures(tables, ["M1 Retention Rate %"], as_of=date(2024, 6, 1)).first()[0] == 1.0
    assert measures.measures(tables, ["M1 Retention Rate %"], as_of=date(2023, 6, 1)).first()[0] is None


def test_moving_average_divides_by_days_there_are(spark):
    from datetime import date

    orders = spark.createDataFrame([(date(2024, 1, 1), 10.0), (date(2024, 1, 3), 20.0)], "order_date date, subtotal_amount double")
    got = [r.revenue_7_day_moving_avg for r in measures.daily_trend(orders).orderBy("order_date").collect()]
    assert got == [10.0, 5.0, 10.0]


def test_growth_needs_the_month_before(spark):
    from datetime import date

    orders = spark.createDataFrame([(date(2024, 1, 5), 10.0), (date(2024, 3, 5), 20.0), (date(2024, 4, 5), 30.0)], "order_date date, subtotal_amount double")
    got = [r.mom_revenue_growth_pct for r in measures.monthly_growth(orders).orderBy("month").collect()]
    assert got == [None, None, 0.5]


def test_master_summary_is_one_row(spark, shop_tables):
    from datetime import date

    from merchlens.plans.warehouse import Warehouse

    w = Warehouse(shop_tables, date(2024, 5, 1))
    row = reports.statistical_summary(w.fct_funnel, w.fct_user_retention, w.stg_orders, w.fct_ab_test).collect()
    assert len(row) == 1
    assert row[0].total_sessions == 4 and row[0].total_cohorts == 2 and row[0].n_control == 2
    assert row[0].recommendation.startswith("DO NOT DEPLOY")


def test_trend_of_sparse_slices_against_brute_force(spark):
    """Gaps longer than a window, slices that start late, repeated days and a null slice."""
    from datetime import date, timedelta

    start = date(2024, 1, 1)
    rows = [("a", 0, 10), ("a", 2, 20), ("a", 2, 5), ("a", 30, 7), ("b", 12, 3), ("b", 13, 4), (None, 40, 9), ("c", 5, None)]
    orders = spark.createDataFrame(
        [(s, start + timedelta(d), v) for s, d, v in rows] + [("a", None, 50)], "s string, order_date date, subtotal_amount int"
    ).withColumn("subtotal_amount", F.col("subtotal_amount").cast("decimal(18,2)"))
    expected = {}
    for s in {s for s, _, _ in rows}:
        for day in range(41):
            within = [sum(v or 0 for t, d, v in rows if t == s and day - k < d <= day) for k in (3, 10)]
            own = sum(v or 0 for t, d, v in rows if t == s and d == day)
            expected[s, day] = (own, within[0] / min(3, day + 1), within[1] / min(10, day + 1))

    def got(**kwargs):
        out = measures.daily_trend(orders, (3, 10), ["s"], **kwargs).collect()
        values = {(r.s, (r.order_date - start).days): tuple(map(float, r[2:])) for r in out}
        assert len(values) == len(out)
        return flat(values)

    def flat(values):
        return {(*key, i): v for key, three in values.items() for i, v in enumerate(three)}

    assert got() == pytest.approx(flat(expected))
    own_days = {(s, d) for s, d, _ in rows}
    assert got(every_day=False) == pytest.approx(flat({key: expected[key] for key in own_days}))
    assert measures.daily_trend(orders.limit(0), (3, 10), ["s"]).count() == 0


def cube_rows(spark):
    """Orders that come again in other slices, without an id, and a slice that counts none."""
    rows = [(f"o{i % 70}", "completed" if i % 3 else "pending", i, i % 5 == 0, "AB"[i % 2], i % 4) for i in range(200)]
    rows += [(None, "completed", 11, True, "A", 1), (None, None, 12, False, None, 9), ("x", "pending", 13, True, "C", 2)]
    return spark.createDataFrame(
        rows, "order_id string, status string, subtotal_amount int, is_first_order boolean, customer_segment string, day int"
    ).withColumns({"subtotal_amount": F.col("subtotal_amount").cast("decimal(18,2)"), "is_repeat_order": ~F.col("is_first_order")})


CUBE_NAMES = ["Gross Revenue", "Total Orders", "Average Order Value (AOV)", "Returning User Order Share %"]


def test_cube_answers_like_the_fact(spark):
    """Any coarser slice, a filter and a range; batches that share orders and slices count an order once."""
    from merchlens.operators.cubes import number_entities

    rows, slices = cube_rows(spark), ["day", "customer_segment"]
    numbers, cube = None, None
    for i in range(2):
        batch = rows.where(F.pmod(F.hash("subtotal_amount"), F.lit(2)) == i)
        numbers = number_entities(batch, "order_id", slices, numbers)
        part = measures.measure_cube(batch, "fct_orders", CUBE_NAMES, slices, numbers)
        cube = part if cube is None else cube.merged(part)
    assert numbers.count() == numbers.select("number").distinct().count() == numbers.select("order_id").distinct().count() == 71

    def answers(table, by, filters=None):
        return sorted(map(repr, measures.measures({"fct_orders": table}, CUBE_NAMES, by, filters).collect()))

    for table in (cube, cube.compacted()):
        for by in ([], ["customer_segment"], ["day"], slices):
            assert answers(table, by) == answers(rows, by)
        assert answers(table, ["day"], {"customer_segment": "A"}) == answers(rows, ["day"], {"customer_segment": "A"})
        assert answers(table.where(F.col("day") >= 2), []) == answers(rows.where(F.col("day") >= 2), [])
    assert cube.compacted().frame.count() == cube.frame.select("__bucket", *slices).distinct().count()


def test_cube_refuses_what_it_does_not_keep(spark):
    from merchlens.operators.cubes import number_entities

    rows = cube_rows(spark)
    cube = measures.measure_cube(rows, "fct_orders", ["Total Orders"], ["day"], number_entities(rows, "order_id", ["day"]))
    with pytest.raises(KeyError):
        measures.measures({"fct_orders": cube}, ["Total Orders"], ["customer_segment"])
    with pytest.raises(KeyError):
        measures.measures({"fct_orders": cube}, ["Total Orders"], filters={"customer_segment": "A"})
    with pytest.raises(KeyError):
        measures.measures({"fct_orders": cube}, ["Gross Revenue"])
    with pytest.raises(ValueError):
        cube.merged(measures.measure_cube(rows, "fct_orders", ["Gross Revenue"], ["day"], number_entities(rows, "order_id", ["day"])))
    empty = rows.limit(0)
    none = measures.measure_cube(empty, "fct_orders", ["Total Orders"], ["day"], number_entities(empty, "order_id", ["day"]))
    assert measures.measures({"fct_orders": none}, ["Total Orders"]).first().total_orders == 0
