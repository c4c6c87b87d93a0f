"""A/B experiments: allocation check, z-test, intervals, slices, decision, impact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchlens.functions.scalar import flag, is_set, pct, require_column, safe_divide
from merchlens.functions.stats import chi_square, chi_square_p, pooled_se, two_sided_p, unpooled_se, z_critical
from merchlens.operators.funnel import slice_rows

# Fixed values.
ALPHA = 0.05
SRM_ALPHA = 0.01
CONTROL_SHARE = 0.5
SRM_CRITICAL = 6.635
Z_INTERVAL = 1.95996
Z_DECISION = 1.96
UNBALANCED_CHI2 = 999.0
CONVERSION_COLUMNS = ("completed_purchase", "converted_to_purchase", "is_converting_session", "reached_purchase")
SRM_VERDICTS = (
    "PASS: No SRM Detected (Allocation Balanced)",
    "FAIL: Sample Ratio Mismatch Detected (Invalid Experiment)",
)
TEST_VERDICTS = (
    "REJECT H0: Statistically Significant (p < 0.05)",
    "FAIL TO REJECT H0: Not Statistically Significant",
)
DECISIONS = (
    "DEPLOY TREATMENT: Statistically significant positive lift observed without SRM.",
    "DO NOT DEPLOY: Results inconclusive or SRM detected.",
)


def _arm(name: str, variant: str = "ab_variant") -> Column:
    return F.coalesce(F.col(variant) == name, F.lit(False))


def arm_counts(
    fact: DataFrame, by: Sequence = (), variant: str = "ab_variant", conversion: str = "completed_purchase"
) -> DataFrame:
    """Rows and conversions per arm: one combining aggregate."""
    won = is_set(fact, conversion)
    control, treatment = _arm("control", variant), _arm("treatment", variant)
    return fact.groupBy(*by).agg(
        F.count_if(control).alias("n_c"),
        F.count_if(control & won).alias("x_c"),
        F.count_if(treatment).alias("n_t"),
        F.count_if(treatment & won).alias("x_t"),
    )


def variant_summary(fact: DataFrame) -> DataFrame:
    """Distinct sessions, conversions and rate per arm."""
    per_session = fact.groupBy("ab_variant", "session_id").agg(
        F.max(flag(is_set(fact, "completed_purchase"))).alias("won")
    )
    known = F.col("session_id").isNotNull()
    totals = per_session.groupBy("ab_variant").agg(
        F.count("session_id").alias("sample_size"),
        F.coalesce(F.sum(F.when(known, F.col("won"))), F.lit(0)).alias("conversions"),
    )
    rate = F.round(safe_divide("conversions", "sample_size"), 6)
    return totals.withColumn("conversion_rate", rate).withColumn(
        "conversion_rate_pct", F.round(F.col("conversion_rate") * 100.0, 2)
    )


def srm_check(fact: DataFrame) -> DataFrame:
    """Chi-square of a 50/50 allocation, verdict at the 1 % critical value."""
    counts = fact.agg(
        F.count_if(_arm("control")).alias("n_control"),
        F.count_if(_arm("treatment")).alias("n_treatment"),
        F.count(F.lit(1)).alias("n_total"),
    )
    half = F.col("n_total") / 2.0
    chi2 = F.round(chi_square([F.col("n_control"), F.col("n_treatment")], [half, half]), 4)
    balanced, broken = SRM_VERDICTS
    return counts.withColumn("chi2_statistic", chi2).withColumn(
        "srm_verdict", F.when(F.col("chi2_statistic") < SRM_CRITICAL, balanced).otherwise(broken)
    )


def z_test(fact: DataFrame) -> DataFrame:
    """Two-proportion test with lifts and 95 % intervals, rounded for reporting."""
    n_c, x_c, n_t, x_t = (F.col(c) for c in ("n_c", "x_c", "n_t", "x_t"))
    rates = arm_counts(fact).withColumns({"p_c": safe_divide(x_c, n_c), "p_t": safe_divide(x_t, n_t)})
    p_c, p_t = F.col("p_c"), F.col("p_t")
    lift = p_t - p_c
    stats = rates.withColumns(
        {
            "lift": lift,
            "relative": safe_divide(lift, p_c),
            "z": safe_divide(lift, pooled_se(x_c, n_c, x_t, n_t)),
            "margin": unpooled_se(p_c, n_c, p_t, n_t) * Z_INTERVAL,
        }
    )
    margin, relative, z = F.col("margin"), F.col("relative"), F.col("z")
    relative_margin = safe_divide(margin, p_c)
    reject, keep = TEST_VERDICTS
    return stats.select(
        n_c.alias("control_sessions"),
        x_c.alias("control_conversions"),
        F.round(p_c * 100.0, 2).alias("control_conversion_rate_pct"),
        n_t.alias("treatment_sessions"),
        x_t.alias("treatment_conversions"),
        F.round(p_t * 100.0, 2).alias("treatment_conversion_rate_pct"),
        F.round(F.col("lift") * 100.0, 2).alias("absolute_lift_pct_pts"),
        F.round(relative * 100.0, 2).alias("relative_lift_pct"),
        F.round(z, 4).alias("z_score"),
        F.round((F.col("lift") - margin) * 100.0, 2).alias("ci_abs_lower_pct"),
        F.round((F.col("lift") + margin) * 100.0, 2).alias("ci_abs_upper_pct"),
        F.round((relative - relative_margin) * 100.0, 2).alias("ci_rel_lower_pct"),
        F.round((relative + relative_margin) * 100.0, 2).alias("ci_rel_upper_pct"),
        F.when(F.abs(z) >= Z_DECISION, reject).otherwise(keep).alias("statistical_conclusion"),
    )


def covariate_balance(fact: DataFrame, dimension: str = "device_type") -> DataFrame:
    """Share of each value within each arm, and conversion per value and arm."""
    counts = arm_counts(fact, [dimension])
    # One row per dimension value reaches this window.
    whole = Window.partitionBy()
    return counts.select(
        dimension,
        F.col("n_c").alias("control_sessions"),
        F.col("n_t").alias("treatment_sessions"),
        pct("n_c", F.sum("n_c").over(whole)).alias("control_device_share_pct"),
        pct("n_t", F.sum("n_t").over(whole)).alias("treatment_device_share_pct"),
        pct("x_c", "n_c").alias("control_conv_rate_pct"),
        pct("x_t", "n_t").alias("treatment_conv_rate_pct"),
    )


def daily_lift(fact: DataFrame) -> DataFrame:
    """Conversion per arm and relative lift per day; null where an arm is empty."""
    p_c, p_t = safe_divide("x_c", "n_c"), safe_divide("x_t", "n_t")
    return arm_counts(fact, ["session_date"]).select(
        "session_date",
        F.col("n_c").alias("daily_control_n"),
        F.col("x_c").alias("daily_control_conv"),
        pct("x_c", "n_c").alias("daily_control_conv_rate"),
        F.col("n_t").alias("daily_treatment_n"),
        F.col("x_t").alias("daily_treatment_conv"),
        pct("x_t", "n_t").alias("daily_treatment_conv_rate"),
        F.round(safe_divide((p_t - p_c) * 100.0, p_c), 2).alias("daily_relative_lift_pct"),
    )


def srm_columns(n_c: Column, n_t: Column, share: float = CONTROL_SHARE, alpha: float = SRM_ALPHA) -> dict[str, Column]:
    """Chi-square, p-value and pass flag; an empty sample passes, an impossible arm fails."""
    total = n_c + n_t
    expected = [total * F.lit(share), total * F.lit(1.0 - share)]
    impossible = (expected[0] == 0) | (expected[1] == 0)
    chi2 = (
        F.when(total == 0, 0.0)
        .when(impossible, UNBALANCED_CHI2)
        .otherwise(chi_square([n_c, n_t], expected))
    )
    p = F.when(total == 0, 1.0).when(impossible, 0.0).otherwise(chi_square_p(chi2))
    return {
        "srm_chi2_statistic": chi2,
        "srm_p_value": p,
        "srm_passed": F.when(total == 0, True).when(impossible, False).otherwise(p >= alpha),
    }


def z_columns(
    n_c: Column, x_c: Column, n_t: Column, x_t: Column, alpha: float = ALPHA
) -> list[tuple[str, Column]]:
    """Unrounded test results. Every ratio falls back to 0, so empty arms never fail."""
    zero = F.lit(0.0)
    p_c, p_t = safe_divide(x_c, n_c, 0), safe_divide(x_t, n_t, 0)
    diff = p_t - p_c
    pooled = safe_divide(x_c + x_t, n_c + n_t, 0)
    both = (n_c > 0) & (n_t > 0)
    se = F.when(both & (pooled > 0) & (pooled < 1), pooled_se(x_c, n_c, x_t, n_t)).otherwise(zero)
    spread = F.when(both, unpooled_se(p_c, n_c, p_t, n_t)).otherwise(zero)
    z = safe_divide(diff, se, 0)
    low, high = diff - z_critical(alpha) * spread, diff + z_critical(alpha) * spread
    return [
        ("conversion_rate_control", p_c),
        ("conversion_rate_treatment", p_t),
        ("absolute_difference", diff),
        ("relative_lift", safe_divide(diff, p_c, 0)),
        ("pooled_se", se),
        ("z_score", z),
        ("ci_abs_lower", low),
        ("ci_abs_upper", high),
        ("ci_rel_lower", safe_divide(low, p_c, 0)),
        ("ci_rel_upper", safe_divide(high, p_c, 0)),
    ]


def evaluate_counts(
    counts: DataFrame, alpha: float = ALPHA, srm_alpha: float = SRM_ALPHA, share: float = CONTROL_SHARE
) -> DataFrame:
    """z-test and allocation check for rows holding ``n_c, x_c, n_t, x_t``."""
    arms = [F.col(c) for c in ("n_c", "x_c", "n_t", "x_t")]
    keys = [c for c in counts.columns if c not in ("n_c", "x_c", "n_t", "x_t")]
    tested = counts.select(
        *keys,
        arms[0].alias("n_control"),
        arms[1].alias("conversions_control"),
        arms[2].alias("n_treatment"),
        arms[3].alias("conversions_treatment"),
        *[expr.alias(name) for name, expr in z_columns(*arms, alpha)],
        *[expr.alias(name) for name, expr in srm_columns(arms[0], arms[2], share, srm_alpha).items()],
    )
    return tested.withColumn("p_value", two_sided_p(F.col("z_score"))).withColumn(
        "statistically_significant", F.col("p_value") < alpha
    )


def experiment_columns(fact: DataFrame) -> tuple[str, str]:
    return require_column(fact, ["ab_variant", "variant"]), require_column(fact, CONVERSION_COLUMNS)


def compute_ab_test(
    fact: DataFrame,
    dimensions: Sequence[str] = ("device_type", "country"),
    alpha: float = ALPHA,
    srm_alpha: float = SRM_ALPHA,
    share: float = CONTROL_SHARE,
) -> DataFrame:
    """Test overall and for every value of each dimension, in one pass over the rows."""
    variant, conversion = experiment_columns(fact)
    tagged, keys = slice_rows(fact, [d for d in dimensions if d in fact.columns])
    return evaluate_counts(arm_counts(tagged, keys, variant, conversion), alpha, srm_alpha, share)


def slice_counts(fact: DataFrame, dimensions: Sequence[str] = ("device_type", "country")) -> DataFrame:
    variant, conversion = experiment_columns(fact)
    tagged, keys = slice_rows(fact, [d for d in dimensions if d in fact.columns])
    return arm_counts(tagged, keys, variant, conversion)


def decision(tested: DataFrame, need_positive: bool = True) -> DataFrame:
    """Deploy when significant, the allocation is sound and (by default) the lift is positive."""
    go = F.col("statistically_significant") & F.col("srm_passed")
    if need_positive:
        go = go & (F.col("relative_lift") > 0)
    deploy, hold = DECISIONS
    return tested.withColumn("recommendation", F.when(go, deploy).otherwise(hold))


def decision_from_counts(counts: DataFrame) -> DataFrame:
    """The decision by critical values instead of p-values: plain expressions only."""
    arms = [F.col(c) for c in ("n_c", "x_c", "n_t", "x_t")]
    values = dict(z_columns(*arms))
    half = (arms[0] + arms[2]) / 2.0
    chi2 = chi_square([arms[0], arms[2]], [half, half])
    go = (F.abs(values["z_score"]) >= Z_DECISION) & (values["relative_lift"] > 0) & (chi2 < SRM_CRITICAL)
    deploy, hold = DECISIONS
    return counts.withColumn("recommendation", F.when(go, deploy).otherwise(hold))


def srm_table(fact: DataFrame) -> DataFrame:
    """Observed, expected, difference and chi-square part per arm."""
    counts = fact.groupBy("ab_variant").agg(F.count(F.lit(1)).alias("observed"))
    whole = Window.partitionBy()  # two rows
    expected = F.sum("observed").over(whole) / F.count(F.lit(1)).over(whole)
    gap = F.col("observed") - F.col("expected")
    return counts.withColumn("expected", expected).select(
        "ab_variant",
        "observed",
        "expected",
        gap.alias("difference"),
        F.round(safe_divide(gap * gap, "expected"), 6).alias("chi_square_part"),
    )


def revenue_by_variant(sessions: DataFrame, events: DataFrame, orders: DataFrame, entry: str) -> DataFrame:
    """Sessions at the entry stage, conversions and revenue per arm."""
    entered = events.where(F.col("event_type") == entry).select("session_id").distinct()
    spent = orders.groupBy("session_id").agg(
        F.count("total_amount").alias("orders"), F.sum("total_amount").alias("revenue")
    )
    return (
        sessions.select("session_id", "ab_variant")
        .join(entered, "session_id", "left_semi")
        .join(spent, "session_id", "left")
        .groupBy("ab_variant")
        .agg(
            F.count("session_id").alias("sessions_at_checkout"),
            F.coalesce(F.sum("orders"), F.lit(0)).alias("conversions"),
            F.coalesce(F.sum("revenue"), F.lit(0)).alias("total_revenue"),
        )
    )


def revenue_impact(counts: DataFrame, annual_sessions: float, order_value, margin) -> DataFrame:
    """Incremental orders, revenue and profit at the low, expected and high end of the lift.

    ``counts`` holds one row of ``n_c, x_c, n_t, x_t``.
    """
    arms = [F.col(c) for c in ("n_c", "x_c", "n_t", "x_t")]
    values = dict(z_columns(*arms))
    base = F.lit(float(annual_sessions)) * values["conversion_rate_control"]
    scenarios = F.array(
        *[
            F.struct(F.lit(name).alias("scenario"), values[column].alias("relative_lift"))
            for name, column in (("low", "ci_rel_lower"), ("expected", "relative_lift"), ("high", "ci_rel_upper"))
        ]
    )
    rows = counts.select(base.alias("baseline_orders"), F.explode(scenarios).alias("s")).select("baseline_orders", "s.*")
    extra = F.col("baseline_orders") * F.col("relative_lift")
    return rows.select(
        "scenario",
        F.round("relative_lift", 6).alias("relative_lift"),
        F.round("baseline_orders", 4).alias("baseline_orders"),
        F.round(extra, 4).alias("incremental_orders"),
        F.round(extra * order_value, 2).alias("incremental_revenue"),
        F.round(extra * order_value * margin, 2).alias("incremental_profit"),
    )
