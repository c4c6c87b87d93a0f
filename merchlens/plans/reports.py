"""The statistical reports and their one-row summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlens.operators.experiment import ALPHA, CONTROL_SHARE, SRM_ALPHA, compute_ab_test, decision
from merchlens.operators.funnel import OVERALL, funnel_report, funnel_summary
from merchlens.operators.retention import compute_cohort_retention, retention_report
from merchlens.operators.sessions import STAGES, Stage

# Default parameters of the analyses.
PARAMETERS = {
    "alpha": ALPHA,
    "srm_alpha": SRM_ALPHA,
    "expected_control_share": CONTROL_SHARE,
    "power": 0.80,
    "cohort_months": 6,
    "churn_days": 60,
    "vip_orders": 4,
    "vip_spend": 300.0,
}
EXPERIMENT_NAME = "checkout_optimization"


def one_row(*frames: DataFrame) -> DataFrame:
    """Put one-row frames side by side: a union of the rows, then the known value per column."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result.agg(*[F.max(c).alias(c) for c in result.columns])


def experiment_summary(fact: DataFrame, **parameters) -> DataFrame:
    overall = decision(compute_ab_test(fact, [], **parameters)).where(F.col("dimension") == OVERALL)
    return overall.select(
        F.lit(EXPERIMENT_NAME).alias("experiment_name"),
        "n_control",
        "n_treatment",
        "srm_passed",
        "srm_p_value",
        "conversion_rate_control",
        "conversion_rate_treatment",
        "relative_lift",
        "z_score",
        "p_value",
        "statistically_significant",
        "ci_rel_lower",
        "ci_rel_upper",
        "recommendation",
    )


def statistical_summary(
    fct_funnel: DataFrame,
    fct_user_retention: DataFrame,
    orders: DataFrame,
    fct_ab_test: DataFrame,
    stages: Sequence[Stage] = STAGES,
    alpha: float = ALPHA,
    srm_alpha: float = SRM_ALPHA,
    share: float = CONTROL_SHARE,
) -> DataFrame:
    """Funnel, retention and experiment findings in one row."""
    retention = retention_report(fct_user_retention, orders).select(
        F.col("cohort_count").alias("total_cohorts"),
        "month_0_is_100_percent",
        "decay_monotonic_vs_m0",
        "repeat_purchase_rate",
        "total_purchasing_users",
    )
    experiment = experiment_summary(fct_ab_test, alpha=alpha, srm_alpha=srm_alpha, share=share)
    return one_row(funnel_summary(fct_funnel, stages), retention, experiment)


def reports(
    fct_funnel: DataFrame,
    fct_user_retention: DataFrame,
    orders: DataFrame,
    fct_ab_test: DataFrame,
    stages: Sequence[Stage] = STAGES,
    alpha: float = ALPHA,
    srm_alpha: float = SRM_ALPHA,
    share: float = CONTROL_SHARE,
) -> dict[str, DataFrame]:
    """The four report frames by dataset name, ready for ``Catalog.save``."""
    test = {"alpha": alpha, "srm_alpha": srm_alpha, "share": share}
    return {
        "funnel_analysis_report": funnel_report(fct_funnel, stages),
        "cohort_retention_report": compute_cohort_retention(fct_user_retention),
        "ab_test_results_report": compute_ab_test(fct_ab_test, **test),
        "statistical_summary_report": statistical_summary(
            fct_funnel, fct_user_retention, orders, fct_ab_test, stages, **test
        ),
    }
