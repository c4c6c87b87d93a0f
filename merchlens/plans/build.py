"""The ordered build: models, assertions, the gate, exports, reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from merchlens.operators.quality import Check, declared_checks, gate, run_checks
from merchlens.plans.publish import materialise
from merchlens.plans.reports import PARAMETERS, reports
from merchlens.plans.warehouse import MARTS, MODELS, Warehouse
from merchlens.sources.sinks import export

REPORTED = ("fct_funnel", "fct_user_retention", "stg_orders", "fct_ab_test")


def ordered_build(
    warehouse: Warehouse,
    folder: str,
    models: Sequence[str] = MODELS,
    threshold: int = 0,
    parameters: dict | None = None,
    checks: Sequence[Check] | None = None,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Write the models, judge them, and only if the gate lets them pass export the marts and write the reports.

    ``threshold`` is how often an assertion may fail before the gate stops the build (``GateTripped``). Reports need
    the models of ``REPORTED``; without one of them they are left out. ``checks`` replaces the declared assertions, for a
    shop with other segments or stages. Returns the models as read back and the
    assertions' results.
    """
    tables = materialise(warehouse, f"{folder}/models", models)
    results = run_checks(tables, declared_checks(models) if checks is None else checks)
    gate(results, threshold)
    for name in models:
        if name in MARTS:
            export(tables[name], f"{folder}/export", name)
    if all(name in tables for name in REPORTED):
        chosen = PARAMETERS | (parameters or {})
        facts = [tables[name] for name in REPORTED]
        made = reports(
            *facts,
            warehouse.stages,
            alpha=chosen["alpha"],
            srm_alpha=chosen["srm_alpha"],
            share=chosen["expected_control_share"],
        )
        for name, frame in made.items():
            frame.write.mode("overwrite").parquet(f"{folder}/reports/{name}.parquet")
    return tables, results
