"""Funnel progression, slices, leaks and checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchlens.functions.scalar import all_of, flag, is_set, pct, require_column, resolve_column, safe_divide
from merchlens.operators.sessions import STAGES, Stage

# Fixed values.
SLICES = ("device_type", "traffic_source", "country", "customer_segment")
OVERALL = "overall"


def sessions_reached(fact: DataFrame, stages: Sequence[Stage], by: Sequence[str] = ()) -> DataFrame:
    """One row per session (and slice): whether it reached each stage.

    The fact may repeat a session, so sessions are collapsed first; every distinct session
    count after this is a plain sum, instead of one distinct aggregate per stage.
    """
    return (
        fact.where(F.col("session_id").isNotNull())
        .groupBy(*by, "session_id")
        .agg(*[F.max(flag(is_set(fact, s.reached))).alias(s.reached) for s in stages])
    )


def stage_counts(fact: DataFrame, stages: Sequence[Stage], by: Sequence[str] = ()) -> DataFrame:
    """Distinct sessions and distinct sessions per stage, per slice."""
    return (
        sessions_reached(fact, stages, by)
        .groupBy(*by)
        .agg(
            F.count("session_id").alias("total_sessions"),
            *[F.coalesce(F.sum(s.reached), F.lit(0)).alias(s.reached) for s in stages],
        )
    )


def _entered(stages: Sequence[Stage]) -> dict[Stage, Column]:
    """The first stage is entered by every session."""
    return {s: F.col("total_sessions") if i == 0 else F.col(s.reached) for i, s in enumerate(stages)}


def stage_progression(fact: DataFrame, stages: Sequence[Stage] = STAGES, by: Sequence[str] = ()) -> DataFrame:
    """Sessions entering each stage, lost since the one before, and rates in percent.

    Losses are signed: a stage with more sessions than the one before shows a negative loss.
    """
    entered = _entered(stages)
    long = stage_counts(fact, stages, by).select(
        *by,
        F.col("total_sessions").alias("base"),
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(i).alias("stage_order"),
                        F.lit(s.label if i > 1 else "1_sessions").alias("stage_name"),
                        entered[s].alias("sessions_entered"),
                    )
                    for i, s in enumerate(stages, 1)
                ]
            )
        ).alias("stage"),
    )
    rows = long.select(*by, "base", "stage.*")
    # As many rows as stages per slice reach this window.
    prior = F.lag("sessions_entered").over(Window.partitionBy(*by).orderBy("stage_order"))
    lost = F.col("__prior") - F.col("sessions_entered")
    return rows.withColumn("__prior", prior).select(
        *by,
        "stage_order",
        "stage_name",
        "sessions_entered",
        F.coalesce(lost, F.lit(0)).alias("absolute_drop_off"),
        pct("sessions_entered", "__prior", default=100.0).alias("stage_conversion_rate_pct"),
        pct(lost, "__prior", default=0.0).alias("stage_drop_off_rate_pct"),
        pct("sessions_entered", "base").alias("overall_conversion_rate_pct"),
    )


def step_rates(
    fact: DataFrame,
    dimension: str,
    stages: Sequence[Stage] = STAGES,
    view: int = 2,
    cart: int = 3,
    checkout: int = 4,
    payment: int = 5,
    purchase: int = 6,
) -> DataFrame:
    """Sessions per stage and key step rates per value of one dimension."""
    at = {s.step: F.col(s.reached) for s in stages}
    total = F.col("total_sessions")
    return stage_counts(fact, stages, [dimension]).select(
        dimension,
        "total_sessions",
        at[view].alias("product_views"),
        at[cart].alias("cart_additions"),
        at[checkout].alias("checkout_starts"),
        at[payment].alias("payment_starts"),
        at[purchase].alias("purchases"),
        pct(at[view], total).alias("view_rate_pct"),
        pct(at[cart], at[view]).alias("cart_conversion_rate_pct"),
        pct(at[checkout], at[cart]).alias("checkout_initiation_rate_pct"),
        pct(at[purchase], at[checkout]).alias("checkout_completion_rate_pct"),
        pct(at[purchase], total).alias("overall_conversion_rate_pct"),
    )


def conversion_by(
    fact: DataFrame,
    dimension: str,
    stages: Sequence[Stage] = STAGES,
    cart: int = 3,
    checkout: int = 4,
    purchase: int = 6,
) -> DataFrame:
    """Cart, checkout and purchase sessions with their rates, per value of one dimension."""
    at = {s.step: F.col(s.reached) for s in stages}
    total = F.col("total_sessions")
    return stage_counts(fact, stages, [dimension]).select(
        dimension,
        "total_sessions",
        at[cart].alias("cart_sessions"),
        at[checkout].alias("checkout_sessions"),
        at[purchase].alias("purchasing_sessions"),
        pct(at[cart], total).alias("add_to_cart_rate_pct"),
        pct(at[purchase], at[checkout]).alias("checkout_to_purchase_rate_pct"),
        pct(at[purchase], total).alias("overall_conversion_rate_pct"),
    )


def segment_conversion(fact: DataFrame, dimension: str = "customer_segment", **options) -> DataFrame:
    return conversion_by(fact, dimension, **options).select(
        dimension,
        "total_sessions",
        "cart_sessions",
        "checkout_sessions",
        "purchasing_sessions",
        "overall_conversion_rate_pct",
        F.col("checkout_to_purchase_rate_pct").alias("checkout_completion_rate_pct"),
    )


def new_vs_returning(fact: DataFrame, **options) -> DataFrame:
    return conversion_by(user_type(fact), "user_type", **options).select(
        "user_type",
        "total_sessions",
        "cart_sessions",
        "checkout_sessions",
        F.col("purchasing_sessions").alias("purchase_sessions"),
        "overall_conversion_rate_pct",
        F.col("checkout_to_purchase_rate_pct").alias("checkout_conversion_rate_pct"),
    )


def user_type(fact: DataFrame) -> DataFrame:
    returning = F.col("is_returning_user")
    return fact.withColumn("user_type", F.when(returning, "Returning User").otherwise("New User"))


def leak_ranking(fact: DataFrame, stages: Sequence[Stage] = STAGES) -> DataFrame:
    """Transitions ranked by the sessions they lose. One scan, whatever the number of stages."""
    entered = _entered(stages)
    pairs = F.array(
        *[
            F.struct(
                F.lit(f"{i}. {a.title} -> {b.title}").alias("stage_transition"),
                entered[a].alias("entered_sessions"),
                entered[b].alias("completed_sessions"),
            )
            for i, (a, b) in enumerate(zip(stages, stages[1:]), 1)
        ]
    )
    rows = stage_counts(fact, stages).select(F.explode(pairs).alias("pair")).select("pair.*")
    lost = F.col("entered_sessions") - F.col("completed_sessions")
    # As many rows as transitions reach this window.
    rank = F.dense_rank().over(Window.orderBy(F.desc("lost_sessions")))
    return rows.withColumn("lost_sessions", lost).select(
        "stage_transition",
        "entered_sessions",
        "completed_sessions",
        "lost_sessions",
        pct("lost_sessions", "entered_sessions").alias("drop_off_pct"),
        rank.alias("leak_severity_rank"),
    )


def _reached(df: DataFrame, stage: Stage, index: int) -> Column:
    """How a fact tells that a session reached a stage: a flag, else the furthest step."""
    name = resolve_column(df, [stage.reached, stage.has])
    if name:
        return is_set(df, name)
    if "furthest_step_reached" in df.columns:
        return F.coalesce(F.col("furthest_step_reached") >= index, F.lit(False))
    return F.lit(False)


def slice_rows(df: DataFrame, dimensions: Sequence[str]) -> tuple[DataFrame, list[Column]]:
    """One pass for the overall figures and every single-dimension slice.

    Each row is repeated once per slice it belongs to (a fixed number), tagged with the
    dimension and value; null values belong to no slice. Aggregates combine before the
    shuffle, so the repeated rows never travel.
    """
    tags = [F.struct(F.lit(OVERALL).alias("dimension"), F.lit(OVERALL).alias("value"))]
    tags += [F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value")) for d in dimensions]
    tagged = df.withColumn("__slice", F.explode(F.array(*tags))).where(F.col("__slice.value").isNotNull())
    return tagged, [F.col("__slice.dimension").alias("dimension"), F.col("__slice.value").alias("value")]


def _clamped_rates(counts: DataFrame, keys: Sequence[str], stages: Sequence[Stage]) -> DataFrame:
    """From one row per slice (``total`` and a count per stage) to one row per stage.

    Losses never fall below zero and an empty base gives rate 0.
    """
    stage_structs = []
    prior = F.col("total")
    for index, stage in enumerate(stages, 1):
        reached = F.col(f"n{index}")
        lost = F.greatest(F.lit(0), prior - reached)
        stage_structs.append(
            F.struct(
                F.lit(index).alias("step_number"),
                F.lit(stage.name).alias("stage_name"),
                reached.alias("sessions_count"),
                pct(reached, prior, default=0.0).alias("step_conversion_rate"),
                pct(reached, "total", default=0.0).alias("overall_conversion_rate"),
                lost.alias("absolute_drop_off"),
                pct(lost, prior, default=0.0).alias("drop_off_rate"),
            )
        )
        prior = reached
    return counts.select(*keys, F.explode(F.array(*stage_structs)).alias("stage")).select(*keys, "stage.*")


def _flag_counts(df: DataFrame, stages: Sequence[Stage], keys: Sequence[Column]) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(_reached(df, s, i)).alias(f"n{i}") for i, s in enumerate(stages, 1)],
    )


def _event_counts(events: DataFrame, column: str, stages: Sequence[Stage], keys: Sequence[Column]) -> DataFrame:
    """Distinct sessions per stage from raw events; ``total`` counts the events."""
    per_session = events.groupBy(*keys, "session_id").agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.max(flag(F.col(column) == s.name)).alias(f"r{i}") for i, s in enumerate(stages, 1)],
    )
    known = F.col("session_id").isNotNull()
    return per_session.groupBy(*[c for c in per_session.columns[: len(keys)]]).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total"),
        *[F.coalesce(F.sum(F.when(known, F.col(f"r{i}"))), F.lit(0)).alias(f"n{i}") for i, _ in enumerate(stages, 1)],
    )


def _counts(df: DataFrame, stages: Sequence[Stage], keys: Sequence[Column] = ()) -> DataFrame:
    column = resolve_column(df, ["event_type", "event_name"])
    if column and "session_id" in df.columns:
        return _event_counts(df, column, stages, keys)
    return _flag_counts(df, stages, keys)


def evaluate_funnel(df: DataFrame, stages: Sequence[Stage] = STAGES) -> DataFrame:
    """Volumes and rates per stage from raw events or from a fact with stage flags."""
    return _clamped_rates(_counts(df, stages), [], stages)


def evaluate_slices(df: DataFrame, stages: Sequence[Stage] = STAGES, dimensions: Sequence[str] = SLICES) -> DataFrame:
    """``evaluate_funnel`` overall and for each value of each dimension the frame has."""
    tagged, keys = slice_rows(df, [d for d in dimensions if d in df.columns])
    return _clamped_rates(_counts(tagged, stages, keys), ["dimension", "value"], stages)


def compute_funnel_metrics(
    df: DataFrame, sessions: DataFrame | None = None, stages: Sequence[Stage] = STAGES
) -> DataFrame:
    """Funnel of a fact, or of events against a table of sessions (its rows are the base)."""
    if sessions is None:
        return evaluate_funnel(df, stages)
    column = require_column(df, ["event_type", "event_name"])
    base = sessions.agg(F.count(F.lit(1)).alias("total")).scalar()
    counts = _event_counts(df, column, stages, []).withColumn("total", base)
    signed = _clamped_rates(counts, [], stages)
    prior = F.lag("sessions_count", 1).over(Window.orderBy("step_number"))
    lost = F.coalesce(prior, base) - F.col("sessions_count")
    return signed.withColumn("absolute_drop_off", lost).withColumn(
        "drop_off_rate", pct("absolute_drop_off", F.col("sessions_count") + F.col("absolute_drop_off"), default=0.0)
    )


def top_drop_off(stages: DataFrame) -> DataFrame:
    """The stage that loses most after the first; the earlier one wins a tie."""
    order = F.struct(F.col("absolute_drop_off"), -F.col("step_number"))
    return stages.where(F.col("step_number") > 1).agg(F.max_by("stage_name", order).alias("top_dropoff_stage"))


def funnel_summary(df: DataFrame, stages: Sequence[Stage] = STAGES) -> DataFrame:
    """Total sessions, overall conversion and the worst stage, in one row."""
    counts = _counts(df, stages)
    rates = _clamped_rates(counts, ["total"], stages)
    last = len(stages)
    order = F.when(F.col("step_number") > 1, F.struct(F.col("absolute_drop_off"), -F.col("step_number")))
    return rates.agg(
        F.max("total").alias("total_sessions"),
        F.max(F.when(F.col("step_number") == last, F.col("overall_conversion_rate"))).alias("overall_conversion_rate"),
        F.max_by("stage_name", order).alias("top_dropoff_stage"),
    )


def funnel_report(df: DataFrame, stages: Sequence[Stage] = STAGES, dimensions: Sequence[str] = SLICES) -> DataFrame:
    """Long report: overall and sliced stages, with the worst stage of each slice marked."""
    rows = evaluate_slices(df, stages, dimensions)
    rank = F.when(F.col("step_number") > 1, F.struct(F.col("absolute_drop_off"), -F.col("step_number")))
    worst = F.max_by("stage_name", rank).over(Window.partitionBy("dimension", "value"))
    return rows.withColumn("top_dropoff_stage", worst)


def funnel_invariants(fact: DataFrame, stages: Sequence[Stage] = STAGES) -> DataFrame:
    """Sessions that reach a stage without the one before, and whether totals shrink."""
    flags = [is_set(fact, s.reached) for s in stages]
    skipped = [F.count_if(after & ~before) for before, after in zip(flags, flags[1:])]
    in_order = all_of(before | ~after for before, after in zip(flags, flags[1:]))
    totals = fact.agg(
        F.count(F.lit(1)).alias("sessions"),
        F.count_if(~in_order).alias("sessions_out_of_order"),
        *[c.alias(f"{b.name}_without_{a.name}") for c, (a, b) in zip(skipped, zip(stages, stages[1:]))],
        *[F.count_if(f).alias(f"n{i}") for i, f in enumerate(flags, 1)],
    )
    shrinking = all_of(F.col(f"n{i}") >= F.col(f"n{i + 1}") for i in range(1, len(stages)))
    return totals.withColumn("population_monotonic", shrinking).drop(*[f"n{i}" for i in range(1, len(stages) + 1)])


def channel_matrix(fact_funnel: DataFrame, fact_orders: DataFrame, channel: str = "traffic_source") -> DataFrame:
    """Sessions, completed orders, revenue, average order and conversion per channel."""
    visits = fact_funnel.groupBy(channel).agg(F.count_distinct("session_id").alias("total_sessions"))
    done = F.col("status") == "completed"
    sales = fact_orders.groupBy(channel).agg(
        F.count_if(done).alias("total_orders"), F.sum("subtotal_amount").alias("gross_revenue")
    )
    return visits.join(sales, channel, "left").select(
        channel,
        "total_sessions",
        F.coalesce("total_orders", F.lit(0)).alias("total_orders"),
        F.coalesce("gross_revenue", F.lit(0)).alias("gross_revenue"),
        safe_divide("gross_revenue", "total_orders", 0).alias("average_order_value"),
        safe_divide("total_orders", "total_sessions", 0).alias("conversion_rate"),
    )


def drop_off_grid(
    fact: DataFrame, by: Sequence[str] = ("country", "customer_segment"), stages: Sequence[Stage] = STAGES,
    before: int = 3, after: int = 4,
) -> DataFrame:
    """Overall conversion and the loss between two stages, per pair of dimension values."""
    at = {s.step: F.col(s.reached) for s in stages}
    return stage_counts(fact, stages, list(by)).select(
        *by,
        "total_sessions",
        safe_divide(at[stages[-1].step], at[stages[0].step], 0).alias("overall_funnel_conversion"),
        (at[before] - at[after]).alias("drop_off_sessions"),
    )


def conversion_grid(fact: DataFrame, by: Sequence[str], converted: str = "is_converting_session") -> DataFrame:
    """Row count and mean conversion over a grid of dimensions."""
    return fact.groupBy(*by).agg(
        F.count(F.lit(1)).alias("sessions"),
        safe_divide(F.sum(flag(is_set(fact, converted))), F.count(F.lit(1))).alias("conversion_rate"),
    )


def conversion_cube(fact: DataFrame, by: Sequence[str], converted: str = "is_converting_session") -> DataFrame:
    """The grid with its subtotals and the grand total; a null value marks a total."""
    return fact.where(all_of(F.col(d).isNotNull() for d in by)).cube(*by).agg(
        F.count(F.lit(1)).alias("sessions"),
        safe_divide(F.sum(flag(is_set(fact, converted))), F.count(F.lit(1))).alias("conversion_rate"),
    )
