"""Session-grain funnel flags and sessions cut from raw events."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from merchlens.functions.scalar import flag
from merchlens.operators.hotkeys import HOT_ROWS, sequence_rows


@dataclass(frozen=True)
class Stage:
    step: int
    name: str
    short: str | None = None
    label_text: str | None = None

    @property
    def title(self) -> str:
        return self.label_text or self.name.replace("_", " ").title()

    @property
    def reached(self) -> str:
        return f"reached_{self.name}"

    @property
    def has(self) -> str:
        return f"has_{self.name}"

    @property
    def first_at(self) -> str:
        return f"first_{self.short or self.name}_at"

    @property
    def label(self) -> str:
        return f"{self.step}_{self.name}"


# The default funnel.
STAGES = (
    Stage(1, "landing_page", "landing"),
    Stage(2, "product_view"),
    Stage(3, "add_to_cart", label_text="Add to Cart"),
    Stage(4, "checkout_started", "checkout"),
    Stage(5, "payment_started", "payment"),
    Stage(6, "purchase", label_text="Purchase Completed"),
)
NO_STAGE = "0_none"


def stage_label(step, stages: Sequence[Stage]):
    label = F.lit(NO_STAGE)
    for stage in stages:
        label = F.when(step == stage.step, F.lit(stage.label)).otherwise(label)
    return label


def session_funnel(events: DataFrame, stages: Sequence[Stage] = STAGES) -> DataFrame:
    """One row per session and user. Every aggregate combines before the shuffle.

    Booleans and 0/1 flags follow from the counts, so only counts and firsts are aggregated.
    """
    in_stage = {s: F.col("event_type") == s.name for s in stages}
    grouped = events.groupBy("session_id", "user_id").agg(
        F.count("event_id").alias("total_events_count"),
        *[F.count_if(in_stage[s]).alias(f"{s.name}_events") for s in stages],
        F.coalesce(F.max("step_number"), F.lit(0)).alias("furthest_step_reached"),
        *[F.min(F.when(in_stage[s], F.col("event_timestamp"))).alias(s.first_at) for s in stages],
        F.max("cart_value").alias("final_cart_value"),
    )
    return _with_flags(grouped, stages)


def merge_funnels(partials: DataFrame, stages: Sequence[Stage] = STAGES) -> DataFrame:
    """Session funnels of parts of the events put together; equal to ``session_funnel`` over all of them."""
    grouped = partials.groupBy("session_id", "user_id").agg(
        F.sum("total_events_count").alias("total_events_count"),
        *[F.sum(f"{s.name}_events").alias(f"{s.name}_events") for s in stages],
        F.max("furthest_step_reached").alias("furthest_step_reached"),
        *[F.min(s.first_at).alias(s.first_at) for s in stages],
        F.max("final_cart_value").alias("final_cart_value"),
    )
    return _with_flags(grouped, stages)


def _with_flags(grouped: DataFrame, stages: Sequence[Stage]) -> DataFrame:
    reached = {s: F.col(f"{s.name}_events") > 0 for s in stages}
    step = F.col("furthest_step_reached")
    return grouped.select(
        "session_id",
        "user_id",
        "total_events_count",
        *[f"{s.name}_events" for s in stages],
        *[reached[s].alias(s.has) for s in stages],
        *[flag(reached[s]).alias(s.reached) for s in stages],
        "furthest_step_reached",
        step.alias("funnel_stage_order"),
        stage_label(step, stages).alias("funnel_stage_reached"),
        *[s.first_at for s in stages],
        "final_cart_value",
    )


def session_flags(sessions: DataFrame, events: DataFrame) -> DataFrame:
    """Bounce (went no further than step 1) and returning flags, derived from the events."""
    furthest = events.groupBy("session_id").agg(F.max("step_number").alias("__furthest"))
    ordered = sequence_rows(
        sessions.select("session_id", "user_id", "session_start"),
        key="user_id",
        order=["session_start", "session_id"],
        sequence="session_sequence",
    )
    returning = F.col("session_sequence") > 1
    return ordered.join(furthest, "session_id", "left").select(
        "session_id",
        "user_id",
        "session_sequence",
        F.coalesce(F.col("__furthest") == 1, F.lit(False)).alias("is_bounce"),
        returning.alias("is_returning_user"),
        (~returning).alias("is_new_user"),
    )


def sessionise(
    events: DataFrame,
    gap_minutes: int = 30,
    user: str = "user_id",
    at: str = "event_timestamp",
    event: str = "event_id",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Number the sessions of each user: a new one starts after ``gap_minutes`` of silence."""
    ordered = sequence_rows(
        events, user, [at, event], previous={at: "__earlier"}, hot_rows=hot_rows
    )
    silent = F.col("__earlier").isNull() | (F.col(at) - F.col("__earlier") > F.make_dt_interval(mins=F.lit(gap_minutes)))
    starts = ordered.withColumn("__starts", flag(silent).cast("bigint"))
    numbered = sequence_rows(
        starts, user, [at, event], running={"__starts": "session_number"}, hot_rows=hot_rows
    )
    return numbered.drop("__earlier", "__starts")


def dwell_times(events: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Seconds since the previous event of the session, in step order."""
    order = ["step_number", "event_timestamp", "event_id"]
    ordered = sequence_rows(
        events, "session_id", order, previous={"event_timestamp": "prior_event_timestamp"}, hot_rows=hot_rows
    )
    seconds = F.col("event_timestamp").cast("timestamp").cast("double") - F.col("prior_event_timestamp").cast(
        "timestamp"
    ).cast("double")
    return ordered.withColumn("seconds_since_prior", F.round(seconds, 3))


def dwell_summary(events: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Transitions, those that do not move forward in time, and the dwell range."""
    steps = dwell_times(events, hot_rows).where(F.col("prior_event_timestamp").isNotNull())
    return steps.agg(
        F.count(F.lit(1)).alias("transitions"),
        F.count_if(F.col("event_timestamp") <= F.col("prior_event_timestamp")).alias("non_increasing"),
        F.min("seconds_since_prior").alias("min_dwell_seconds"),
        F.max("seconds_since_prior").alias("max_dwell_seconds"),
    )


def user_days(events: DataFrame) -> DataFrame:
    """Sessions cut by calendar day: one per user and day, in time order per user."""
    days = events.groupBy("session_id", "user_id").agg(
        F.min("event_timestamp").alias("session_start"),
        F.max("event_timestamp").alias("session_end"),
        F.max("step_number").alias("furthest_step"),
    )
    # One row per user and day, so the window never sees more rows than there are days.
    by_user = Window.partitionBy("user_id").orderBy("session_start")
    return days.withColumn("session_sequence", F.row_number().over(by_user))
