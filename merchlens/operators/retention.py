"""Cohort retention, repeat purchase and lifetime value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchlens.functions.scalar import (
    flag,
    mean_money,
    month_offset,
    month_start,
    pct,
    require_column,
    resolve_column,
    sum_exact,
    year_month,
)
from merchlens.operators.funnel import OVERALL, slice_rows
from merchlens.operators.orders import COMPLETED

MAX_MONTHS = 6  # fixed value: months after the first that the wide matrix shows


def cohort_activity(fact: DataFrame, by: Sequence[str] = ("cohort_month",)) -> DataFrame:
    """Active users, orders and revenue per cohort and month since its first order.

    Users are collapsed first, so the user count is a plain count.
    """
    return (
        fact.groupBy(*by, "month_offset", "user_id")
        .agg(F.sum("orders_in_month").alias("orders"), F.sum("revenue_in_month").alias("revenue"))
        .groupBy(*by, "month_offset")
        .agg(
            F.count("user_id").alias("active_users"),
            F.sum("orders").alias("total_orders"),
            F.sum("revenue").alias("total_revenue"),
        )
    )


def _month_zero(by: Sequence[str]) -> Column:
    """Active users of month 0, read off the cohort's own rows: no self-join."""
    at_zero = F.when(F.col("month_offset") == 0, F.col("active_users"))
    return F.max(at_zero).over(Window.partitionBy(*by))


def retention_rates(fact: DataFrame) -> DataFrame:
    """Long matrix; cohorts without a month 0 are left out."""
    sized = cohort_activity(fact).withColumn("cohort_initial_users", _month_zero(["cohort_month"]))
    return sized.where(F.col("cohort_initial_users").isNotNull()).select(
        "cohort_month",
        "cohort_initial_users",
        "month_offset",
        "active_users",
        pct("active_users", "cohort_initial_users").alias("retention_rate_pct"),
        "total_orders",
        "total_revenue",
        mean_money("total_revenue", "cohort_initial_users").alias("ltv_per_cohort_user"),
    )


def retention_matrix(fact: DataFrame, months: int = MAX_MONTHS, fill: float | None = None) -> DataFrame:
    """Wide matrix M0..M``months`` and the users of month ``months`` or any later one (``m<months>_plus``).

    ``months`` bounds the columns, not the data: ``retention_rates`` has every month as a row. ``fill`` replaces
    cells without activity (null by default).
    """
    rates = retention_rates(fact)
    rate = F.col("retention_rate_pct")
    wide = rates.groupBy("cohort_month", "cohort_initial_users").agg(
        *[F.max(F.when(F.col("month_offset") == k, rate)).alias(f"m{k}_retention_pct") for k in range(months + 1)],
        F.round(F.avg(F.when(F.col("month_offset") == 1, rate)), 2).alias("avg_m1_retention"),
    )
    later = late_retention(fact, months).select("cohort_month", F.col(f"m{months}_plus_users").alias("__later"))
    wide = wide.join(later, "cohort_month").withColumn(
        f"m{months}_plus_retention_pct", pct("__later", "cohort_initial_users")
    )
    wide = wide.drop("__later")
    if fill is None:
        return wide
    return wide.fillna(fill, [f"m{k}_retention_pct" for k in range(months + 1)])


def late_retention(fact: DataFrame, months: int = MAX_MONTHS) -> DataFrame:
    """Users active exactly in month ``months`` against in that month or any later one."""
    users = fact.groupBy("cohort_month", "user_id").agg(
        F.max(flag(F.col("month_offset") == 0)).alias("base"),
        F.max(flag(F.col("month_offset") == months)).alias("exact"),
        F.max(flag(F.col("month_offset") >= months)).alias("later"),
    )
    return users.groupBy("cohort_month").agg(
        F.sum("base").alias("cohort_initial_users"),
        F.sum("exact").alias(f"m{months}_users"),
        F.sum("later").alias(f"m{months}_plus_users"),
    )


def repeat_summary(users: DataFrame) -> DataFrame:
    """Purchasers, repeat and one-time buyers and their value, in one row."""
    repeat = F.col("lifetime_orders") >= 2
    buyers = users.where(F.col("lifetime_orders") > 0).agg(
        F.count("user_id").alias("total_purchasing_customers"),
        F.count_if(repeat).alias("repeat_customers"),
        F.count_if(F.col("lifetime_orders") == 1).alias("one_time_buyers"),
        F.sum("lifetime_revenue").alias("__revenue"),
        F.sum(F.when(repeat, F.col("lifetime_revenue"))).alias("__repeat_revenue"),
    )
    return buyers.select(
        "total_purchasing_customers",
        "repeat_customers",
        "one_time_buyers",
        pct("repeat_customers", "total_purchasing_customers").alias("repeat_purchase_rate_pct"),
        mean_money("__revenue", "total_purchasing_customers").alias("overall_customer_aov"),
        mean_money("__repeat_revenue", "repeat_customers").alias("repeat_customer_arpu"),
    )


def _buyers_by(users: DataFrame, dimension: str) -> DataFrame:
    return (
        users.where(F.col("lifetime_orders") > 0)
        .groupBy(dimension)
        .agg(
            F.count("user_id").alias("total_customers"),
            F.count_if(F.col("lifetime_orders") >= 2).alias("repeat_customers"),
            F.sum("lifetime_orders").alias("__orders"),
            F.sum("lifetime_revenue").alias("__revenue"),
        )
    )


def repeat_by_segment(users: DataFrame, dimension: str = "customer_segment") -> DataFrame:
    return _buyers_by(users, dimension).select(
        dimension,
        "total_customers",
        "repeat_customers",
        pct("repeat_customers", "total_customers").alias("repeat_purchase_rate_pct"),
        mean_money("__orders", "total_customers").alias("avg_orders_per_customer"),
        mean_money("__revenue", "total_customers").alias("avg_lifetime_revenue"),
    )


def repeat_by_channel(users: DataFrame, dimension: str = "acquisition_channel") -> DataFrame:
    return _buyers_by(users, dimension).select(
        dimension,
        "total_customers",
        "repeat_customers",
        pct("repeat_customers", "total_customers").alias("repeat_purchase_rate_pct"),
        mean_money("__revenue", "total_customers").alias("avg_ltv"),
        F.round("__revenue", 2).alias("channel_total_revenue"),
    )


def _so_far(by: Sequence[str]) -> Window:
    """Over at most one row per cohort and month."""
    return Window.partitionBy(*by).orderBy("month_offset").rowsBetween(Window.unboundedPreceding, Window.currentRow)


def cohort_ltv(fact: DataFrame) -> DataFrame:
    """Running revenue per cohort, and per user of its month 0."""
    sized = cohort_activity(fact).withColumn("cohort_size", _month_zero(["cohort_month"]))
    running = F.sum("total_revenue").over(_so_far(["cohort_month"]))
    return (
        sized.where(F.col("cohort_size").isNotNull())
        .withColumn("cumulative_cohort_revenue", running)
        .select(
            "cohort_month",
            "cohort_size",
            "month_offset",
            F.col("total_revenue").alias("month_revenue"),
            "cumulative_cohort_revenue",
            mean_money("cumulative_cohort_revenue", "cohort_size").alias("cumulative_ltv_per_user"),
        )
    )


def standard_fact(fact: DataFrame) -> DataFrame:
    """Resolve alternative column names: month text, offset, revenue, segment."""
    revenue = resolve_column(fact, ["revenue_in_month", "monthly_revenue"])
    segment = resolve_column(fact, ["customer_segment", "segment"])
    columns = [
        F.col("user_id"),
        year_month("cohort_month").alias("cohort_month"),
        F.col(require_column(fact, ["month_offset", "month_number"])).cast("int").alias("month_offset"),
        F.coalesce(F.col(revenue).cast("decimal(18,2)"), F.lit(0)).alias("revenue_in_month")
        if revenue
        else F.lit(0).cast("decimal(18,2)").alias("revenue_in_month"),
        F.lit(1).alias("orders_in_month"),
    ]
    if segment:
        columns.append(F.col(segment).alias("customer_segment"))
    return fact.select(*columns)


def cohort_sizes(standard: DataFrame, by: Sequence[str]) -> DataFrame:
    """Users of month 0, or every user ever seen where a cohort has no month 0."""
    per_user = standard.groupBy(*by, "user_id").agg(F.max(flag(F.col("month_offset") == 0)).alias("first"))
    return per_user.groupBy(*by).agg(
        F.sum("first").alias("__first"), F.count("user_id").alias("__ever")
    ).select(*by, F.coalesce(F.nullif(F.col("__first"), F.lit(0)), F.col("__ever")).alias("initial_cohort_size"))


def compute_cohort_retention(fact: DataFrame) -> DataFrame:
    """Long matrix with the size fallback. One row per cohort and active month."""
    standard = standard_fact(fact)
    active = cohort_activity(standard).select("cohort_month", "month_offset", "active_users", "total_revenue")
    return active.join(cohort_sizes(standard, ["cohort_month"]), "cohort_month").select(
        "cohort_month",
        "month_offset",
        "active_users",
        "initial_cohort_size",
        pct("active_users", "initial_cohort_size", default=0.0).alias("retention_rate"),
        "total_revenue",
    )


def filled_matrix(rates: DataFrame) -> DataFrame:
    """Every cohort with every month that occurs, 0.0 where the cohort was silent.

    Months and cohorts are few (one per calendar month); both lists come from the rates.
    """
    rates = rates.where(F.col("month_offset").isNotNull())  # orders without a date belong to no month
    last = rates.select("month_offset").distinct().agg(F.sort_array(F.collect_set("month_offset")).alias("months"))
    cohorts = rates.groupBy("cohort_month").agg(
        F.map_from_entries(F.collect_list(F.struct("month_offset", "retention_rate"))).alias("rates")
    )
    grid = cohorts.withColumn("month_offset", F.explode(last.scalar()))
    return grid.select(
        "cohort_month",
        "month_offset",
        F.coalesce(F.try_element_at("rates", F.col("month_offset")), F.lit(0.0)).alias("retention_rate"),
    )


def retention_violations(rates: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Cells that break a rule: month 0 is 100, no month above 100, no rise."""
    grid = filled_matrix(rates)
    prior = F.lag("retention_rate").over(Window.partitionBy("cohort_month").orderBy("month_offset"))
    rate, offset = F.col("retention_rate"), F.col("month_offset")
    rules = F.array(
        F.when((offset == 0) & (F.abs(rate - 100.0) > tolerance), "month_0_not_100"),
        F.when((offset > 0) & (rate > 100.0), "above_100"),
        F.when(rate > F.col("prior_rate") + tolerance, "rise"),
    )
    return (
        grid.withColumn("prior_rate", prior)
        .select("cohort_month", "month_offset", "retention_rate", "prior_rate", F.explode(rules).alias("rule"))
        .where(F.col("rule").isNotNull())
    )


def retention_invariants(rates: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """The three rules as booleans and the number of cohorts, in one row."""
    broken = retention_violations(rates, tolerance).agg(
        F.count_if(F.col("rule") == "month_0_not_100").alias("a"),
        F.count_if(F.col("rule") == "above_100").alias("b"),
        F.count_if(F.col("rule") == "rise").alias("c"),
    )
    seen = rates.groupBy("cohort_month").agg(F.min("month_offset").alias("first")).agg(
        F.count(F.lit(1)).alias("cohort_count"), F.min("first").alias("first")
    )
    both = broken.unionByName(seen, allowMissingColumns=True)
    known = both.agg(*[F.max(c).alias(c) for c in both.columns])
    return known.select(
        ((F.col("a") == 0) & ((F.col("cohort_count") == 0) | (F.col("first") == 0))).alias("month_0_is_100_percent"),
        (F.col("b") == 0).alias("decay_monotonic_vs_m0"),
        (F.col("c") == 0).alias("all_decay_monotonic"),
        "cohort_count",
    )


def repeat_purchase_rate(
    orders: DataFrame, dimensions: Sequence[str] = ("customer_segment", "country", "acquisition_channel")
) -> DataFrame:
    """Users with an order and with two or more, overall and per dimension value.

    Counts completed orders; all orders when none is completed (or there is no status).
    """
    if "status" in orders.columns:
        any_completed = orders.agg(F.coalesce(F.bool_or(F.col("status") == COMPLETED), F.lit(False))).scalar()
        orders = orders.where((F.col("status") == COMPLETED) | ~any_completed)
    tagged, keys = slice_rows(orders, [d for d in dimensions if d in orders.columns])
    per_order = tagged.where(F.col("user_id").isNotNull()).groupBy(*keys, "user_id", "order_id").agg(
        F.count("order_id").alias("rows")
    )
    per_user = per_order.groupBy("dimension", "value", "user_id").agg(F.count_if(F.col("rows") > 0).alias("orders"))
    totals = per_user.groupBy("dimension", "value").agg(
        F.count(F.lit(1)).alias("total_users"), F.count_if(F.col("orders") >= 2).alias("repeat_users")
    )
    return totals.withColumn("repeat_purchase_rate", pct("repeat_users", "total_users", default=0.0))


def ltv_curves(fact: DataFrame) -> DataFrame:
    """Running revenue and value per user by segment (if known), cohort and month."""
    standard = standard_fact(fact)
    by = (["customer_segment"] if "customer_segment" in standard.columns else []) + ["cohort_month"]
    active = cohort_activity(standard, by)
    sized = active.join(cohort_sizes(standard, by), by)
    size = F.greatest(F.lit(1), F.col("initial_cohort_size"))
    running = F.round(F.sum("total_revenue").over(_so_far(by)), 2)
    return sized.select(
        *by,
        "month_offset",
        "active_users",
        F.col("total_revenue").alias("revenue"),
        size.alias("cohort_initial_size"),
        running.alias("cumulative_revenue"),
    ).withColumn("cumulative_ltv", mean_money("cumulative_revenue", "cohort_initial_size"))


def first_order_cohorts(orders: DataFrame) -> DataFrame:
    """Monthly cohorts straight from orders of any status: users, revenue, running value.

    Orders shrink to one row per user and month first; the user's first month is read off
    those rows.
    """
    monthly = orders.groupBy("user_id", month_start("order_timestamp").alias("month")).agg(
        sum_exact("total_amount").alias("revenue")
    )
    first = F.min("month").over(Window.partitionBy("user_id"))
    cohorts = monthly.withColumn("cohort_month", first).groupBy(
        "cohort_month", month_offset("cohort_month", "month").alias("month_offset")
    ).agg(F.count("user_id").alias("active_users"), F.sum("revenue").alias("revenue"))
    running = F.sum("revenue").over(Window.partitionBy("cohort_month").orderBy("month_offset"))
    return cohorts.withColumn("initial_users", _month_zero(["cohort_month"])).select(
        "cohort_month",
        "month_offset",
        "active_users",
        "initial_users",
        pct("active_users", "initial_users").alias("retention_rate"),
        running.alias("cumulative_revenue"),
        mean_money(running, "initial_users").alias("cumulative_ltv_per_user"),
    )


def segment_ltv(orders: DataFrame, users: DataFrame) -> DataFrame:
    """Revenue per active user by cohort, segment and month since the first order."""
    monthly = orders.groupBy("user_id", month_start("order_timestamp").alias("month")).agg(
        sum_exact("total_amount").alias("revenue")
    )
    first = F.min("month").over(Window.partitionBy("user_id"))
    people = users.select("user_id", "customer_segment")
    return (
        monthly.withColumn("cohort_month", first)
        .join(people, "user_id")
        .groupBy("cohort_month", "customer_segment", month_offset("cohort_month", "month").alias("month_offset"))
        .agg(F.count("user_id").alias("active_users"), F.sum("revenue").alias("revenue"))
        .withColumn("ltv_per_acquired_user", mean_money("revenue", "active_users"))
    )


def cohort_definition_gap(users: DataFrame, orders: DataFrame) -> DataFrame:
    """Ordering users, and those whose signup month is not their first order's month."""
    first = orders.groupBy("user_id").agg(F.min("order_timestamp").alias("first_order"))
    joined = first.join(users.select("user_id", "cohort_month"), "user_id")
    return joined.agg(
        F.count(F.lit(1)).alias("ordering_users"),
        F.count_if(F.col("cohort_month") != month_start("first_order")).alias("different_month"),
    )


def order_frequency(users: DataFrame, most: int = 5) -> DataFrame:
    """Buyers by number of lifetime orders, ``most`` and above together."""
    bucket = F.least(F.col("lifetime_orders"), F.lit(most))
    label = F.concat(bucket.cast("string"), F.when(bucket == most, "+").otherwise(""))
    return (
        users.where(F.col("lifetime_orders") > 0)
        .groupBy(label.alias("order_frequency"))
        .agg(F.count("user_id").alias("users"))
    )


def revenue_layers(fact: DataFrame) -> DataFrame:
    """Monthly revenue by calendar month and cohort."""
    return fact.groupBy(F.date_format("activity_month", "yyyy-MM").alias("year_month"), "cohort_month").agg(
        F.sum("monthly_revenue").alias("monthly_revenue")
    )


def retention_report(fact: DataFrame, orders: DataFrame) -> DataFrame:
    """Cohort count, invariants and repeat rate in one row."""
    rates = compute_cohort_retention(fact)
    repeat = repeat_purchase_rate(orders, []).where(F.col("dimension") == OVERALL).agg(
        F.coalesce(F.max("total_users"), F.lit(0)).alias("total_purchasing_users"),
        F.coalesce(F.max("repeat_users"), F.lit(0)).alias("repeat_purchasing_users"),
        F.coalesce(F.max("repeat_purchase_rate"), F.lit(0.0)).alias("repeat_purchase_rate"),
    )
    both = retention_invariants(rates).unionByName(repeat, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])
