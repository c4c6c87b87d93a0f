"""Named business measures over the star schema, evaluated in any slice and filter.

A *base* measure aggregates one fact. A *derived* measure is a formula over others. All base
measures of a fact share one aggregate; distinct counts of the fact's entity first collapse
the entity, so no measure needs a distinct aggregate of its own.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchlens.functions.scalar import all_of, flag, is_set, safe_divide, scaled, sum_exact, unscaled
from merchlens.operators.cubes import Cube, build_cube

# Fixed values.
STAGE_NAMES = ("Landing", "Product View", "Add To Cart", "Checkout Started", "Payment Started", "Purchase")
STAGE_COLUMNS = ("landing_page", "product_view", "add_to_cart", "checkout_started", "payment_started", "purchase")
DROP_OFFS = ("Landing to View", "View to Cart", "Cart to Checkout", "Checkout to Payment")
ENTITY = {
    "fct_orders": "order_id",
    "fct_funnel": "user_id",
    "fct_user_retention": "user_id",
    "fct_ab_test": "session_id",
    "dim_users": "user_id",
    "dim_date": "date_day",
}
SIGNIFICANT = ("Statistically Significant (p < 0.05)", "Inconclusive (p >= 0.05)")
SRM_STATUS = ("SRM FAILED - BIASED (p < 0.01)", "SRM PASSED - BALANCED")
SRM_LIMIT = 6.635
Z_LIMIT = 1.96
STANDARD_NORMAL_INVERSE = 1.95996
CHI_SQUARE_CRITICAL = 6.6349
P_CUBIC, P_LINEAR = 0.07056, 1.5976
COLOR_FAIL, COLOR_PASS = "#F43F5E", "#10B981"
MONEY_PLACES = 4


@dataclass(frozen=True)
class Base:
    """``combine``: total, money, entities (distinct), lowest or highest."""

    fact: str
    combine: str
    value: Callable[[DataFrame], Column]


@dataclass(frozen=True)
class Derived:
    formula: Callable[[Callable[[str], Column], Context], Column]


@dataclass(frozen=True)
class Trend:
    """Needs a time axis: see ``daily_trend`` and ``monthly_growth``."""

    axis: str


@dataclass(frozen=True)
class Context:
    filters: Mapping[str, object]
    as_of: object = None


def slug(name: str) -> str:
    """Column name of a measure."""
    text = name.replace("%", " pct ").lower()
    return re.sub(r"[^a-z0-9]+", "_", text).strip("_")


def _ratio(top: str, bottom: str, default: float | None = 0.0) -> Derived:
    return Derived(lambda m, _: safe_divide(m(top), m(bottom), default))


def _executive() -> dict:
    def done(_):
        return F.coalesce(F.col("status") == "completed", F.lit(True))

    def returning(_):
        return F.coalesce(F.col("status") == "completed", F.lit(True)) & (
            ~F.col("is_first_order") | F.col("is_repeat_order")
        )

    return {
        "Gross Revenue": Base("fct_orders", "money", lambda _: F.col("subtotal_amount")),
        "Net Revenue": Base("fct_orders", "money", lambda _: F.col("total_amount")),
        "Total Orders": Base("fct_orders", "entities", done),
        "Average Order Value (AOV)": _ratio("Gross Revenue", "Total Orders"),
        "Total Units Sold": Base("fct_orders", "total", lambda _: F.col("total_items_count")),
        "Average Units Per Order (UPT)": _ratio("Total Units Sold", "Total Orders"),
        "Gross Profit Amount": Base("fct_orders", "money", lambda _: F.col("gross_margin_amount")),
        "Gross Margin %": _ratio("Gross Profit Amount", "Gross Revenue"),
        "Total Sessions": Base("fct_funnel", "total", lambda _: F.lit(1)),
        "Total Unique Users": Base("fct_funnel", "entities", lambda _: F.lit(True)),
        "Overall Conversion Rate %": _ratio("Total Orders", "Total Sessions"),
        "MoM Revenue Growth %": Trend("month"),
        "YoY Revenue Growth %": Trend("month"),
        "Revenue 7-Day Moving Avg": Trend("day"),
        "Revenue 30-Day Moving Avg": Trend("day"),
        "Returning Users Count": Base("dim_users", "entities", lambda _: F.col("lifetime_orders") > 1),
        "Returning Orders": Base("fct_orders", "entities", returning),
        "Returning User Order Share %": _ratio("Returning Orders", "Total Orders"),
    }


def _funnel(stages: Sequence[str]) -> dict:
    def reached(stage):
        def value(df):
            names = [c for c in (f"reached_{stage}", f"has_{stage}") if c in df.columns]
            condition = F.lit(False)
            for name in names:
                condition = condition | is_set(df, name)
            return flag(condition)

        return Base("fct_funnel", "total", value)

    names = [f"Stage {i} {name} Sessions" for i, name in enumerate(STAGE_NAMES, 1)]
    library = {name: reached(stage) for name, stage in zip(names, stages)}
    library["Overall Funnel Conversion Rate %"] = _ratio(names[-1], names[0])
    for i, (before, after) in enumerate(zip(names, names[1:]), 1):
        library[f"Stage {i} to {i + 1} Conversion Rate %"] = _ratio(after, before)
    for label, before, after in zip(DROP_OFFS, names, names[1:]):
        library[f"Drop-off {label}"] = Derived(lambda m, _, b=before, a=after: m(b) - m(a))
    return library


def _retention() -> dict:
    def at(month):
        def value(df):
            offset = F.col("month_offset")
            in_month = offset >= month if month == 6 else offset == month
            return in_month & (is_set(df, "is_retained") | is_set(df, "is_active"))

        return Base("fct_user_retention", "entities", value)

    def rate(month):
        def formula(m, context):
            share = safe_divide(m(f"M{month} Retained Users"), m("Cohort Size (M0 Users)"), 0)
            if context.as_of is None:
                return share
            return F.when(m("First Calendar Date") > F.lit(context.as_of).cast("date"), None).otherwise(share)

        return Derived(formula)

    library = {"Cohort Size (M0 Users)": Base("fct_user_retention", "entities", lambda _: F.col("month_offset") == 0)}
    library |= {f"M{k} Retained Users": at(k) for k in range(7)}
    library |= {f"M{k} Retention Rate %": rate(k) for k in range(1, 7)}
    library["Repeat Purchase Rate %"] = _ratio("Returning Users Count", "Known Users")
    library["Known Users"] = Base("dim_users", "entities", lambda _: F.lit(True))
    library["Cumulative Revenue Sum"] = Base("fct_user_retention", "money", lambda _: F.col("cumulative_revenue"))
    # Sums a running total over the rows in context, as defined.
    library["Cohort Cumulative LTV per User"] = _ratio("Cumulative Revenue Sum", "Cohort Size (M0 Users)")
    return library


def _experiment() -> dict:
    def arm(name, bought=False):
        def value(df):
            condition = F.coalesce(F.col("ab_variant") == name, F.lit(False))
            if bought:
                condition = condition & (is_set(df, "completed_purchase") | is_set(df, "converted_to_purchase"))
            return flag(condition)

        return Base("fct_ab_test", "total", value)

    def arms(m):
        return m("AB Control Sessions"), m("AB Treatment Sessions")

    def error(m, _):
        p, (n1, n2) = m("AB Pooled Proportion"), arms(m)
        usable = (n1 > 0) & (n2 > 0) & (p > 0) & (p < 1)
        spread = p * (1 - p) * (safe_divide(F.lit(1.0), n1, 0) + safe_divide(F.lit(1.0), n2, 0))
        return F.when(usable, F.sqrt(spread)).otherwise(0.0)

    def relative(m, _):
        control = m("AB Control Conversion Rate %")
        return F.when(control != 0, safe_divide(m("AB Absolute Uplift"), control))

    def p_value(m, _):
        z = F.abs(m("AB Z-Score"))
        tail = 1.0 / (1.0 + F.exp(-P_CUBIC * F.pow(z, 3) - P_LINEAR * z))
        return F.when(z.isNull() | (z == 0), 1.0).otherwise(2.0 * (1.0 - tail))

    def chi2(m, _):
        (n1, n2), half = arms(m), m("AB SRM Expected Sessions")
        return safe_divide((n1 - half) * (n1 - half), half) + safe_divide((n2 - half) * (n2 - half), half)

    def srm_status(m, _):
        value, (failed, passed) = m("AB SRM Chi-Square Statistic"), SRM_STATUS
        return F.when(value.isNull(), "Unknown").when(value > SRM_LIMIT, failed).otherwise(passed)

    def bound(sign):
        def formula(m, _):
            margin = Z_LIMIT * safe_divide(m("AB Pooled Standard Error"), m("AB Control Conversion Rate %"), 0)
            return m("AB Relative Uplift %") + sign * margin

        return Derived(formula)

    return {
        "AB Control Sessions": arm("control"),
        "AB Treatment Sessions": arm("treatment"),
        "AB Total Experiment Sessions": Derived(lambda m, _: arms(m)[0] + arms(m)[1]),
        "AB Control Purchases": arm("control", True),
        "AB Treatment Purchases": arm("treatment", True),
        "AB Control Conversion Rate %": _ratio("AB Control Purchases", "AB Control Sessions"),
        "AB Treatment Conversion Rate %": _ratio("AB Treatment Purchases", "AB Treatment Sessions"),
        "AB Absolute Uplift": Derived(
            lambda m, _: m("AB Treatment Conversion Rate %") - m("AB Control Conversion Rate %")
        ),
        "AB Relative Uplift %": Derived(relative),
        "AB Pooled Proportion": Derived(
            lambda m, _: safe_divide(m("AB Control Purchases") + m("AB Treatment Purchases"), arms(m)[0] + arms(m)[1], 0)
        ),
        "AB Pooled Standard Error": Derived(error),
        "AB Z-Score": _ratio("AB Absolute Uplift", "AB Pooled Standard Error"),
        "AB Two-Sided P-Value Approx": Derived(p_value),
        "AB Statistically Significant Flag": Derived(
            lambda m, _: F.when(F.abs(m("AB Z-Score")) >= Z_LIMIT, SIGNIFICANT[0]).otherwise(SIGNIFICANT[1])
        ),
        "AB SRM Expected Sessions": Derived(lambda m, _: (arms(m)[0] + arms(m)[1]) / 2.0),
        "AB SRM Chi-Square Statistic": Derived(chi2),
        "AB SRM Status": Derived(srm_status),
        "AB 95% CI Lower Bound": bound(-1),
        "AB 95% CI Upper Bound": bound(1),
    }


def _helpers() -> dict:
    def period(m, _):
        return F.concat(F.lit("Period: "), m("First Calendar Date"), F.lit(" to "), m("Max Observed Date"))

    def title(_, context):
        chosen = context.filters.get("customer_segment")
        one = chosen if isinstance(chosen, str) else chosen[0] if chosen and len(chosen) == 1 else "All Segments"
        return F.lit(f"Customer Segment: {one}")

    return {
        "Standard Normal Inverse Approx": Derived(lambda *_: F.lit(STANDARD_NORMAL_INVERSE)),
        "Chi-Square Critical Value 99%": Derived(lambda *_: F.lit(CHI_SQUARE_CRITICAL)),
        "First Calendar Date": Base("dim_date", "lowest", lambda _: F.col("date_day")),
        "Max Observed Date": Base("dim_date", "highest", lambda _: F.col("date_day")),
        "Has Filter Applied": Derived(
            lambda _, context: F.lit(bool({"customer_segment", "device_type"} & set(context.filters)))
        ),
        "Card Subtitle Date Range": Derived(period),
        "WCAG Formatted Status Color": Derived(
            lambda m, _: F.when(m("AB SRM Chi-Square Statistic") > SRM_LIMIT, COLOR_FAIL).otherwise(COLOR_PASS)
        ),
        "Divide Safe Helper": Derived(lambda *_: safe_divide(F.lit(1), F.lit(1), 0)),
        "Blank Guard Helper": Derived(
            lambda m, _: F.when(m("Max Observed Date").isNull(), "No Date").otherwise("Valid Date")
        ),
        "Segment Filter Slicer Title": Derived(title),
        "Currency Formatter": Derived(lambda m, _: F.concat(F.lit("$"), F.format_number(m("Gross Revenue").cast("double"), 2))),
    }


# Parts of other measures; not measures a report shows.
PARTS = ("Returning Orders", "Known Users", "Cumulative Revenue Sum", "First Calendar Date")


def library(stages: Sequence[str] = STAGE_COLUMNS) -> dict:
    """Every measure by name. ``stages``: the six stage columns of the funnel fact."""
    return _executive() | _funnel(stages) | _retention() | _experiment() | _helpers()


def measure_names() -> list[str]:
    return [name for name in library() if name not in PARTS]


def _matches(df: DataFrame, filters: Mapping[str, object]) -> DataFrame:
    tests = []
    for column, wanted in filters.items():
        if column in df.columns:
            values = [wanted] if isinstance(wanted, str) or not isinstance(wanted, Sequence) else list(wanted)
            tests.append(F.col(column).isin(values))
    return df.where(all_of(tests)) if tests else df


def _aggregate(df: DataFrame, entity: str, parts: Mapping[str, Base], by: Sequence[str]) -> DataFrame:
    """One row per slice with every base measure of one fact."""
    inner, outer = [], []
    for name, part in parts.items():
        value, column = part.value(df), slug(name)
        if part.combine == "total":
            inner.append(F.sum(value).alias(column))
            outer.append(F.coalesce(F.sum(column), F.lit(0)).alias(column))
        elif part.combine == "money":
            inner.append(F.sum(unscaled(value, MONEY_PLACES)).alias(column))
            outer.append(scaled(F.sum(column), MONEY_PLACES).alias(column))
        elif part.combine == "entities":
            known = F.col(entity).isNotNull()
            inner.append(F.max(flag(value & known)).alias(column))
            outer.append(F.coalesce(F.sum(column), F.lit(0)).alias(column))
        else:
            pick = F.min if part.combine == "lowest" else F.max
            inner.append(pick(value).alias(column))
            outer.append(pick(column).alias(column))
    if any(part.combine == "entities" for part in parts.values()):
        return df.groupBy(*by, entity).agg(*inner).groupBy(*by).agg(*outer)
    finals = []
    for name, part in parts.items():
        value, column = part.value(df), slug(name)
        combine = {"total": lambda v: F.coalesce(F.sum(v), F.lit(0)), "money": lambda v: sum_exact(v, MONEY_PLACES)}
        combine |= {"lowest": F.min, "highest": F.max}
        finals.append(combine[part.combine](value).alias(column))
    return df.groupBy(*by).agg(*finals)


def measure_cube(
    df: DataFrame,
    fact: str,
    names: Sequence[str],
    slices: Sequence[str],
    numbers: DataFrame,
    stages: Sequence[str] = STAGE_COLUMNS,
) -> Cube:
    """What the measures ``names`` need of one fact, by slice, in a form that merges: see ``cubes``.

    ``numbers``: ``cubes.number_entities`` of the fact's entity. ``measures`` takes the cube in place of the fact.
    """
    known, parts, context = library(stages), {}, Context({})

    def visit(name: str) -> Column:
        entry = known[name]
        if isinstance(entry, Trend):
            raise ValueError(f"{name} needs a time axis")
        if isinstance(entry, Derived):
            return entry.formula(visit, context)
        if entry.fact == fact:
            parts[slug(name)] = entry
        return F.col(slug(name))

    for name in names:
        visit(name)
    states = {column: (part.combine, part.value(df)) for column, part in parts.items()}
    return build_cube(df, ENTITY[fact], slices, states, numbers, MONEY_PLACES)


def _from_cube(cube: Cube, parts: Mapping[str, Base], by: Sequence[str], filters: Mapping[str, object]) -> DataFrame:
    lost = [c for c in filters if c in cube.columns_of_fact and c not in cube.slices]
    if lost:
        raise KeyError(f"the cube keeps no {lost} to filter by")
    kept = Cube(_matches(cube.frame, filters), cube.slices, cube.states, cube.columns_of_fact)
    return kept.answer([slug(name) for name in parts], by, MONEY_PLACES)


def measures(
    tables: Mapping[str, DataFrame | Cube],
    names: Sequence[str],
    group_by: Sequence[str] = (),
    filters: Mapping[str, object] | None = None,
    as_of=None,
    stages: Sequence[str] = STAGE_COLUMNS,
) -> DataFrame:
    """Evaluate measures per slice: one row per combination of ``group_by`` values.

    ``tables`` maps fact and dimension names to frames. A filter applies to every table that
    has its column. Facts meet by a union of their few result rows, not by a join. A fact may be given as its
    ``measure_cube``; groups and filters are then among the cube's slices.
    """
    known, context = library(stages), Context(filters or {}, as_of)
    bases: dict[str, Base] = {}
    resolved: dict[str, Column] = {}

    def resolve(name: str) -> Column:
        if name not in resolved:
            entry = known[name]
            if isinstance(entry, Trend):
                raise ValueError(f"{name} needs a time axis: use daily_trend or monthly_growth")
            if isinstance(entry, Base):
                bases[name] = entry
                resolved[name] = F.col(slug(name))
            else:
                resolved[name] = entry.formula(resolve, context)
        return resolved[name]

    outputs = [resolve(name).alias(slug(name)) for name in names]
    by_fact: dict[str, dict[str, Base]] = {}
    for name, base in bases.items():
        by_fact.setdefault(base.fact, {})[name] = base

    result = None
    shared = []
    for fact, parts in by_fact.items():
        table = tables[fact]
        df = table if isinstance(table, Cube) else _matches(table, context.filters)
        missing = [c for c in group_by if c not in df.columns]
        if missing and fact != "dim_date":
            raise KeyError(f"{fact} has no {missing}")
        if missing:
            # The calendar is the same in every slice.
            shared.append(_aggregate(df, ENTITY[fact], parts, []))
            continue
        if isinstance(df, Cube):
            rows = _from_cube(df, parts, group_by, context.filters)
        else:
            rows = _aggregate(df, ENTITY[fact], parts, group_by)
        result = rows if result is None else result.unionByName(rows, allowMissingColumns=True)
    if result is None:
        if not shared:
            spark = next(iter(tables.values())).sparkSession
            return spark.range(1).select(F.col("id").alias("__n")).select(*outputs)
        result, shared = shared[0], []
    columns = [c for c in result.columns if c not in group_by]
    if len(by_fact) > 1:
        result = result.groupBy(*group_by).agg(*[F.max(c).alias(c) for c in columns])
    for extra in shared:
        for column in extra.columns:
            result = result.withColumn(column, extra.select(column).scalar())
    return result.select(*group_by, *outputs)


def daily_trend(
    orders: DataFrame, windows: Sequence[int] = (7, 30), by: Sequence[str] = (), every_day: bool = True
) -> DataFrame:
    """Gross revenue per calendar day with trailing means over calendar days.

    Days without orders count as zero; at the start of the calendar, which all slices share, the mean divides by the
    days there are. Orders without a date are left out.

    The window sees only the days on which a trailing sum changes: revenue enters it on its own day and leaves it
    after each window's length. The days between are filled in behind the window; ``every_day=False`` leaves them and
    the days without orders out, so a slice with few orders has few rows.
    """
    names = [f"__sum_{k}" for k in windows]
    daily = (
        orders.where(F.col("order_date").isNotNull())
        .groupBy(*by, F.col("order_date").alias("__day"))
        .agg(F.coalesce(F.sum(unscaled("subtotal_amount")), F.lit(0)).alias("__units"))
    )
    span = daily.agg(F.min("__day").alias("first"), F.max("__day").alias("last"))
    first, last = span.select("first").scalar(), span.select("last").scalar()
    units, none = F.col("__units"), F.lit(0).cast("bigint")

    def point(day, own, sums):
        columns = [day.alias("__day"), F.lit(own).alias("__own"), (units if own else none).alias("__units")]
        return F.struct(*columns, *[value.alias(name) for name, value in zip(names, sums)])

    changes = [point(F.col("__day"), True, [units] * len(names)), point(first, False, [none] * len(names))]
    for i, k in enumerate(windows):
        changes.append(point(F.date_add("__day", k), False, [-units if i == j else none for j in range(len(names))]))
    changing = (
        daily.select(*by, F.explode(F.array(*changes)).alias("__point"))
        .select(*by, "__point.*")
        .groupBy(*by, "__day")
        .agg(F.max("__own").alias("__own"), *[F.sum(c).alias(c) for c in ["__units", *names]])
        .where(F.col("__day") <= last)
    )
    order = Window.partitionBy(*by).orderBy("__day")
    running = changing.select(
        *by,
        "__day",
        "__own",
        "__units",
        *[F.sum(n).over(order).alias(n) for n in names],
        F.coalesce(F.date_sub(F.lead("__day").over(order), 1), last).alias("__until"),
    )
    if every_day:
        days = running.withColumn("order_date", F.explode(F.sequence("__day", "__until")))
    else:
        days = running.where("__own").withColumn("order_date", F.col("__day"))
    revenue = scaled(F.when(F.col("order_date") == F.col("__day"), units).otherwise(0))
    since_first = F.date_diff("order_date", first) + 1
    means = [
        safe_divide(scaled(n), F.least(F.lit(k), since_first), 0).alias(f"revenue_{k}_day_moving_avg")
        for n, k in zip(names, windows)
    ]
    return days.select(*by, "order_date", revenue.alias("gross_revenue"), *means)


def monthly_growth(orders: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Gross revenue per month against the month and the year before; null without one."""
    month = F.trunc("order_date", "MM")
    monthly = orders.groupBy(*by, month.alias("month")).agg(sum_exact("subtotal_amount").alias("gross_revenue"))
    keys = [*by, "month"]

    def shifted(months, name):
        return monthly.select(*by, F.add_months("month", months).alias("month"), F.col("gross_revenue").alias(name))

    joined = monthly.join(shifted(1, "__month"), keys, "left").join(shifted(12, "__year"), keys, "left")
    revenue = F.col("gross_revenue")
    return joined.select(
        *keys,
        "gross_revenue",
        safe_divide(revenue - F.col("__month"), "__month").alias("mom_revenue_growth_pct"),
        safe_divide(revenue - F.col("__year"), "__year").alias("yoy_revenue_growth_pct"),
    )


def order_share(orders: DataFrame, dimension: str = "customer_segment") -> DataFrame:
    """Completed orders per value of a dimension and their share of all."""
    counts = measures({"fct_orders": orders}, ["Total Orders"], [dimension])
    whole = Window.partitionBy()  # one row per dimension value
    return counts.withColumn("order_share", safe_divide("total_orders", F.sum("total_orders").over(whole)))
