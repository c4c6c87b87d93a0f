"""Declared data-quality assertions, a runner, a gate, and table invariants."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchlens.functions.scalar import MONEY, flag, money
from merchlens.functions.stats import chi_square, chi_square_p

RESULT = "table string, column string, kind string, failures bigint, errored boolean, passed boolean"


@dataclass(frozen=True)
class Check:
    """One assertion. ``kind``: unique, not_null, accepted_values, relationships or check."""

    table: str
    column: str
    kind: str
    values: tuple = ()
    parent: tuple[str, str] | None = None
    predicate: Column | None = field(default=None, compare=False)


# The declared assertions, per model.
SEGMENTS = ("VIP", "Regular", "Bargain")
DEVICES = ("Desktop", "Mobile", "Tablet")
VARIANTS = ("control", "treatment")
STATUSES = ("completed", "cancelled", "refunded", "pending")
EVENT_TYPES = ("landing_page", "product_view", "add_to_cart", "checkout_started", "payment_started", "purchase")
BINARY = (0, 1)
STEPS = (1, 2, 3, 4, 5, 6)
STEPS_OR_NONE = (0, 1, 2, 3, 4, 5, 6)
DECLARED = {
    "stg_users": {
        "unique": "user_id",
        "not_null": "user_id signup_timestamp signup_date country acquisition_channel customer_segment",
        "accepted_values": {"customer_segment": SEGMENTS},
    },
    "stg_sessions": {
        "unique": "session_id",
        "not_null": "session_id user_id session_start session_end session_date session_duration_seconds device_type "
        "ab_variant",
        "accepted_values": {"device_type": DEVICES, "ab_variant": VARIANTS},
        "relationships": {"user_id": ("stg_users", "user_id")},
    },
    "stg_events": {
        "unique": "event_id",
        "not_null": "event_id session_id user_id event_timestamp event_type step_number",
        "accepted_values": {"event_type": EVENT_TYPES, "step_number": STEPS},
        "relationships": {"session_id": ("stg_sessions", "session_id"), "user_id": ("stg_users", "user_id")},
    },
    "stg_orders": {
        "unique": "order_id",
        "not_null": "order_id session_id user_id order_date total_amount status",
        "accepted_values": {"status": STATUSES},
        "relationships": {"session_id": ("stg_sessions", "session_id"), "user_id": ("stg_users", "user_id")},
    },
    "stg_order_items": {
        "unique": "order_item_id",
        "not_null": "order_item_id order_id product_id quantity unit_price line_total",
        "relationships": {"order_id": ("stg_orders", "order_id"), "product_id": ("stg_products", "product_id")},
    },
    "stg_products": {"unique": "product_id", "not_null": "product_id product_name category cost price"},
    "int_session_funnel_events": {
        "unique": "session_id",
        "not_null": "session_id user_id furthest_step_reached reached_landing_page reached_purchase",
        "accepted_values": {"furthest_step_reached": STEPS_OR_NONE},
    },
    "int_order_items_aggregated": {"unique": "order_id", "not_null": "order_id total_items_count total_cogs gross_profit"},
    "int_user_order_summary": {
        "unique": "user_id",
        "not_null": "user_id lifetime_orders lifetime_revenue first_order_date",
    },
    "int_user_cohort_monthly": {"not_null": "user_id cohort_month activity_month month_offset"},
    "int_ab_session_conversions": {
        "unique": "session_id",
        "not_null": "session_id ab_variant has_checkout_started",
        "accepted_values": {"ab_variant": VARIANTS},
    },
    "fct_funnel": {
        "unique": "session_id",
        "not_null": "session_id user_id session_start session_end session_date session_duration_seconds device_type "
        "traffic_source country customer_segment ab_variant is_returning_user furthest_step_reached "
        "funnel_stage_order is_converting_session",
        "accepted_values": {
            "device_type": DEVICES,
            "ab_variant": VARIANTS,
            "funnel_stage_order": STEPS_OR_NONE,
            "is_converting_session": BINARY,
        },
        "relationships": {"user_id": ("dim_users", "user_id")},
    },
    "fct_orders": {
        "unique": "order_id",
        "not_null": "order_id session_id user_id order_timestamp order_date status total_amount gross_profit ab_variant "
        "total_items_count item_count subtotal shipping_fee total_cost gross_margin_amount user_order_sequence",
        "accepted_values": {"status": STATUSES, "ab_variant": VARIANTS},
        "relationships": {"session_id": ("fct_funnel", "session_id"), "user_id": ("dim_users", "user_id")},
    },
    "fct_user_retention": {
        "not_null": "user_id cohort_month activity_month month_offset monthly_orders orders_in_month monthly_revenue "
        "revenue_in_month is_retained",
        "relationships": {"user_id": ("dim_users", "user_id")},
    },
    "fct_ab_test": {
        "unique": "session_id",
        "not_null": "session_id user_id session_date ab_variant completed_payment completed_purchase",
        "accepted_values": {"ab_variant": VARIANTS, "completed_payment": BINARY, "completed_purchase": BINARY},
        "relationships": {"user_id": ("dim_users", "user_id")},
    },
    "dim_users": {
        "unique": "user_id",
        "not_null": "user_id first_seen_at signup_timestamp signup_date country customer_segment lifetime_sessions "
        "lifetime_orders lifetime_revenue frequency_band monetary_tier customer_lifecycle_status",
        "accepted_values": {"customer_segment": SEGMENTS},
    },
    "dim_products": {
        "unique": "product_id",
        "not_null": "product_id product_name category cost price margin_amount margin_percentage total_units_sold",
    },
    "dim_date": {"unique": "date_day", "not_null": "date_day year quarter month is_weekend"},
}


def declared_checks(models: Iterable[str] | None = None) -> list[Check]:
    checks = []
    for table, kinds in DECLARED.items():
        if models is not None and table not in models:
            continue
        checks += [Check(table, c, "unique") for c in kinds.get("unique", "").split()]
        checks += [Check(table, c, "not_null") for c in kinds.get("not_null", "").split()]
        checks += [Check(table, c, "accepted_values", v) for c, v in kinds.get("accepted_values", {}).items()]
        checks += [Check(table, c, "relationships", parent=p) for c, p in kinds.get("relationships", {}).items()]
    return checks


def value_check(table: str, name: str, predicate: Column) -> Check:
    """A row constraint such as ``total >= 0``; rows where it is null pass."""
    return Check(table, name, "check", predicate=predicate)


def _row_failure(check: Check) -> Column:
    if check.kind == "not_null":
        return F.col(check.column).isNull()
    if check.kind == "accepted_values":
        return ~F.col(check.column).isin(*check.values)
    return ~check.predicate


def duplicated_values(df: DataFrame, *columns: str) -> DataFrame:
    """Values (or value combinations) that occur more than once, with their count."""
    filled = df
    for column in columns:
        filled = filled.where(F.col(column).isNotNull())
    return filled.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Non-null child keys without a parent, and how many child rows hold each.

    Both sides shrink to one row per key before the join, so a hot key costs one row.
    """
    keys = child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    known = parent.select(F.col(parent_key).alias("__parent")).distinct()
    return keys.join(known, F.col(key) == F.col("__parent"), "left_anti")


def childless(parent: DataFrame, key: str, child: DataFrame, child_key: str) -> DataFrame:
    """Parent rows that no child refers to."""
    used = child.select(F.col(child_key).alias("__child")).distinct()
    return parent.join(used, F.col(key) == F.col("__child"), "left_anti")


def _entry(df: DataFrame, column: str, kind, space: int, slot: int) -> Column:
    """One value of a key in the type ``kind``, whole numbers as numbers and all else as text; a value that has no such
    form equals none that has."""
    value = F.col(column)
    same, whole = df.schema[column].dataType == kind, isinstance(kind, T.IntegralType)
    known = value if same else value.try_cast(kind)
    foreign = F.concat(F.lit("not a key: "), value.cast("string"))
    if whole:
        number, text = known.cast("bigint"), F.lit(None).cast("string") if same else F.when(known.isNull(), foreign)
    else:
        number, text = F.lit(None).cast("bigint"), known.cast("string") if same else F.coalesce(known.cast("string"), foreign)
    return F.struct(F.lit(space).alias("space"), F.lit(slot).alias("slot"), number.alias("number"), text.alias("text"))


def key_failures(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """One row with f0, f1, ..: the failures of each unique or relationships assertion. One scan per table.

    A table's key columns are stacked into rows of (key space, slot, value) and counted before the one shuffle, so a hot
    key costs one row. A key space is one parent column; the values that its own table (slot 0) or its children (a slot
    each) hold meet there. Unique: values held more than once. Relationships: child rows whose value the parent does not
    hold. Nulls pass.
    """
    spaces: dict[tuple[str, str], int] = {}
    children: dict[tuple[str, str], int] = {}
    entries: dict[str, list[Column]] = {}

    def enter(table: str, column: str, key: tuple[str, str], slot: int) -> None:
        kind = tables[key[0]].schema[key[1]].dataType
        entries.setdefault(table, []).append(_entry(tables[table], column, kind, spaces[key], slot))

    found = {}
    for i, check in enumerate(checks):
        if check.kind not in ("unique", "relationships"):
            continue
        key = (check.table, check.column) if check.kind == "unique" else check.parent
        if key not in spaces:
            spaces[key] = len(spaces)
            enter(*key, key, 0)
        here = F.col("space") == spaces[key]
        if check.kind == "unique":
            found[i] = F.when(here & (F.col("s0") > 1), 1)
        else:
            slot = children[key] = children.get(key, 0) + 1
            enter(check.table, check.column, key, slot)
            found[i] = F.when(here & (F.col("s0") == 0), F.col(f"s{slot}"))
    stacked = None
    for table, columns in entries.items():
        rows = tables[table].select(F.inline(F.array(*columns))).where("number IS NOT NULL OR text IS NOT NULL")
        stacked = rows if stacked is None else stacked.unionByName(rows)
    slots = range(max(children.values(), default=0) + 1)
    met = stacked.groupBy("space", "number", "text").agg(*(F.count_if(F.col("slot") == s).alias(f"s{s}") for s in slots))
    return met.agg(*(F.coalesce(F.sum(found[i]) if i in found else F.lit(0), F.lit(0)).alias(f"f{i}") for i in range(len(checks))))


def _named(counts: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row per assertion from one row with f0, f1, .."""
    named = [
        F.struct(
            F.lit(c.table).alias("table"),
            F.lit(c.column).alias("column"),
            F.lit(c.kind).alias("kind"),
            F.col(f"f{i}").cast("bigint").alias("failures"),
            F.lit(False).alias("errored"),
        )
        for i, c in enumerate(checks)
    ]
    return counts.select(F.explode(F.array(*named)).alias("r")).select("r.*")


def run_checks(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """One row per assertion: failures and whether it passed.

    All row conditions of a table share one scan, all its keys another. A missing table or column counts
    as one failure, as an exception does.
    """
    spark = next(iter(tables.values())).sparkSession
    parts, broken = [], []
    by_table: dict[str, list[Check]] = {}
    for check in checks:
        needed = [(check.table, check.column)] if check.kind != "check" else [(check.table, None)]
        needed += [check.parent] if check.parent else []
        if all(t in tables and (c is None or c in tables[t].columns) for t, c in needed):
            by_table.setdefault(check.table, []).append(check)
        else:
            broken.append((check.table, check.column, check.kind, 1, True))
    for table, group in by_table.items():
        rows = [c for c in group if c.kind in ("not_null", "accepted_values", "check")]
        if rows:
            counts = tables[table].agg(*[F.count_if(_row_failure(c)).alias(f"f{i}") for i, c in enumerate(rows)])
            parts.append(_named(counts, rows))
    keys = [c for group in by_table.values() for c in group if c.kind in ("unique", "relationships")]
    if keys:
        parts.append(_named(key_failures(tables, keys), keys))
    if broken:
        parts.append(spark.createDataFrame(broken, RESULT.replace(", passed boolean", "")))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result.withColumn("passed", F.col("failures") == 0)


class GateTripped(RuntimeError):
    """Raised by ``gate``; ``incidents`` lists the failed assertions."""

    def __init__(self, incidents):
        self.incidents = incidents
        super().__init__(f"{len(incidents)} assertion(s) failed: {incidents[:5]}")


def incidents(results: DataFrame, threshold: int = 0) -> DataFrame:
    """Alert rows of a run: at most one per assertion."""
    return results.where(F.col("failures") > threshold).select(
        F.concat_ws("_", "kind", "table", "column").alias("assertion"),
        "failures",
        F.when(F.col("errored"), "ERROR").otherwise("FAIL").alias("state"),
    )


def gate(results: DataFrame, threshold: int = 0) -> None:
    """Stop the steps that follow when an assertion fails more than ``threshold`` times."""
    failed = [tuple(row) for row in incidents(results, threshold).collect()]
    if failed:
        raise GateTripped(failed)


def row_floor(df: DataFrame, least: int) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", F.lit(least).cast("bigint").alias("required"), (F.col("rows") >= least).alias("passed")
    )


# The foreign keys of the raw tables.
FOREIGN_KEYS = (
    ("sessions", "user_id", "users", "user_id"),
    ("events", "session_id", "sessions", "session_id"),
    ("events", "user_id", "users", "user_id"),
    ("events", "product_id", "products", "product_id"),
    ("orders", "session_id", "sessions", "session_id"),
    ("orders", "user_id", "users", "user_id"),
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "product_id", "products", "product_id"),
)


def orphan_report(tables: Mapping[str, DataFrame], keys=FOREIGN_KEYS) -> DataFrame:
    """Orphan rows per foreign key, and in total."""
    checks = [Check(child, column, "relationships", parent=(parent, target)) for child, column, parent, target in keys]
    found = _named(key_failures(tables, checks), checks)
    result = found.select(F.concat_ws(".", "table", "column").alias("foreign_key"), F.col("failures").alias("orphan_rows"))
    summed = result.rollup("foreign_key").agg(F.sum("orphan_rows").alias("orphan_rows"))
    return summed.select(F.coalesce("foreign_key", F.lit("total")).alias("foreign_key"), "orphan_rows")


def attribute_mismatches(
    child: DataFrame, key: str, parent: DataFrame, attributes: Mapping[str, str]
) -> DataFrame:
    """Rows whose attributes disagree with their parent's. ``attributes``: child -> parent column."""
    known = parent.select(key, *[F.col(p).alias(f"__{c}") for c, p in attributes.items()])
    joined = child.select(key, *attributes).join(known, key)
    return joined.agg(
        F.count(F.lit(1)).alias("compared"),
        *[F.count_if(~F.col(c).eqNullSafe(F.col(f"__{c}"))).alias(f"{c}_mismatches") for c in attributes],
    )


def outside_session(events: DataFrame, sessions: DataFrame) -> DataFrame:
    """Events before the start or after the end of their session."""
    bounds = sessions.select("session_id", "session_start", "session_end")
    return events.select("session_id", "event_timestamp").join(bounds, "session_id").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("event_timestamp") < F.col("session_start")).alias("before_start"),
        F.count_if(F.col("event_timestamp") > F.col("session_end")).alias("after_end"),
    )


def _violations(frame: DataFrame, name: str, column: str = "violations") -> DataFrame:
    return frame.select(F.lit(name).alias("rule"), F.coalesce(F.col(column), F.lit(0)).alias("violations"))


def temporal_order(
    users: DataFrame, sessions: DataFrame, events: DataFrame, orders: DataFrame, items: DataFrame, products: DataFrame,
    purchase: str = "purchase",
) -> DataFrame:
    """Rows that break the order of time, per rule.

    Order rows are compared with the first purchase event of their session.
    """
    signups = users.select("user_id", "signup_timestamp")
    early = sessions.join(signups, "user_id").agg(
        F.count_if(F.col("session_start") < F.col("signup_timestamp")).alias("violations")
    )
    backwards = sessions.agg(F.count_if(F.col("session_end") < F.col("session_start")).alias("violations"))
    bounds = outside_session(events, sessions).select(
        (F.col("before_start") + F.col("after_end")).alias("violations")
    )
    bought = events.where(F.col("event_type") == purchase).groupBy("session_id").agg(
        F.min("event_timestamp").alias("bought_at")
    )
    untimely = orders.join(bought, "session_id").agg(
        F.count_if(F.col("order_timestamp") != F.col("bought_at")).alias("violations")
    )
    misdated = orders.agg(
        F.count_if(F.col("order_date") != F.col("order_timestamp").cast("date")).alias("violations")
    )
    created = products.select("product_id", F.col("created_at").alias("launched"))
    when = orders.select("order_id", F.col("order_timestamp").cast("date").alias("ordered"))
    premature = items.select("order_id", "product_id").join(created, "product_id").join(when, "order_id").agg(
        F.count_if(F.col("ordered") < F.col("launched")).alias("violations")
    )
    rules = {
        "session_before_signup": early,
        "session_ends_before_start": backwards,
        "event_outside_session": bounds,
        "order_time_not_purchase_time": untimely,
        "order_date_not_timestamp_date": misdated,
        "item_before_product": premature,
    }
    result = None
    for name, frame in rules.items():
        row = _violations(frame, name)
        result = row if result is None else result.unionByName(row)
    return result


def funnel_validity(events: DataFrame, orders: DataFrame, steps: int = 6, purchase: str = "purchase") -> DataFrame:
    """Strictly shrinking stage counts, skipped steps, and purchases against orders."""
    per_session = events.groupBy("session_id").agg(
        F.min("step_number").alias("first"),
        F.max("step_number").alias("last"),
        F.count("step_number").alias("events"),
        F.count_if(F.col("event_type") == purchase).alias("purchases"),
        *[F.max(flag(F.col("step_number") == k)).alias(f"s{k}") for k in range(1, steps + 1)],
    )
    totals = per_session.agg(
        *[F.sum(f"s{k}").alias(f"step_{k}_sessions") for k in range(1, steps + 1)],
        F.count_if((F.col("first") != 1) | (F.col("last") != F.col("events"))).alias("sessions_with_skipped_steps"),
        F.sum("purchases").alias("purchase_events"),
    )
    shrinking = F.lit(True)
    for k in range(1, steps):
        shrinking = shrinking & (F.col(f"step_{k}_sessions") > F.col(f"step_{k + 1}_sessions"))
    placed = orders.agg(F.count(F.lit(1))).scalar()
    return totals.select(
        "*",
        shrinking.alias("strictly_decreasing"),
        placed.alias("orders"),
        (F.col("purchase_events") == placed).alias("purchases_match_orders"),
    )


def key_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys on one side only, with the side."""
    a = left.select(key).where(F.col(key).isNotNull()).distinct().withColumn("__l", F.lit(1))
    b = right.select(key).where(F.col(key).isNotNull()).distinct().withColumn("__r", F.lit(1))
    joined = a.join(b, key, "full").where(F.col("__l").isNull() | F.col("__r").isNull())
    return joined.select(key, F.when(F.col("__l").isNull(), "right").otherwise("left").alias("only_in"))


def financial_reconciliation(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Largest difference and number of rows per money identity, in decimals."""
    lines = items.groupBy("order_id").agg(F.sum("line_total").alias("lines"))
    subtotal = orders.join(lines, "order_id").select(
        F.lit("subtotal_is_sum_of_lines").alias("rule"), F.abs(F.col("lines") - F.col("subtotal")).alias("gap")
    )
    due = F.col("subtotal") + F.col("tax_amount") + F.col("shipping_fee") - F.col("discount_amount")
    total = orders.select(F.lit("total_is_sum_of_parts").alias("rule"), F.abs(F.col("total_amount") - due).alias("gap"))
    line = items.select(
        F.lit("line_is_quantity_times_price").alias("rule"),
        F.abs(F.col("line_total") - F.col("quantity") * F.col("unit_price")).alias("gap"),
    )
    profit = items.select(
        F.lit("profit_is_quantity_times_margin").alias("rule"),
        F.abs(F.col("line_profit") - F.col("quantity") * (F.col("unit_price") - F.col("unit_cost"))).alias("gap"),
    )
    gaps = None
    for part in (subtotal, total, line, profit):
        part = part.select("rule", F.col("gap").cast("decimal(20,2)").alias("gap"))
        gaps = part if gaps is None else gaps.unionByName(part)
    return gaps.groupBy("rule").agg(
        F.count("gap").alias("compared"),
        F.count_if(F.col("gap") >= F.lit(0.01).cast("decimal(3,2)")).alias("violations"),
        F.max("gap").alias("max_difference"),
    )


@dataclass(frozen=True)
class Pricing:
    """Rule parameters; further sets in use: (8 %, 100, 5.00) and (8 %, 100, 9.99)."""

    tax_rate: str = "0.0825"
    free_shipping_from: int = 75
    shipping_fee: str = "5.99"
    vip_segment: str = "VIP"
    vip_discount: str = "0.10"


def priced(orders: DataFrame, rule: Pricing = Pricing()) -> DataFrame:
    """Expected discount, shipping, tax and total of orders with ``subtotal`` and ``customer_segment``."""
    subtotal = F.col("subtotal")
    share = F.when(F.col("customer_segment") == rule.vip_segment, F.lit(rule.vip_discount).cast("decimal(4,2)"))
    discount = F.round(subtotal * F.coalesce(share, F.lit("0.00").cast("decimal(4,2)")), 2)
    shipping = F.when(subtotal >= rule.free_shipping_from, F.lit("0.00").cast(MONEY)).otherwise(
        F.lit(rule.shipping_fee).cast(MONEY)
    )
    taxable = F.greatest(F.lit(0).cast(MONEY), (subtotal - F.col("expected_discount")).cast(MONEY))
    tax = F.round(taxable * F.lit(rule.tax_rate).cast("decimal(6,4)"), 2)
    step = orders.withColumn("expected_discount", money(discount)).withColumn("expected_shipping", shipping)
    step = step.withColumn("expected_tax", money(tax))
    due = subtotal + F.col("expected_tax") + F.col("expected_shipping") - F.col("expected_discount")
    return step.withColumn("expected_total", money(due))


def pricing_violations(orders: DataFrame, rule: Pricing = Pricing()) -> DataFrame:
    """Orders whose shipping or tax differs from the rule (the discount is taken as given)."""
    given = orders.withColumn("__given", F.coalesce("discount_amount", F.lit(0).cast(MONEY)))
    shipping = F.when(F.col("subtotal") >= rule.free_shipping_from, F.lit("0.00").cast(MONEY)).otherwise(
        F.lit(rule.shipping_fee).cast(MONEY)
    )
    taxable = F.greatest(F.lit(0).cast(MONEY), (F.col("subtotal") - F.col("__given")).cast(MONEY))
    tax = F.round(taxable * F.lit(rule.tax_rate).cast("decimal(6,4)"), 2)
    return given.agg(
        F.count(F.lit(1)).alias("orders"),
        F.count_if(F.col("shipping_fee") != shipping).alias("shipping_violations"),
        F.count_if(F.abs(F.col("tax_amount") - tax) > F.lit("0.01").cast(MONEY)).alias("tax_violations"),
        F.count_if(F.col("total_amount") <= 0).alias("non_positive_totals"),
    )


def allocation_check(events: DataFrame, sessions: DataFrame, orders: DataFrame, entry: str, alpha: float = 0.01) -> DataFrame:
    """Arms at the entry stage, their chi-square and p-value, conversions and lift."""
    entered = events.where(F.col("event_type") == entry).select("session_id").distinct()
    arms = sessions.select("session_id", "ab_variant").join(entered, "session_id", "left_semi").agg(
        F.count_if(F.col("ab_variant") == "control").alias("n_control"),
        F.count_if(F.col("ab_variant") == "treatment").alias("n_treatment"),
    )
    bought = orders.agg(
        F.count_if(F.col("ab_variant") == "control").alias("conversions_control"),
        F.count_if(F.col("ab_variant") == "treatment").alias("conversions_treatment"),
    )
    columns = ["n_control", "n_treatment", "conversions_control", "conversions_treatment"]
    both = arms.unionByName(bought, allowMissingColumns=True).agg(*[F.max(c).alias(c) for c in columns])
    half = (F.col("n_control") + F.col("n_treatment")) / 2.0
    tested = both.withColumn(
        "srm_chi2", F.round(chi_square([F.col("n_control"), F.col("n_treatment")], [half, half]), 4)
    )
    control = F.try_divide(F.col("conversions_control").cast("double"), F.col("n_control").cast("double"))
    treatment = F.try_divide(F.col("conversions_treatment").cast("double"), F.col("n_treatment").cast("double"))
    lift = F.round(F.try_divide(treatment - control, control) * 100.0, 2)
    return tested.withColumn("empirical_relative_lift_pct", lift).withColumn(
        "srm_p_value", F.round(chi_square_p(F.col("srm_chi2")), 6)
    ).withColumn("passed", (F.col("srm_p_value") >= alpha) & (F.col("n_control") > 0) & (F.col("n_treatment") > 0))


def profit_identity(fact_orders: DataFrame) -> DataFrame:
    """Orders whose profit is not subtotal less cost, and margins out of bounds."""
    expected = F.col("subtotal_amount") - F.col("total_cogs")
    paid = F.col("total_amount") - F.col("tax_amount") - F.col("shipping_amount") + F.col("discount_amount")
    profit = F.round("gross_profit", 2)
    return fact_orders.agg(
        F.count(F.lit(1)).alias("orders"),
        F.count_if(profit != F.round(expected, 2)).alias("subtotal_mismatches"),
        F.count_if(profit != F.round(paid - F.col("total_cogs"), 2)).alias("total_mismatches"),
        F.max(F.abs(profit - F.round(expected, 2))).alias("max_difference"),
        F.count_if((F.col("margin_rate") < 0) | (F.col("margin_rate") > 1)).alias("margins_out_of_bounds"),
    )


def layer_totals(layers: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """The same money total in several layers, and its spread (0 when they agree)."""
    result = None
    for name, (df, column) in layers.items():
        row = df.agg(F.sum(money(column)).alias("total")).select(F.lit(name).alias("layer"), "total")
        result = row if result is None else result.unionByName(row)
    spread = result.agg((F.max("total") - F.min("total")).alias("spread")).scalar()
    return result.withColumn("spread", spread)


def audit(df: DataFrame, amount: str = "total_amount") -> DataFrame:
    """Row count, total and mean of an amount."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.round(F.sum(amount), 2).alias("total"),
        F.round(F.avg(amount), 2).alias("mean"),
    )


def hashed_requests(requests: DataFrame, payload: Sequence[str]) -> DataFrame:
    """``requests`` and the hash of what they ask for."""
    return requests.withColumn("request_hash", F.sha2(F.to_json(F.struct(*payload)), 256))


def first_requests(requests: DataFrame, user: str, key: str, at: str, payload: Sequence[str]) -> DataFrame:
    """What is kept: one row per (user, key), the first; with the number of replays and conflicts.

    Two combining aggregates and no window or join, so a key repeated any number of times
    costs one row per distinct payload.
    """
    by_payload = hashed_requests(requests, payload).groupBy(user, key, "request_hash").agg(
        F.min(at).alias("first_at"), F.count(F.lit(1)).alias("requests")
    )
    order = F.struct("first_at", "request_hash")
    return by_payload.groupBy(user, key).agg(
        F.min_by("request_hash", order).alias("request_hash"),
        F.min("first_at").alias("first_at"),
        F.sum("requests").alias("requests"),
        (F.sum("requests") - F.min_by("requests", order)).alias("conflicts"),
    )


def conflicting_requests(requests: DataFrame, user: str, key: str, at: str, payload: Sequence[str]) -> DataFrame:
    """Requests that reuse a key with a different payload than its first request."""
    kept = first_requests(requests, user, key, at, payload)
    first = kept.select(user, key, F.col("request_hash").alias("first_hash"), "first_at")
    matched = hashed_requests(requests, payload).join(first, [user, key])
    return matched.where(F.col("request_hash") != F.col("first_hash"))
