"""Bind the TPC-H-like test tables to the six raw tables the operators expect.

Two disjoint worlds: orders (orders, lineitem, part, customer) and clicks (events). Text
columns carry blanks and mixed case on purpose, so that staging has something to clean.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlens.functions.scalar import MONEY, money, sum_exact
from merchlens.operators.sessions import Stage, user_days

# Fixed values of the bindings.
CLICK_STAGES = (Stage(1, "view"), Stage(2, "click"), Stage(3, "signup"), Stage(4, "purchase"))
EXPERIMENT = "checkout_optimization"
BOUND_SIGNUP_START = "1994-12-01"


# The columns of the test tables. Stating them saves a schema-inference job per read.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}
RAW = ("users", "products", "sessions", "events", "orders", "order_items")


class RawTables:
    """The six raw tables by name, each built when first asked for."""

    def __init__(self, **builders: Callable[[], DataFrame]):
        missing = set(RAW) - set(builders)
        if missing:
            raise KeyError(f"missing raw tables: {sorted(missing)}")
        self._builders, self._built = builders, {}

    @classmethod
    def of(cls, **frames: DataFrame) -> RawTables:
        return cls(**{name: (lambda frame=frame: frame) for name, frame in frames.items()})

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self._builders:
            raise AttributeError(name)
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def items(self):
        return [(name, getattr(self, name)) for name in RAW]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _device(user):
    third = F.col(user) % 3
    return F.when(third == 0, "Desktop").when(third == 1, "Mobile").otherwise("Tablet")


def _padded(text):
    return F.concat(F.lit(" "), text, F.lit(" "))


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    placed = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    signup = F.date_add(F.lit(BOUND_SIGNUP_START).cast("date"), (F.col("c_custkey") % 31).cast("int"))
    return placed.select(
        F.col("c_custkey").alias("user_id"),
        signup.cast("timestamp_ntz").alias("created_at"),
        _padded(F.lower("n_name")).alias("country"),
        _padded(F.col("r_name")).alias("acquisition_channel"),
        _padded(F.col("c_mktsegment")).alias("customer_segment"),
        _device("c_custkey").alias("device_preference"),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = money("p_retailprice")
    cost = (price * 6 / 10).cast(MONEY)
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        _padded(F.col("p_name")).alias("product_name"),
        _padded(F.col("p_type")).alias("category"),
        cost.alias("cost"),
        price.alias("price"),
        (price - cost).cast(MONEY).alias("margin"),
        F.col("p_size").alias("inventory_count"),
        F.lit(BOUND_SIGNUP_START).cast("date").alias("created_at"),
    )


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with catalog price and cost. The line reference is not unique in the data."""
    catalog = raw_products(spark, sf_dir).select("product_id", "price", "cost")
    lines = table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("order_item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        money("l_extendedprice").alias("line_total"),
    )
    profit = F.col("line_total") - F.col("quantity") * F.col("cost")
    return lines.join(catalog, "product_id").select(
        "order_item_id",
        "order_id",
        "product_id",
        "quantity",
        F.col("price").alias("unit_price"),
        F.col("cost").alias("unit_cost"),
        "line_total",
        F.lit(None).cast(MONEY).alias("total_item_price"),
        profit.cast(MONEY).alias("line_profit"),
    )


def _order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderkey").alias("session_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_orderdate").alias("order_timestamp"),
        money("o_totalprice").alias("total_amount"),
        F.col("o_orderpriority").alias("payment_method"),
        F.when(F.col("o_orderstatus") == "F", " Completed ")
        .when(F.col("o_orderstatus") == "O", " Pending ")
        .otherwise(" Cancelled ")
        .alias("status"),
        F.when(F.col("o_orderkey") % 2 == 0, " Control ").otherwise(" Treatment ").alias("ab_variant"),
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders; the subtotal is the sum of the lines, null for orders without lines."""
    subtotal = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("order_id"))
        .agg(sum_exact(money("l_extendedprice")).cast(MONEY).alias("subtotal"))
    )
    nothing = F.lit(None).cast(MONEY)
    return _order_rows(spark, sf_dir).join(subtotal, "order_id", "left").select(
        "order_id",
        "session_id",
        "user_id",
        "order_date",
        "order_timestamp",
        "subtotal",
        nothing.alias("tax_amount"),
        nothing.alias("shipping_fee"),
        nothing.alias("discount_amount"),
        "total_amount",
        "payment_method",
        "status",
        "ab_variant",
    )


def raw_order_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One session per order."""
    unknown = F.lit(None).cast("boolean")
    return _order_rows(spark, sf_dir).select(
        "session_id",
        "user_id",
        F.col("order_timestamp").alias("session_start"),
        F.col("order_timestamp").alias("session_end"),
        _device("user_id").alias("device_type"),
        F.lit(None).cast("string").alias("country"),
        _padded(F.col("payment_method")).alias("traffic_source"),
        F.col("payment_method").alias("channel"),
        F.lit(False).alias("is_bounce"),
        unknown.alias("is_returning_user"),
        unknown.alias("is_new_user"),
        "ab_variant",
        F.lit(EXPERIMENT).alias("experiment_id"),
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_columns(table(spark, sf_dir, "events"))


def event_columns(events: DataFrame) -> DataFrame:
    """Raw click events; a session is one user's calendar day. Works on a stream as well."""
    step = F.lit(0)
    for stage in CLICK_STAGES:
        step = F.when(F.col("event_type") == stage.name, stage.step).otherwise(step)
    product = (F.col("event_id") % 200).cast("string")
    return events.select(
        "event_id",
        F.concat_ws("-", F.col("user_id").cast("string"), F.col("ts").cast("date").cast("string")).alias("session_id"),
        "user_id",
        F.col("ts").alias("event_timestamp"),
        _padded(F.upper("event_type")).alias("event_name"),
        _padded(F.initcap("event_type")).alias("event_type"),
        step.alias("step_number"),
        F.concat(F.lit(" /"), F.col("event_type")).alias("page_url"),
        F.when(F.col("event_id") % 5 == 0, F.lit(" ")).otherwise(product).alias("product_id"),
        money("value").alias("cart_value"),
    )


def _variant(user, day):
    return F.when((F.col(user) + F.dayofmonth(day)) % 2 == 0, " Control ").otherwise(" Treatment ")


def raw_click_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = user_days(raw_events(spark, sf_dir).select("session_id", "user_id", "event_timestamp", "step_number"))
    source = F.element_at(
        F.array(F.lit("organic"), F.lit("paid_search"), F.lit("direct"), F.lit("social")),
        (F.col("user_id") % 4 + 1).cast("int"),
    )
    returning = F.col("session_sequence") > 1
    return days.select(
        "session_id",
        "user_id",
        "session_start",
        "session_end",
        _device("user_id").alias("device_type"),
        F.concat(F.lit("geo_"), (F.col("user_id") % 7).cast("string")).alias("country"),
        _padded(source).alias("traffic_source"),
        source.alias("channel"),
        (F.col("furthest_step") == 1).alias("is_bounce"),
        returning.alias("is_returning_user"),
        (~returning).alias("is_new_user"),
        _variant("user_id", F.col("session_start")).alias("ab_variant"),
        F.lit(EXPERIMENT).alias("experiment_id"),
    )


def raw_click_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One completed order per purchase event."""
    bought = table(spark, sf_dir, "events").where(F.col("event_type") == "purchase")
    nothing = F.lit(None).cast(MONEY)
    day = F.col("ts").cast("date")
    return bought.select(
        F.col("event_id").alias("order_id"),
        F.concat_ws("-", F.col("user_id").cast("string"), day.cast("string")).alias("session_id"),
        "user_id",
        day.alias("order_date"),
        F.col("ts").alias("order_timestamp"),
        money("value").alias("subtotal"),
        nothing.alias("tax_amount"),
        nothing.alias("shipping_fee"),
        nothing.alias("discount_amount"),
        money("value").alias("total_amount"),
        F.lit("card").alias("payment_method"),
        F.lit(" Completed ").alias("status"),
        _variant("user_id", F.col("ts")).alias("ab_variant"),
    )


def raw_click_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One item per purchase event, its product the one of the event. Product 0 is in no catalog."""
    bought = table(spark, sf_dir, "events").where(F.col("event_type") == "purchase")
    price, cost = money("value"), (money("value") * 6 / 10).cast(MONEY)
    return bought.select(
        (F.col("event_id") * 100 + 1).alias("order_item_id"),
        F.col("event_id").alias("order_id"),
        (F.col("event_id") % 200).alias("product_id"),
        F.lit(1).alias("quantity"),
        price.alias("unit_price"),
        cost.alias("unit_cost"),
        price.alias("line_total"),
        F.lit(None).cast(MONEY).alias("total_item_price"),
        (price - cost).cast(MONEY).alias("line_profit"),
    )


def orders_world(spark: SparkSession, sf_dir: str) -> RawTables:
    return RawTables(
        users=partial(raw_users, spark, sf_dir),
        products=partial(raw_products, spark, sf_dir),
        sessions=partial(raw_order_sessions, spark, sf_dir),
        events=partial(raw_events, spark, sf_dir),
        orders=partial(raw_orders, spark, sf_dir),
        order_items=partial(raw_order_items, spark, sf_dir),
    )


def click_world(spark: SparkSession, sf_dir: str) -> RawTables:
    return RawTables(
        users=partial(raw_users, spark, sf_dir),
        products=partial(raw_products, spark, sf_dir),
        sessions=partial(raw_click_sessions, spark, sf_dir),
        events=partial(raw_events, spark, sf_dir),
        orders=partial(raw_click_orders, spark, sf_dir),
        order_items=partial(raw_click_items, spark, sf_dir),
    )
