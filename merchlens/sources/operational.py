"""Orders of the operational database: extract and normalise to the raw order columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values.
SOURCE = "operational_backend"
USER_PREFIX = "OP-USR-"
ORDER_PREFIX = "OP-"
MONEY_COLUMNS = ("subtotal", "tax_amount", "shipping_fee", "discount_amount", "total_amount")
SCHEMA = (
    "order_id string, session_id string, user_id string, order_date string, order_timestamp timestamp_ntz, "
    "subtotal double, tax_amount double, shipping_fee double, discount_amount double, total_amount double, "
    "payment_method string, status string, ab_variant string, data_source string"
)
COLUMNS = [part.strip().split()[0] for part in SCHEMA.split(",")]


def read_orders(
    spark: SparkSession, url: str, table: str, bounds: tuple[int, int], partitions: int, properties: dict[str, str]
) -> DataFrame:
    """The order table over JDBC, read in parallel by ranges of its numeric id."""
    lower, upper = bounds
    return spark.read.jdbc(
        url, table, column="id", lowerBound=lower, upperBound=upper, numPartitions=partitions, properties=properties
    )


def _money(name: str, missing: float | None) -> Column:
    """Two places; ``missing`` where there is no number."""
    number = F.round(F.col(name).cast("string").try_cast("decimal(18,4)"), 2).cast("double")
    return number if missing is None else F.coalesce(number, F.lit(float(missing)))


def normalise_orders(
    orders: DataFrame, prefix_orders: bool = False, keep_status_case: bool = False, missing_money: float | None = None
) -> DataFrame:
    """Operational orders with the columns of raw orders plus ``data_source``.

    Columns the input lacks become null. There is no web session and no experiment arm. The
    API form of the same rows prefixes order ids and keeps the status as it is. Amounts that are no number stay null,
    or become ``missing_money`` (0.0 for an extract that has none missing).
    """
    have = set(orders.columns)

    def column(name: str) -> Column:
        return F.col(name) if name in have else F.lit(None).cast("string")

    order = column("order_number" if "order_number" in have else "order_id").cast("string")
    created = column("created_at" if "created_at" in have else "order_timestamp").cast("string").try_cast("timestamp_ntz")
    status = column("status").cast("string")
    filled = orders.withColumns({c: F.lit(None).cast("double") for c in MONEY_COLUMNS if c not in have})
    return filled.select(
        (F.concat(F.lit(ORDER_PREFIX), order) if prefix_orders else order).alias("order_id"),
        F.lit(None).cast("string").alias("session_id"),
        F.concat(F.lit(USER_PREFIX), column("user_id").cast("string")).alias("user_id"),
        F.date_format(created, "yyyy-MM-dd").alias("order_date"),
        created.alias("order_timestamp"),
        *[_money(c, missing_money).alias(c) for c in MONEY_COLUMNS],
        column("payment_method").cast("string").alias("payment_method"),
        (status if keep_status_case else F.lower(status)).alias("status"),
        F.lit(None).cast("string").alias("ab_variant"),
        F.lit(SOURCE).alias("data_source"),
    )


def no_orders(spark: SparkSession) -> DataFrame:
    """An empty extract still has every column."""
    return spark.createDataFrame([], SCHEMA)
