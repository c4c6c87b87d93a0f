"""Named datasets: parquet first, CSV as fallback, and the raw-table checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from merchlens.sources.bindings import RAW, RawTables

# Columns of the six raw tables, used for CSV and for empty inputs.
RAW_SCHEMAS = {
    "users": "user_id string, created_at timestamp_ntz, country string, acquisition_channel string, "
    "customer_segment string, device_preference string",
    "products": "product_id string, product_name string, category string, cost double, price double, margin double, "
    "inventory_count int, created_at timestamp_ntz",
    "sessions": "session_id string, user_id string, session_start timestamp_ntz, session_end timestamp_ntz, "
    "device_type string, country string, traffic_source string, channel string, is_bounce boolean, "
    "is_returning_user boolean, is_new_user boolean, ab_variant string, experiment_id string",
    "events": "event_id string, session_id string, user_id string, event_timestamp timestamp_ntz, event_name string, "
    "event_type string, step_number int, page_url string, product_id string, cart_value double",
    "orders": "order_id string, session_id string, user_id string, order_date string, order_timestamp timestamp_ntz, "
    "subtotal double, tax_amount double, shipping_fee double, discount_amount double, total_amount double, "
    "payment_method string, status string, ab_variant string",
    "order_items": "order_item_id string, order_id string, product_id string, quantity int, unit_price double, "
    "unit_cost double, line_total double, total_item_price double, line_profit double",
}
BROKEN = "_broken_line"
REPORTS = ("funnel_analysis", "cohort_retention", "ab_test_results", "statistical_summary")


class DatasetMissing(FileNotFoundError):
    """Neither a parquet nor a CSV form of the dataset exists."""


def _read(spark: SparkSession, path: str, form: str, schema: str | None) -> DataFrame | None:
    try:
        if form == "parquet":
            return spark.read.parquet(path)
        reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
        return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return None
        raise


def resolve(spark: SparkSession, base: str, schema: str | None = None) -> DataFrame:
    """Read ``<base>.parquet``, else ``<base>.csv`` (typed by ``schema`` when given).

    A path that already ends in either form tries its parquet form first as well.
    """
    stem = base
    for suffix in (".parquet", ".csv"):
        stem = stem.removesuffix(suffix)
    for form in ("parquet", "csv"):
        df = _read(spark, f"{stem}.{form}", form, schema)
        if df is not None:
            return df
    raise DatasetMissing(f"no parquet or CSV at {stem}")


def read_checked(spark: SparkSession, path: str, schema: str, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """The rows of a CSV that fit ``schema``, and the rejects: each broken line whole in ``record``, and its ``file``.

    A line is broken if a cell does not have its column's type or if it has more or fewer cells. Nothing is lost: every
    line is in one of the two. Both are lazy and read the files once each; quoted cells may not hold line ends.
    """
    names = [field.name for field in StructType.fromDDL(schema)]
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    if header:
        lines = lines.where(F.col("value") != ",".join(names))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN}
    parsed = lines.select("value", "file", F.from_csv("value", f"{schema}, {BROKEN} string", options).alias("row"))
    broken = F.col(f"row.{BROKEN}").isNotNull()
    return parsed.where(~broken).select(*(f"row.{c}" for c in names)), parsed.where(broken).select(
        F.col("value").alias("record"), "file"
    )


def load_raw(spark: SparkSession, folder: str, names: Mapping[str, str] | None = None) -> RawTables:
    """The six raw tables of a folder, registered as views ``raw_<name>`` and ``<name>``."""
    names = names or {name: name for name in RAW}
    frames = {name: resolve(spark, f"{folder}/{names[name]}", RAW_SCHEMAS[name]) for name in RAW}
    return register(RawTables.of(**frames))


def register(raw: RawTables) -> RawTables:
    """Make tables available to SQL under both names."""
    for name, df in raw.items():
        df.createOrReplaceTempView(f"raw_{name}")
        df.createOrReplaceTempView(name)
    return raw


@dataclass(frozen=True)
class Dataset:
    path: str
    form: str = "parquet"
    schema: str | None = None


class Catalog:
    """Dataset names to storage. Analyses ask for a name and never see a path."""

    def __init__(self, root: str):
        self.root = root.rstrip("/")
        from merchlens.plans.warehouse import MARTS

        self.entries = {f"raw_{n}": Dataset(f"{self.root}/raw/{n}", schema=RAW_SCHEMAS[n]) for n in RAW}
        self.entries |= {n: Dataset(f"{self.root}/marts/{n}") for n in MARTS}
        self.entries |= {f"{n}_report": Dataset(f"{self.root}/reports/{n}", "json") for n in REPORTS}

    def names(self) -> list[str]:
        return list(self.entries)

    def load(self, spark: SparkSession, name: str) -> DataFrame:
        entry = self.entries[name]
        if entry.form == "json":
            return spark.read.text(entry.path)
        return resolve(spark, entry.path, entry.schema)

    def save(self, name: str, df: DataFrame) -> None:
        entry = self.entries[name]
        if entry.form == "json":
            from merchlens.sources.sinks import write_report

            write_report(df, entry.path)
        else:
            df.write.mode("overwrite").parquet(f"{entry.path}.parquet")


def presence(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table and whether there are any, for the gate before a build."""
    result = None
    for name, df in tables.items():
        row = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        result = row if result is None else result.unionByName(row)
    return result.withColumn("present", F.col("rows") > 0)


def missing_tables(spark: SparkSession, folder: str, names: Sequence[str] = RAW) -> list[str]:
    """Raw tables without a parquet or CSV form, or without rows."""
    absent = []
    for name in names:
        try:
            if resolve(spark, f"{folder}/{name}", RAW_SCHEMAS.get(name)).isEmpty():
                absent.append(name)
        except DatasetMissing:
            absent.append(name)
    return absent
