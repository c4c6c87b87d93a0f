"""Writers: exports, partitioned facts, clustered dimensions, JSON reports, parity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Partition column and the columns rows are clustered by. The retention fact holds
# month starts, so its partitions are months.
LAYOUT = {
    "fct_funnel": ("session_date", ("device_type", "country", "traffic_source", "ab_variant")),
    "fct_orders": ("order_date", ("user_id", "status", "ab_variant")),
    "fct_ab_test": ("session_date", ("ab_variant", "device_type", "country")),
    "fct_user_retention": ("activity_month", ("cohort_month", "customer_segment", "country")),
    "dim_users": (None, ("customer_segment", "country", "device_preference")),
    "dim_products": (None, ("category",)),
}
ROWS_PER_FILE = 5_000_000
BITS = 8  # of a cluster column's range number
SAMPLE = 20_000  # rows that the ranges are drawn from, at most
BUCKETS = 4096  # of keys, whose checksums are compared


def export(df: DataFrame, folder: str, name: str) -> None:
    """One table as parquet and as CSV."""
    df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    df.write.mode("overwrite").option("header", True).csv(f"{folder}/{name}.csv")


def _cuts(df: DataFrame, columns: Sequence[str]) -> list[list]:
    """For each column up to 2^``BITS`` - 1 values that cut its sampled values into even ranges."""
    # The rows with the smallest hashes: one pass. They decide sizes of files, never what these hold.
    drawn = df.select(*columns, F.xxhash64(*df.columns).alias("__dice")).orderBy("__dice").limit(SAMPLE).collect()
    cuts = []
    for i in range(len(columns)):
        values = sorted({row[i] for row in drawn if row[i] is not None})
        count = min(len(values), 2**BITS - 1)
        cuts.append([values[(k * len(values)) // count] for k in range(count)])
    return cuts


def interleaved(df: DataFrame, columns: Sequence[str]) -> Column:
    """Where a row lies on a curve through all cluster columns alike: the bits of their range numbers, interleaved.

    Sorted by it, rows that are near in any of the columns are near in the file, so a filter on the last column skips
    files as well as one on the first.
    """
    curve = F.lit(0).cast("bigint")
    step = 2 ** (BITS // 2)
    for place, (name, cuts) in enumerate(zip(columns, _cuts(df, columns), strict=True)):
        kind = df.schema[name].dataType
        fine = F.array(*[F.lit(v).cast(kind) for v in cuts]).cast(T.ArrayType(kind))
        coarse = F.array(*[F.lit(v).cast(kind) for v in cuts[step - 1 :: step]]).cast(T.ArrayType(kind))
        # Stretched over all bits, so that the first bit of every column halves its values.
        number = F.floor(_passed(F.col(name), fine, coarse, step) * (2**BITS) / (len(cuts) + 1)).cast("bigint")
        for bit in range(BITS):
            curve = curve.bitwiseOR(F.shiftleft(F.shiftright(number, bit).bitwiseAND(1), bit * len(columns) + len(columns) - 1 - place))
    return curve


def _passed(value: Column, fine: Column, coarse: Column, step: int) -> Column:
    """How many cuts are not above a value; 0 for null. Searched in two steps."""
    skipped = F.size(F.filter(coarse, lambda cut: cut <= value)) * step
    rest = F.slice(fine, skipped + 1, F.lit(step))
    return F.when(value.isNull(), 0).otherwise(skipped + F.size(F.filter(rest, lambda cut: cut <= value)))


def _arranged(df: DataFrame, lead: Sequence[str], cluster: Sequence[str], files: int | None) -> DataFrame:
    """Rows range-partitioned and sorted by the lead columns, then along the curve of the cluster columns."""
    placed = df.withColumn("__curve", interleaved(df, cluster) if len(cluster) > 1 else F.lit(0))
    # The row hash only splits a run of equal values that is too long for one task.
    order = [*lead, "__curve", *cluster]
    ranges = [*order, F.xxhash64(*df.columns)]
    spread = placed.repartitionByRange(files, *ranges) if files else placed.repartitionByRange(*ranges)
    return spread.sortWithinPartitions(*order).drop("__curve")


def write_fact(df: DataFrame, path: str, column: str, cluster: Sequence[str], files: int | None = None) -> None:
    """One folder per value of a date column, rows clustered by the cluster columns in each file.

    A later filter on the date column prunes folders.

    Rows are range-partitioned on day and curve: a day with many rows is cut into several files instead of going
    through one task, and parquet min/max of each cluster column skip files. ``files`` is their number, if not measured.
    """
    (
        _arranged(df, [column], cluster, files)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .option("partitionOverwriteMode", "static")
        .partitionBy(column)
        .parquet(path)
    )


def write_dimension(df: DataFrame, path: str, cluster: Sequence[str], files: int | None = None) -> None:
    """Rows clustered by the cluster columns across and within files."""
    arranged = _arranged(df, [], cluster, files)
    arranged.write.mode("overwrite").option("maxRecordsPerFile", ROWS_PER_FILE).parquet(path)


def files_to_read(stored: DataFrame, column: str, value) -> DataFrame:
    """How many files there are, and in how many a filter ``column = value`` has to look, by the files' least and greatest."""
    ranges = stored.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.min(column).alias("low"), F.max(column).alias("high"))
    inside = (F.col("low") <= F.lit(value)) & (F.col("high") >= F.lit(value))
    return ranges.agg(F.count(F.lit(1)).alias("files"), F.count_if(inside).alias("files_read"))


def write_mart(name: str, df: DataFrame, path: str) -> None:
    column, cluster = LAYOUT.get(name, (None, ()))
    if column:
        write_fact(df, path, column, cluster)
    elif cluster:
        write_dimension(df, path, cluster)
    else:
        df.write.mode("overwrite").parquet(path)


def report_lines(df: DataFrame) -> DataFrame:
    """Each row of a (small) report as one JSON document."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))


def write_report(df: DataFrame, path: str) -> None:
    """A report as JSON lines; AQE folds a report's few rows into one file."""
    report_lines(df).write.mode("overwrite").text(path)


def _differs(kind: T.DataType, a: Column, b: Column) -> Column:
    one_missing = a.isNull() != b.isNull()
    if isinstance(kind, T.BooleanType):
        return ~a.eqNullSafe(b)
    if isinstance(kind, T.NumericType):
        gap = F.abs(a.cast("double") - b.cast("double")) > 0.01
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        gap = F.abs(a.cast("timestamp").cast("double") - b.cast("timestamp").cast("double")) > 1.0
    else:
        return ~a.cast("string").eqNullSafe(b.cast("string"))
    return F.coalesce(gap, F.lit(False)) | one_missing


def _canonical(df: DataFrame, column: str) -> Column:
    """A cell in a form that does not depend on how it is stored."""
    kind, value = df.schema[column].dataType, F.col(column)
    if isinstance(kind, T.NumericType):
        return value.cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return value.cast("timestamp").cast("double")
    return value.cast("string")


def checksums(df: DataFrame, key: str, columns: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """Per bucket of the key its rows and the sum of their hashes, whatever their order."""
    cells = [_canonical(df, key), *(_canonical(df, c) for c in columns)]
    nulls = F.concat_ws("", *(c.isNull().cast("int").cast("string") for c in cells))
    return df.groupBy(_bucket(df, key, buckets).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(nulls, *cells).cast("decimal(38,0)")).alias("checksum")
    )


def _bucket(df: DataFrame, key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(_canonical(df, key)), F.lit(buckets)).cast("int")


def parity(left: DataFrame, right: DataFrame, key: str, buckets: int = BUCKETS) -> DataFrame:
    """Compare two forms of a table by key: rows on one side only, and cells that differ.

    Numbers may differ by 0.01 and times by one second. Buckets of keys with equal checksums on both sides are equal;
    only the rows of the others are joined and compared cell by cell, so equal tables join nothing.
    """
    columns = [c for c in left.columns if c != key]
    a, b = checksums(left, key, columns, buckets), checksums(right, key, columns, buckets)
    met = a.join(b.withColumnsRenamed({"n": "m", "checksum": "other"}), "bucket", "full")
    equal = F.coalesce((F.col("n") == F.col("m")) & (F.col("checksum") == F.col("other")), F.lit(False))
    # At most one row per bucket.
    unequal = F.broadcast(met.where(~equal).select(F.col("bucket").alias("__bucket")))

    def suspects(df: DataFrame) -> DataFrame:
        return df.join(unequal, _bucket(df, key, buckets) == F.col("__bucket"), "left_semi")

    found = compare_cells(suspects(left), suspects(right), key)
    whole = {"left_rows": a.agg(F.coalesce(F.sum("n"), F.lit(0))), "right_rows": b.agg(F.coalesce(F.sum("n"), F.lit(0)))}
    return found.withColumns({name: total.scalar() for name, total in whole.items()})


def compare_cells(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``parity`` over all rows. Rows of a repeated key are paired in the order of their other columns, so none is
    counted twice. One full join, one output row.
    """
    columns = [c for c in left.columns if c != key]
    nth = F.row_number().over(Window.partitionBy(key).orderBy(*columns) if columns else Window.partitionBy(key).orderBy(key))

    def side(df: DataFrame, mark: str) -> DataFrame:
        named = [F.col(c).alias(f"{mark}_{c}") for c in columns]
        return df.select(F.col(key).alias("__key"), nth.alias("__nth"), F.lit(1).alias(f"__{mark}"), *named)

    joined = side(left, "a").join(side(right, "b"), ["__key", "__nth"], "full")
    both = F.col("__a").isNotNull() & F.col("__b").isNotNull()
    return joined.agg(
        F.count("__a").alias("left_rows"),
        F.count("__b").alias("right_rows"),
        F.count_if(F.col("__b").isNull()).alias("left_only"),
        F.count_if(F.col("__a").isNull()).alias("right_only"),
        *[
            F.count_if(both & _differs(left.schema[c].dataType, F.col(f"a_{c}"), F.col(f"b_{c}"))).alias(f"{c}_differs")
            for c in columns
        ],
    )


def multiset_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows (with multiplicity) on one side only; no key needed."""
    columns = left.columns
    only_left = left.exceptAll(right.select(*columns)).withColumn("only_in", F.lit("left"))
    only_right = right.select(*columns).exceptAll(left).withColumn("only_in", F.lit("right"))
    return only_left.unionByName(only_right)
