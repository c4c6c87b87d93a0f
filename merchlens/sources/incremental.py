"""Key merges into partitioned parquet tables, and tables kept in versions."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from merchlens.functions.scalar import all_of
from merchlens.session import work_dir

LOOK_BACK_DAYS = 3  # fixed value


def _file_system(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def committed(spark: SparkSession, path: str) -> bool:
    """Whether a whole-folder write to ``path`` was completed."""
    system, _ = _file_system(spark, path)
    return system.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS"))


def entries(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no folder."""
    system, location = _file_system(spark, path)
    return [status.getPath().getName() for status in system.listStatus(location)] if system.exists(location) else []


def remove(spark: SparkSession, path: str) -> None:
    system, location = _file_system(spark, path)
    system.delete(location, True)


def has_partitions(spark: SparkSession, path: str) -> bool:
    """Whether any partition was committed. (A dynamic overwrite leaves no marker at the top.)"""
    return any("=" in name for name in entries(spark, path))


def _unordered(kind) -> bool:
    """Whether values of a type have no order: maps, also inside others."""
    return "map<" in kind.simpleString()


def latest_rows(batch: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the last in ``order``, among equals the largest by its other columns.

    A combining aggregate instead of a window, so a key repeated any number of times in a
    batch is reduced before the shuffle.
    """
    rest = [c for c in batch.columns if c not in key]
    ties = [c for c in rest if c not in order and not _unordered(batch.schema[c].dataType)]
    newest = F.max_by(F.struct(*rest), F.struct(*order, *ties)).alias("__row")
    grouped = batch.groupBy(*key).agg(newest)
    return grouped.select(*key, "__row.*").select(*batch.columns)


def merge(target: DataFrame, delta: DataFrame, key: Sequence[str]) -> DataFrame:
    """Target rows without a newer version, plus the delta. ``delta`` holds a key once.

    Columns only one side has become null on the other.
    """
    kept = target.join(delta.select(*key), list(key), "left_anti")
    return kept.unionByName(delta, allowMissingColumns=True)


def look_back_floor(target: DataFrame, column: str, days: int = LOOK_BACK_DAYS, partition: str | None = None):
    """The literal the next run filters on: newest value less ``days``. None when empty.

    With ``partition`` only the last partition is read. Should a newer value sit elsewhere,
    the floor is merely lower and more rows are merged again.
    """
    if partition:
        last = target.agg(F.max(partition)).first()[0]
        target = target.where(F.col(partition) == F.lit(last))
    newest = target.agg(F.max(column)).first()[0]
    return None if newest is None else newest - timedelta(days=days)


def _one_of(column: str, values: set) -> Column:
    present = sorted((v for v in values if v is not None), key=str)
    condition = F.col(column).isin(present) if present else F.lit(False)
    return condition | F.col(column).isNull() if len(present) < len(values) else condition


def merge_into(
    spark: SparkSession,
    path: str,
    delta: DataFrame,
    key: Sequence[str],
    partition: str,
    order: Sequence[str] | None = None,
    cluster: Sequence[str] = (),
    fixed_partition: bool = False,
) -> None:
    """Upsert ``delta`` into the table at ``path``; rewrite only the partitions it touches.

    Touched are the partitions of the delta and those that hold an older row of one of its
    keys. Both lists are partition values (days), which is what the driver gets to see. The
    same batch twice leaves the same table. Of a key's rows in the delta the last in ``order`` counts; without an
    order, the largest by its other columns.

    Beside the table lie its schema and, per partition, the range its keys are in. Older rows are looked for only in
    partitions whose range meets that of a slice of the delta's keys, and no file is opened for its schema. Tables
    without these notes are read whole once and then have them.

    ``fixed_partition`` states that a key never changes its partition (an order keeps its
    date); then only the partitions of the delta are read, not keys of others.
    """
    fresh = latest_rows(delta, key, order or [c for c in delta.columns if c not in key])
    # Read several times below: a table in the shared folder is the same each time and survives lost executors.
    place = work_dir(spark, "delta")
    fresh.write.parquet(place)
    try:
        _merge_fresh(spark, path, spark.read.schema(fresh.schema).parquet(place), key, partition, cluster, fixed_partition)
    finally:
        remove(spark, place)


def _merge_fresh(
    spark: SparkSession,
    path: str,
    fresh: DataFrame,
    key: Sequence[str],
    partition: str,
    cluster: Sequence[str],
    fixed_partition: bool,
) -> None:
    known = has_partitions(spark, path)
    schema = _stored_schema(spark, path, fresh, partition) if known else fresh.schema
    ranges = KeyRanges(spark, path, key, fresh.schema[partition])
    # Notes come first and only ever grow: should the write fail, they say too much, never too little.
    ranges.widen(fresh, spark.read.schema(schema).parquet(path) if known and not ranges.stored() else None)
    _keep_schema(spark, path, merged_schema(schema, fresh.schema))
    if not known:
        _write(fresh, path, partition, cluster)
        return
    target = spark.read.schema(schema).parquet(path)
    arriving = _values(fresh, partition)
    if not arriving:
        return
    leaving: dict = {}
    if not fixed_partition:
        # The folder comes from the files themselves: null and escaped values have names of their own.
        folder = F.regexp_extract("_metadata.file_path", "^(.*)/[^/]+$", 1).alias("__folder")
        holding = target.where(_one_of(partition, ranges.meeting(fresh)))
        older = holding.select(*key, F.col(partition).alias("__from"), folder).join(fresh.select(*key), list(key), "left_semi")
        found = older.select("__from", "__folder").distinct().collect()  # partitions, never keys
        leaving = {row[0]: row[1] for row in found if row[0] not in arriving}
    touched = target.where(_one_of(partition, arriving | set(leaving)))
    merged = merge(touched, fresh, key)
    # A dynamic overwrite replaces partitions it has rows for; those left without must go.
    emptied = set(leaving) - _values(merged.where(_one_of(partition, set(leaving))), partition) if leaving else set()
    _write(merged, path, partition, cluster)
    for value in emptied:
        place = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(leaving[value]))
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


class KeyRanges:
    """Per partition of a table the least and the greatest key it may hold, in a small table beside it.

    One row per partition. A range only grows, so a failed write leaves it too wide at worst.
    """

    SLICES = 200  # slices of a delta's keys, each with a range of its own

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str], partition) -> None:
        self.spark, self.path, self.key, self.partition = spark, f"{path.rstrip('/')}/_key_ranges", list(key), partition

    def stored(self) -> bool:
        return committed(self.spark, self.path)

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def _of(self, rows: DataFrame) -> DataFrame:
        place = F.struct(*self.key)
        return rows.groupBy(F.col(self.partition.name).alias("part")).agg(F.min(place).alias("low"), F.max(place).alias("high"))

    def widen(self, fresh: DataFrame, whole: DataFrame | None) -> None:
        """Take in the keys of ``fresh``, and of the whole table where nothing is known about it yet."""
        ranges = self._of(fresh) if whole is None else self._of(fresh).unionByName(self._of(whole))
        if self.stored():
            ranges = ranges.unionByName(self.read())
        rows = ranges.groupBy("part").agg(F.min("low").alias("low"), F.max("high").alias("high"))
        # One row per partition: through the driver, as it overwrites what it was read from.
        held = self.spark.createDataFrame(rows.collect(), rows.schema)
        held.coalesce(1).write.mode("overwrite").parquet(self.path)

    def meeting(self, fresh: DataFrame) -> set:
        """The partitions that may hold one of the keys of ``fresh``."""
        keys = fresh.select(*self.key).repartitionByRange(self.SLICES, *self.key)
        place = F.struct(*self.key)
        slices = keys.groupBy(F.spark_partition_id().alias("slice")).agg(F.min(place).alias("least"), F.max(place).alias("most"))
        # SLICES rows against one row per partition.
        met = self.read().join(F.broadcast(slices), (F.col("low") <= F.col("most")) & (F.col("least") <= F.col("high")), "left_semi")
        return {row[0] for row in met.select("part").collect()}


def merged_schema(old: StructType, new: StructType) -> StructType:
    """The old columns, then those only the new one has."""
    return StructType([*old, *(field for field in new if field.name not in old.names)])


def _keep_schema(spark: SparkSession, path: str, schema: StructType) -> None:
    place = f"{path.rstrip('/')}/_schema"
    if not committed(spark, place) or schema != StructType.fromJson(json.loads(spark.read.text(place).first()[0])):
        spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(place)


def _stored_schema(spark: SparkSession, path: str, fresh: DataFrame, partition: str) -> StructType:
    """The table's schema; its partition column has the type of the delta, not one guessed from folder names."""
    place = f"{path.rstrip('/')}/_schema"
    if committed(spark, place):
        schema = StructType.fromJson(json.loads(spark.read.text(place).first()[0]))
    else:
        schema = spark.read.option("mergeSchema", True).parquet(path).schema
    return StructType([fresh.schema[partition] if field.name == partition else field for field in schema])


def stored(spark: SparkSession, path: str) -> DataFrame:
    """The table with all its columns, without opening a file for them."""
    place = f"{path.rstrip('/')}/_schema"
    if not committed(spark, place):
        return spark.read.option("mergeSchema", True).parquet(path)
    return spark.read.schema(StructType.fromJson(json.loads(spark.read.text(place).first()[0]))).parquet(path)


def _values(df: DataFrame, column: str) -> set:
    """Distinct values of a partition column: days or months, never keys."""
    return {row[0] for row in df.select(column).distinct().collect()}


def _write(df: DataFrame, path: str, partition: str, cluster: Sequence[str]) -> None:
    """Rewrite partitions. A partition with many rows is cut into several files, not one task."""
    spread = [*cluster, F.xxhash64(*df.columns)]
    arranged = df.repartitionByRange(partition, *spread) if cluster else df.hint("rebalance", partition)
    (
        arranged.sortWithinPartitions(partition, *cluster)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def incremental_build(
    spark: SparkSession,
    path: str,
    build: Callable[[object], DataFrame],
    key: Sequence[str],
    partition: str,
    watermark: str,
    days: int = LOOK_BACK_DAYS,
    cluster: Sequence[str] = (),
    fixed_partition: bool = False,
) -> DataFrame:
    """Full build the first time, afterwards the rows of the look-back window merged by key.

    ``build(since)`` gives the model from ``since`` on (all of it for None).
    """
    floor = None
    if has_partitions(spark, path):
        floor = look_back_floor(stored(spark, path), watermark, days, partition)
    merge_into(spark, path, build(floor), key, partition, [watermark], cluster, fixed_partition)
    return stored(spark, path)


class VersionedTable:
    """A table as numbered folders; the highest one whose write was committed is current.

    A failed write leaves no commit marker and is never read. Reading a version is reading
    its folder.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _folder(self, version: int) -> str:
        return f"{self.path}/version={version}"

    def versions(self) -> list[int]:
        system, location = _file_system(self.spark, self.path)
        if not system.exists(location):
            return []
        names = [status.getPath().getName() for status in system.listStatus(location)]
        numbers = sorted(int(n.split("=")[1]) for n in names if n.startswith("version="))
        return [n for n in numbers if committed(self.spark, self._folder(n))]

    def current(self) -> int:
        found = self.versions()
        if not found:
            raise FileNotFoundError(self.path)
        return found[-1]

    def write(self, df: DataFrame) -> int:
        version = (self.versions() or [0])[-1] + 1
        df.write.mode("overwrite").parquet(self._folder(version))
        return version

    def read(self, version: int | None = None) -> DataFrame:
        return self.spark.read.parquet(self._folder(self.current() if version is None else version))

    def update(self, condition: Column, changes: dict[str, Column]) -> int:
        """A new version with ``changes`` applied where the condition holds."""
        df = self.read()
        hit = F.coalesce(condition, F.lit(False))
        columns = [
            F.when(hit, changes[c].cast(df.schema[c].dataType)).otherwise(F.col(c)).alias(c) if c in changes else F.col(c)
            for c in df.columns
        ]
        return self.write(df.select(*columns))

    def restore(self, version: int) -> int:
        """Make an earlier version current again, as a new version."""
        return self.write(self.read(version))

    def merge(self, delta: DataFrame, key: Sequence[str], order: Sequence[str]) -> int:
        fresh = latest_rows(delta, key, order)
        return self.write(merge(self.read(), fresh, key) if self.versions() else fresh)


def zero_amounts(columns: Sequence[str]) -> dict[str, Column]:
    return {c: F.lit(0) for c in columns}


def same_totals(before: DataFrame, after: DataFrame) -> DataFrame:
    """Two one-row audits side by side: true when every figure agrees."""
    named = before.select(*[F.col(c).alias(f"before_{c}") for c in before.columns])
    row = named
    for column in after.columns:
        row = row.withColumn(f"after_{column}", after.select(column).scalar())
    agree = all_of(F.col(f"before_{c}").eqNullSafe(F.col(f"after_{c}")) for c in before.columns)
    return row.withColumn("restored", agree)
