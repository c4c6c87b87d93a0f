"""Windows and joins that stay parallel when one key holds a large part of the rows.

A key is *hot* when it holds more than ``HOT_ROWS`` rows. Being hot changes how rows are placed, never the result. The
list of hot keys has no limit: n rows hold at most n / ``HOT_ROWS`` hot keys, a million in 10^12 rows. Spark
broadcasts it only if it is small: it is a written table of known size, or ``hot_rows`` is high. A longer list, as with
every key hot, is joined by shuffles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from merchlens.session import work_dir

# Fixed values.
HOT_ROWS = 1_000_000
DRAWN = 50  # sampled rows per part of a hot key
LISTED = 100_000  # a list of keys with so many rows each is short, whatever its unwritten form promises
STRIDE = 32  # bounds are searched in two steps of about this size


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys that hold too many rows for one task, and ``__rows``, how many.

    Reads the key columns only and counts before the shuffle.
    """
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows")).where(F.col("__rows") > hot_rows)


def mark_hot(df: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    """``df`` plus ``__is_hot``, whether its key is in ``hot``, and ``__rows``. Null keys count too."""
    marked = df.join(hot.withColumnRenamed(key, "__hot"), F.col(key).eqNullSafe(F.col("__hot")), "left")
    return marked.withColumn("__is_hot", F.col("__rows").isNotNull()).drop("__hot")


def _written(df: DataFrame, name: str) -> DataFrame:
    """A small table in the shared folder: the same for every plan that reads it, also after a lost executor."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hot_bounds(df: DataFrame, key: str, order: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """Where each hot key's rows are cut along ``order``: (__hot, bounds, coarse), or None without a hot key.

    A key is cut into as many parts as it holds ``hot_rows`` rows, at the quantiles of a sample of some ``DRAWN`` rows
    per part. The sample follows the hash of the order columns. It decides sizes only, never results.
    """
    hot = _written(hot_keys(df, [key], hot_rows), "hot-keys")
    if hot.isEmpty():
        return None
    parts = F.ceil(F.col("__rows") / max(hot_rows, 1))
    rows = mark_hot(df.select(key, *(c for c in order if c != key)), hot, key).where("__is_hot")
    dice = F.pmod(F.xxhash64(*order), F.lit(1 << 30)) / (1 << 30)
    drawn = rows.where(dice * F.col("__rows") < DRAWN * parts)
    ordered = F.array_sort(F.collect_list(F.struct(*order)))
    sampled = drawn.groupBy(F.col(key).alias("__hot")).agg(ordered.alias("drawn"), F.max(parts).alias("parts"))
    at = F.sequence(F.lit(1), F.greatest(F.col("parts") - 1, F.lit(1)))
    size = F.size("drawn")
    picks = F.transform(at, lambda i: F.get("drawn", F.floor(i * size / F.col("parts")).cast("int")))
    bounds = sampled.select("__hot", F.array_distinct(picks).alias("bounds"))
    coarse = F.filter("bounds", lambda x, i: i % STRIDE == STRIDE - 1)
    return _written(bounds.select("*", coarse.alias("coarse")), "hot-bounds")


def place_rows(df: DataFrame, key: str, order: Sequence[str], bounds: DataFrame) -> DataFrame:
    """``df`` plus ``__part``: which part of its key a row is in, in the order of rows; null for keys that are not hot."""
    marked = df.join(bounds, F.col(key).eqNullSafe(F.col("__hot")), "left")
    row = F.struct(*order)
    passed = F.size(F.filter("coarse", lambda b: b < row)) * STRIDE
    fine = F.size(F.filter(F.slice("bounds", passed + 1, F.lit(STRIDE)), lambda b: b < row))
    return marked.select(*df.columns, F.when(F.col("bounds").isNotNull(), passed + fine).alias("__part"))


def sequence_rows(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    sequence: str | None = None,
    previous: dict[str, str] | None = None,
    running: dict[str, str] | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``row_number``, ``lag`` and running sums per key in the total order of the columns ``order``.

    A prefix scan: a hot key is cut into parts of about equal size along ``order`` (``hot_bounds``), however its rows
    lie in time. Each part is windowed on its own; what earlier parts contribute comes from one summary row per part.
    Other keys are one part, and without a hot key the plan is a plain window. The keys are counted when this is called.

    sequence -- name of the row number column
    previous -- {column: name of its value on the previous row}
    running  -- {column: name of its running sum, current row included}
    """
    previous, running = previous or {}, running or {}
    bounds = hot_bounds(df, key, order, hot_rows)
    # A struct never is null, and a null field in it equals another: null keys stay one group,
    # and the join below reuses the shuffle and the sort of the window.
    if bounds is None:
        tagged, group = df, key
    else:
        tagged, group = place_rows(df, key, order, bounds), "__slot"
        tagged = tagged.withColumn("__slot", F.struct(F.col(key).alias("key"), F.col("__part").alias("part")))

    in_slot = Window.partitionBy(group).orderBy(*order)
    so_far = in_slot.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    columns = {"__at": F.row_number().over(in_slot)}
    columns |= {f"__prev_{c}": F.lag(c).over(in_slot) for c in previous}
    columns |= {f"__run_{c}": F.sum(c).over(so_far) for c in running}
    windowed = tagged.select("*", *[expr.alias(name) for name, expr in columns.items()])
    skip, first = F.lit(0), F.lit(False)
    if bounds is not None:
        windowed = windowed.join(_carried(tagged, order, previous, running), F.col("__slot") == F.col("__before"), "left")
        skip, first = F.coalesce("__skip", F.lit(0)), F.col("__at") == 1
    out = [F.col(c) for c in df.columns]
    if sequence:
        out.append((F.col("__at") + skip).cast("bigint").alias(sequence))
    for c, name in previous.items():
        value = F.col(f"__prev_{c}")
        out.append((value if bounds is None else F.when(first, F.col(f"__carry_{c}")).otherwise(value)).alias(name))
    for c, name in running.items():
        base = F.lit(0) if bounds is None else F.coalesce(f"__base_{c}", F.lit(0))
        out.append((F.col(f"__run_{c}") + base).alias(name))
    return windowed.select(*out)


def _carried(tagged: DataFrame, order: Sequence[str], previous: dict[str, str], running: dict[str, str]) -> DataFrame:
    """One row per part of a hot key: what the parts before it add up to, and the last row before it."""
    last = F.struct(*[F.col(c) for c in order])
    slots = (
        tagged.where(F.col("__part").isNotNull())
        .groupBy(F.col("__slot").alias("__before"))
        .agg(
            F.count(F.lit(1)).alias("__n"),
            *[F.max_by(c, last).alias(f"__last_{c}") for c in previous],
            *[F.sum(c).alias(f"__sum_{c}") for c in running],
        )
    )
    by_key = Window.partitionBy("__before.key").orderBy("__before.part")
    earlier = by_key.rowsBetween(Window.unboundedPreceding, -1)
    return slots.select(
        "__before",
        F.sum("__n").over(earlier).alias("__skip"),
        *[F.lag(f"__last_{c}").over(by_key).alias(f"__carry_{c}") for c in previous],
        *[F.sum(f"__sum_{c}").over(earlier).alias(f"__base_{c}") for c in running],
    )


def fan_out_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    hot_rows: int = HOT_ROWS,
    salts: int | None = None,
) -> DataFrame:
    """Left join where the *right* side may repeat a key any number of times.

    Right rows of a hot key are spread over as many salts as it has ``hot_rows`` rows (or over ``salts``) and the
    matching left rows are copied to each. A hot key has a match by definition, so copies that found none are surplus
    and are removed; every other row keeps plain left-join behaviour.
    """
    right = right.where(F.col(key).isNotNull())  # a null key matches nothing
    hot = hot_keys(right, [key], hot_rows)
    if hot_rows >= LISTED:
        hot = F.broadcast(hot)
    parts = F.lit(salts) if salts else F.ceil(F.col("__rows") / max(hot_rows, 1)).cast("int")
    spread = (
        mark_hot(right, hot, key)
        .withColumn("__salt", F.when(F.col("__is_hot"), F.pmod(F.xxhash64(*right.columns), parts).cast("int")).otherwise(0))
        .withColumn("__match", F.lit(True))
        .withColumnRenamed(key, "__right_key")
        .drop("__is_hot", "__rows")
    )
    copies = F.when(F.col("__is_hot"), F.sequence(F.lit(0), parts - 1)).otherwise(F.array(F.lit(0)))
    copied = mark_hot(left, hot, key).withColumn("__copy", F.explode(copies))
    on = (F.col(key) == F.col("__right_key")) & (F.col("__copy") == F.col("__salt"))
    joined = copied.join(spread, on, "left")
    return joined.where(~F.col("__is_hot") | F.col("__match")).drop(
        "__is_hot", "__rows", "__copy", "__salt", "__match", "__right_key"
    )
