"""Measures of a fact kept by slice in a form that adds up, exact distinct counts included.

Entities are numbered once, in the order of the slices they first appear in; a cube row holds, for one slice and one
range of 32,768 numbers, the sums and a bitmap of the entities of every count. Rows of the same slice and range merge
by adding sums and or-ing bitmaps, so batches are appended and any coarser slice or filter is answered from the cube
without the fact. Choose slices that hold many entities each: a bitmap takes 4 KB, which packs to little in files and
shuffles when it is nearly empty, but is whole in memory.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlens.functions.scalar import flag, scaled, unscaled
from merchlens.session import work_dir

BUCKET, STATES = "__bucket", ("total", "money", "entities", "lowest", "highest")
RANGE_BITS = 33  # of a number: the row within a partition


def number_entities(df: DataFrame, entity: str, slices: Sequence[str], known: DataFrame | None = None) -> DataFrame:
    """(entity, number) of every entity, a written table; those of ``known`` keep their numbers.

    Neighbours in the slices get neighbouring numbers, so a slice touches few ranges. Numbers are dense within the
    partitions of a range partitioning and need no window over all entities. Null is no entity.
    """
    first = df.where(F.col(entity).isNotNull()).groupBy(entity).agg(F.min(F.struct(*slices)).alias("at"))
    start = 0
    if known is not None:
        first = first.join(known, entity, "left_anti")
        top = known.agg(F.max("number")).first()[0]
        start = 0 if top is None else (top >> RANGE_BITS) + 1 << RANGE_BITS
    numbered = (
        first.repartitionByRange("at", entity)
        .sortWithinPartitions("at", entity)
        .select(entity, (F.monotonically_increasing_id() + F.lit(start)).alias("number"))
    )
    path = work_dir(df.sparkSession, "numbers")
    numbered.write.parquet(path)
    fresh = df.sparkSession.read.schema(numbered.schema).parquet(path)
    return fresh if known is None else known.unionByName(fresh)


def _combined(column: str, combine: str) -> Column:
    """State of several rows of one slice and range."""
    if combine == "entities":
        return F.bitmap_or_agg(column).alias(column)
    return {"lowest": F.min, "highest": F.max}.get(combine, F.sum)(column).alias(column)


@dataclass(frozen=True)
class Cube:
    """``states``: the way each state column combines. ``columns_of_fact``: those a filter may not silently miss."""

    frame: DataFrame
    slices: tuple[str, ...]
    states: Mapping[str, str]
    columns_of_fact: frozenset[str]

    @property
    def columns(self) -> list[str]:
        return list(self.slices)

    def where(self, condition: Column) -> Cube:
        """The cube of the slices that meet a condition, such as a range of months."""
        return Cube(self.frame.where(condition), self.slices, self.states, self.columns_of_fact)

    def merged(self, other: Cube) -> Cube:
        """The cube of both inputs. Both must use the same numbers."""
        if (self.slices, dict(self.states)) != (other.slices, dict(other.states)):
            raise ValueError("cubes of different slices or states")
        both = self.frame.unionByName(other.frame)
        return Cube(both, self.slices, self.states, self.columns_of_fact & other.columns_of_fact)

    def compacted(self) -> Cube:
        """One row for each slice and range, however many batches were merged."""
        states = [_combined(column, combine) for column, combine in self.states.items()]
        rows = self.frame.groupBy(*self.slices, BUCKET).agg(*states)
        return Cube(rows, self.slices, self.states, self.columns_of_fact)

    def answer(self, wanted: Sequence[str], by: Sequence[str], places: int) -> DataFrame:
        """One row per combination of ``by`` with the value of every wanted state."""
        missing = [c for c in [*wanted, *by] if c not in self.states and c not in self.slices]
        if missing:
            raise KeyError(f"the cube has no {missing}")
        ranges = self.frame.groupBy(*by, BUCKET).agg(*[_combined(c, self.states[c]) for c in wanted])
        values = {
            "total": lambda c: F.coalesce(F.sum(c), F.lit(0)),
            "money": lambda c: scaled(F.sum(c), places),
            "entities": lambda c: F.coalesce(F.sum(F.bitmap_count(c)), F.lit(0)),
            "lowest": F.min,
            "highest": F.max,
        }
        return ranges.groupBy(*by).agg(*[values[self.states[c]](c).alias(c) for c in wanted])


def build_cube(
    df: DataFrame,
    entity: str,
    slices: Sequence[str],
    states: Mapping[str, tuple[str, Column]],
    numbers: DataFrame,
    places: int,
) -> Cube:
    """The cube of ``df``. ``states``: (combine, value) by column; ``numbers``: see ``number_entities``.

    The fact meets the numbers once; a row without an entity counts in sums only.
    """
    columns = []
    for name, (combine, value) in states.items():
        if combine == "entities":
            hit = F.when(value, F.bitmap_bit_position("number"))
            # A bitmap without an entity is not kept.
            column = F.when(F.max(flag(value & F.col("number").isNotNull())) == 1, F.bitmap_construct_agg(hit))
        elif combine == "money":
            column = F.sum(unscaled(value, places))
        else:
            column = {"total": F.sum, "lowest": F.min, "highest": F.max}[combine](value)
        columns.append(column.alias(name))
    joined = df.join(numbers, entity, "left").withColumn(BUCKET, F.bitmap_bucket_number("number"))
    rows = joined.groupBy(*slices, BUCKET).agg(*columns)
    return Cube(rows, tuple(slices), {n: combine for n, (combine, _) in states.items()}, frozenset(df.columns))
