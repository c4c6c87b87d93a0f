"""Helpers that several corpus operators share."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlens.session import tune, work_dir

# The white space that separates words.
SPACE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER_BYTES = bytes.maketrans(UPPER.encode(), UPPER.lower().encode())
LAST_ID = 2**63 - 1

# Arrow batches are bounded in rows; texts differ by orders of magnitude in length.
BATCH_ROWS = 256
PIECE = 1 << 20


def ready(spark: SparkSession) -> SparkSession:
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts the lineage and survives lost executors."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front as long as a column of ``df`` is called so."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def ascii_lower(column: Column) -> Column:
    return F.translate(column, UPPER, UPPER.lower())


def id_or_last(column: str = "doc_id") -> Column:
    """Documents without an id count as one document behind all others."""
    return F.coalesce(F.col(column).cast("bigint"), F.lit(LAST_ID))


def word_lists(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text, piece by piece, so that a very long text never becomes one list."""
    start, size = 0, len(data)
    while start < size:
        end = start + PIECE
        if end < size:
            while end < size and data[end] not in b" \t\n\x0b\x0c\r":
                end += 1
        yield data[start:end].split()
        start = end


def once(key: str, make: Callable[[], object]):
    """A value made once for the life of a Python worker, such as a loaded vocabulary."""
    kept = sys.modules.setdefault("merchlens_kept", types.ModuleType("merchlens_kept")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]
