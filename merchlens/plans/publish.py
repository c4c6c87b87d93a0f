"""Write models as tables and read them back: the step between building and using them."""

from __future__ import annotations

from collections.abc import Sequence
from copy import copy

from pyspark.sql import DataFrame

from merchlens.plans.warehouse import MODELS, Warehouse


def materialise(warehouse: Warehouse, folder: str, models: Sequence[str] = MODELS) -> dict[str, DataFrame]:
    """Each model as parquet below ``folder``; what follows, later models included, reads files instead of recomputing."""
    spark = warehouse.raw.users.sparkSession
    built, tables = copy(warehouse), {}
    for model in MODELS:
        built.__dict__.pop(model, None)  # a model built before would still read its inputs' sources
    for model in models:
        path, frame = f"{folder}/{model}", built[model]
        frame.write.mode("overwrite").parquet(path)
        tables[model] = built.__dict__[model] = spark.read.schema(frame.schema).parquet(path)
    return tables
