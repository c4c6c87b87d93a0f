"""Register a Spark query together with the SQL that must give the same rows."""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.ctes import CLICK, MODELS, ORDERS
from merchlens.plans.warehouse import Warehouse
from merchlens.session import tune
from merchlens.sources.bindings import CLICK_STAGES, click_world, orders_world

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

ORDERS_AS_OF = date(2001, 8, 2)
CLICK_AS_OF = datetime(2024, 1, 31)


def shop(spark: SparkSession, sf_dir: str, **options) -> Warehouse:
    """The orders world."""
    return Warehouse(orders_world(spark, sf_dir), ORDERS_AS_OF, stages=CLICK_STAGES, **options)


def clicks(spark: SparkSession, sf_dir: str, **options) -> Warehouse:
    """The click world."""
    return Warehouse(
        click_world(spark, sf_dir), CLICK_AS_OF, stages=CLICK_STAGES, entry="click", payment="signup", **options
    )


def present(df: DataFrame) -> DataFrame:
    """Plain result types: decimals as doubles, small integers as bigints."""
    out = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            column = column.cast("bigint")
        out.append(column.alias(field.name))
    return df.select(*out)


def query(name: str, sql: str | None = None, world: str = "orders"):
    def register(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return present(build(tune(spark), sf_dir))

        run.__name__, run.__doc__ = name, build.__doc__
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = run
        if sql:
            SQL[name] = with_ctes(sql, world)
        return build

    return register


def with_ctes(sql: str, world: str) -> str:
    """Prefix the common table expressions that ``sql`` uses, in dependency order."""
    texts = {**MODELS, **(ORDERS if world == "orders" else CLICK)}
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in texts:
            if re.search(rf"\b{name}\b", text) and name not in needed:
                visit(texts[name])
                needed.append(name)

    visit(sql)
    if not needed:
        return sql
    ctes = ",\n".join(f"{name} AS ({texts[name].strip()})" for name in needed)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
