"""Column helpers that fix the semantics which differ between SQL engines."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = "decimal(18,2)"


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def safe_divide(numerator, denominator, default: float | None = None) -> Column:
    """Double division: ``default`` (null) when the denominator is null or zero."""
    ratio = F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))
    return ratio if default is None else F.coalesce(ratio, F.lit(float(default)))


def pct(numerator, denominator, digits: int = 2, default: float | None = None) -> Column:
    """Percentage ``100 * n / d``, rounded."""
    share = F.round(safe_divide(_col(numerator).cast("double") * 100.0, denominator), digits)
    return share if default is None else F.coalesce(share, F.lit(float(default)))


def mean_money(total, count, digits: int = 2) -> Column:
    """Exact decimal division rounded half up, as a double; null for a zero count."""
    ratio = F.try_divide(_col(total).cast("decimal(28,2)"), _col(count).cast("decimal(20,0)"))
    return F.round(ratio, digits).cast("double")


def money(value) -> Column:
    return _col(value).cast(MONEY)


def money_or_zero(value) -> Column:
    return F.coalesce(money(value), F.lit(0).cast(MONEY))


def unscaled(value, scale: int = 2) -> Column:
    """A decimal as a whole number of its last place: cents for money."""
    return (_col(value) * F.lit(10**scale)).cast("bigint")


def sum_exact(value, scale: int = 2) -> Column:
    """Exact decimal sum carried as a 64-bit integer, which aggregates far faster than wide
    decimals. A total beyond 9e18 last places raises an error instead of wrapping."""
    return scaled(F.sum(unscaled(value, scale)), scale)


def scaled(units, scale: int = 2) -> Column:
    """The inverse of ``unscaled``."""
    return _col(units) * F.lit(Decimal(1).scaleb(-scale))


def day_diff(start, end) -> Column:
    """Calendar-day boundaries between two instants (23:59 to 00:01 is one day)."""
    return F.date_diff(_col(end).cast("date"), _col(start).cast("date"))


def second_diff(start, end) -> Column:
    """Second boundaries between two instants, never negative."""
    seconds = F.unix_timestamp(_col(end).cast("timestamp")) - F.unix_timestamp(_col(start).cast("timestamp"))
    return F.greatest(F.lit(0).cast("bigint"), seconds)


def month_start(value) -> Column:
    return F.trunc(_col(value).cast("date"), "MM")


def month_offset(first, later) -> Column:
    """Whole calendar months from ``first`` to ``later``."""
    first, later = _col(first), _col(later)
    return (F.year(later) - F.year(first)) * 12 + (F.month(later) - F.month(first))


def subtract_days(value, days: int) -> Column:
    return _col(value) - F.make_dt_interval(F.lit(days))


def year_month(value) -> Column:
    """``YYYY-MM`` of a date, timestamp or ISO string."""
    return F.date_format(_col(value).cast("date"), "yyyy-MM")


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or null."""
    return F.when(condition, 1).otherwise(0)


def is_set(df: DataFrame, name: str) -> Column:
    """Truth of a boolean or 0/1 column; null counts as not set."""
    if isinstance(df.schema[name].dataType, T.BooleanType):
        return F.coalesce(F.col(name), F.lit(False))
    return F.coalesce(F.col(name).cast("int") > 0, F.lit(False))


def clean_text(name: str) -> Column:
    return F.trim(F.col(name).cast("string"))


def clean_key(df: DataFrame, name: str) -> Column:
    """Trim string keys; keep numeric keys as they are."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.trim(F.col(name))
    return F.col(name)


def resolve_column(df: DataFrame, candidates: Sequence[str]) -> str | None:
    """First of the candidate names the frame has."""
    have = set(df.columns)
    return next((name for name in candidates if name in have), None)


def require_column(df: DataFrame, candidates: Sequence[str]) -> str:
    name = resolve_column(df, candidates)
    if name is None:
        raise KeyError(f"none of {list(candidates)} among {df.columns}")
    return name


def all_of(conditions: Iterable[Column]) -> Column:
    result = F.lit(True)
    for condition in conditions:
        result = result & condition
    return result


def register_sql_functions(spark: SparkSession) -> None:
    """The same helpers as temporary SQL functions, for people who write SQL.

    A SQL function cannot aggregate: for "any true" write the built-in ``bool_or``.
    """
    for statement in (
        "CREATE OR REPLACE TEMPORARY FUNCTION safe_divide(n DOUBLE, d DOUBLE) RETURNS DOUBLE RETURN try_divide(n, d)",
        "CREATE OR REPLACE TEMPORARY FUNCTION day_diff(a TIMESTAMP, b TIMESTAMP) RETURNS INT "
        "RETURN datediff(CAST(b AS DATE), CAST(a AS DATE))",
        "CREATE OR REPLACE TEMPORARY FUNCTION month_start(d DATE) RETURNS DATE RETURN trunc(d, 'MM')",
        "CREATE OR REPLACE TEMPORARY FUNCTION subtract_days(t TIMESTAMP, n INT) RETURNS TIMESTAMP "
        "RETURN t - make_dt_interval(n)",
        "CREATE OR REPLACE TEMPORARY FUNCTION format_month(d DATE) RETURNS STRING RETURN date_format(d, 'yyyy-MM')",
    ):
        spark.sql(statement)
