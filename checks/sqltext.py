"""Small SQL snippets shared by the checks."""

from __future__ import annotations

import math


def pct(n: str, d: str, digits: int = 2) -> str:
    return f"round(CAST({n} AS DOUBLE) * 100 / nullif(CAST({d} AS DOUBLE), 0), {digits})"


def ratio(n: str, d: str) -> str:
    return f"CAST({n} AS DOUBLE) / nullif(CAST({d} AS DOUBLE), 0)"


def dbl(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def slices(table: str, dimensions: list[str], body: str) -> str:
    """``body`` (with {src}, {dim}, {val}) overall and per value of each dimension, by UNION ALL."""
    parts = [body.format(src=table, dim="'overall'", val="'overall'")]
    parts += [
        body.format(src=f"{table} WHERE {d} IS NOT NULL", dim=f"'{d}'", val=f"CAST({d} AS VARCHAR)")
        for d in dimensions
    ]
    return "\nUNION ALL\n".join(parts)


def mean_money(total: str, count: str) -> str:
    """Exact half-up division to two places (totals are not negative)."""
    cents = f"CAST(({total}) * 100 AS HUGEINT)"
    return f"CAST((2 * {cents} + ({count})) // nullif(2 * CAST(({count}) AS HUGEINT), 0) AS DOUBLE) / 100"


def erfc(x: str, split: float = 2.0, terms: int = 45, levels: int = 80) -> str:
    """Complementary error function of a column that is not negative: power series, then continued fraction."""
    series, fraction = "1.0::DOUBLE", "0.0::DOUBLE"
    for n in range(terms, 0, -1):
        series = f"(1 + 2 * {x} * {x} / {2 * n + 1} * {series})"
    for n in range(levels, 0, -1):
        fraction = f"({n / 2}::DOUBLE / ({x} + {fraction}))"
    root = math.sqrt(math.pi)
    return f"CASE WHEN {x} < {split} THEN 1 - {2 / root!r}::DOUBLE * {x} * exp(-{x} * {x}) * {series} ELSE exp(-{x} * {x}) / {root!r}::DOUBLE / ({x} + {fraction}) END"
