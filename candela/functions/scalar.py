"""Scalar column helpers (all JVM-side built-ins, no UDFs)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_OPS = {
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    "==": lambda c, v: c == v,
}


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num: str | Column, den: str | Column) -> Column:
    """Division that yields NULL on a zero divisor under ANSI on or off."""
    return F.try_divide(col_of(num), col_of(den))


def bucket(c: str | Column, rules: Sequence[tuple[str, float, str]], default: str) -> Column:
    """Searched CASE: first rule ``(op, bound, label)`` that holds wins.

    A NULL input fails every comparison and falls to ``default``.
    """
    c = col_of(c)
    expr = None
    for op, bound, label in rules:
        cond = _OPS[op](c, F.lit(bound))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default))


# Market-cap class bounds (USD) and labels, checked top-down.
MARKET_CAP_RULES = [
    (">=", 200_000_000_000, "Mega Cap"),
    (">=", 10_000_000_000, "Large Cap"),
    (">=", 2_000_000_000, "Mid Cap"),
    (">=", 300_000_000, "Small Cap"),
]


def market_cap_category(c: str | Column) -> Column:
    """NULL or 0 -> Unknown; otherwise the first class whose lower bound holds, else Micro Cap."""
    c = col_of(c)
    return F.when(c.isNull() | (c == 0), F.lit("Unknown")).otherwise(
        bucket(c, MARKET_CAP_RULES, "Micro Cap")
    )


def round_to(c: str | Column, places: int) -> Column:
    """Tie-safe rounding used when comparing against the SQL oracle.

    ``floor(x * 10^p + 0.50001) / 10^p`` is evaluated identically by Spark
    and DuckDB, so last-bit summation noise does not change the hashed value.
    """
    c = col_of(c)
    scale = float(10 ** places)
    return F.floor(c * F.lit(scale) + F.lit(0.50001)).cast("double") / F.lit(scale)


def round4(c: str | Column) -> Column:
    return round_to(c, 4)
