"""Numeric column helpers shared by operators and oracles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def r6(c: Column | str) -> Column:
    """Round to 6 decimals as ``floor(x * 1e6 + 0.5) / 1e6``.

    The same three IEEE operations run in DuckDB (``R6`` below), so equal
    inputs give bit-equal outputs in both engines; engine ``round`` functions
    treat half-way values differently."""
    c = F.col(c) if isinstance(c, str) else c
    return F.floor(c * F.lit(1e6) + F.lit(0.5)) / F.lit(1e6)


def R6(expr: str) -> str:
    """SQL text of :func:`r6` for the DuckDB oracles."""
    return f"(floor(({expr}) * 1e6 + 0.5) / 1e6)"


def safe_div(a: Column, b: Column) -> Column:
    """a / b, NULL when b is 0 (ANSI mode raises on division by zero)."""
    return F.try_divide(a, b)
