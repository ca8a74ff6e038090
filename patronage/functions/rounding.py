"""Rounding that agrees across engines.

Spark rounds a double through its shortest decimal text (``round(1.005, 2)``
gives 1.01) while other engines round the binary value (1.00). Rounding the
double first to a 6-place decimal and then half-up to ``d`` places gives the
same answer everywhere, so every rounded double goes through here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_STAGE = "decimal(28,6)"


def round_half_up(col: Column, digits: int) -> Column:
    """Half-up rounding of a double (or decimal) to ``digits`` places, as double."""
    return F.round(col.cast(_STAGE), digits).cast("double")


def round_money(col: Column, precision: int = 18, scale: int = 2) -> Column:
    """Half-up rounding to a decimal(precision, scale) result."""
    return F.round(col.cast(_STAGE), scale).cast(f"decimal({precision},{scale})")


def sql_round(expr: str, digits: int) -> str:
    """SQL-text twin of :func:`round_half_up`."""
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(28,6)), {digits}) AS DOUBLE)"


def sql_round_money(expr: str, precision: int = 18, scale: int = 2) -> str:
    """SQL-text twin of :func:`round_money`."""
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(28,6)), {scale}) AS DECIMAL({precision},{scale}))"
