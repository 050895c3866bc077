"""Presentation formatting (F25), an optional last step: the jobs themselves return numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalar import col_


def dollar(c: str | Column, digits: int = 2) -> Column:
    """``$1,234.50``; negative values as ``-$1,234.50``."""
    x = col_(c)
    return F.when(x < 0, F.concat(F.lit("-$"), F.format_number(-x, digits))).otherwise(
        F.concat(F.lit("$"), F.format_number(x, digits)))


def comma(c: str | Column, digits: int = 0) -> Column:
    """``12,345`` (thousands separators; ties round half-even, like R's formatting)."""
    return F.format_number(col_(c), digits)


def fixed(c: str | Column, digits: int = 2) -> Column:
    """Fixed number of decimals without separators (``format(x, nsmall=2)``)."""
    return F.format_string(f"%.{digits}f", col_(c))
