"""Min-max scaling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def column_bounds(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Min and max of every column in one aggregate; 2 x len(cols) scalars reach the driver."""
    r = df.agg(*[F.min(c).alias(f"lo_{i}") for i, c in enumerate(cols)],
               *[F.max(c).alias(f"hi_{i}") for i, c in enumerate(cols)]).first()
    return {c: (r[f"lo_{i}"], r[f"hi_{i}"]) for i, c in enumerate(cols)}


def min_max_scale(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """M1: ``(x - min) / (max - min)`` per column; constant (or all-null) columns are dropped and
    returned, instead of producing NaN (SURVEY Q11). Returns (scaled frame, dropped columns)."""
    bounds = column_bounds(df, cols)
    dropped = [c for c, (lo, hi) in bounds.items() if lo is None or hi is None or hi == lo]
    scaled = [((F.col(c) - F.lit(lo)) / F.lit(hi - lo)).alias(c) for c, (lo, hi) in bounds.items() if c not in dropped]
    return df.select(*keep, *scaled), dropped
