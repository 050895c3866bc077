"""Grouped summaries behind the report tables and charts.

Every summary is a hash aggregate with map-side partial aggregation, so a hot group is combined
before the shuffle. Windows run only on already aggregated frames (share of total), never on raw rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import money_avg, money_sum, round_half_up, safe_div
from ..session import cut_lineage
from .prepare import label_period


def _ordered_union(groups: Sequence[Sequence[str]]) -> list[str]:
    out: list[str] = []
    for g in groups:
        out += [c for c in g if c not in out]
    return out


def group_summary(df: DataFrame, flags: Sequence[str], value: str = "d365_RPI", digits: int = 0) -> DataFrame:
    """Count and mean of ``value`` per level of each flag, all flags in one pass (the flags are
    stacked, then one aggregate): flag, level, n, avg_value."""
    stacked = df.select(value, *[F.col(c).cast("int").alias(c) for c in flags]).unpivot(
        value, list(flags), "flag", "level")
    return stacked.groupBy("flag", "level").agg(
        F.count(F.lit(1)).alias("n"),
        round_half_up(money_avg(value), digits).alias(f"avg_{value.lower()}"),
    )


def share_of_total(df: DataFrame, key: str, name: str | None = None) -> DataFrame:
    """A7 + W2: count per level and its share of the total. The window over () runs on the grouped
    result (one row per level), not on raw rows."""
    g = df.groupBy(F.col(key).cast("string").alias("level")).agg(F.count(F.lit(1)).alias("n"))
    out = g.withColumn("pct", F.col("n") / F.sum("n").over(Window.partitionBy()))
    return out.select(F.lit(name or key).alias("dimension"), "level", "n", "pct")


def category_mean(df: DataFrame, key: str, value: str, digits: int = 6, alias: str | None = None) -> DataFrame:
    """A8 + O1: mean of ``value`` per category, highest first."""
    name = alias or f"avg_{value}"
    return df.groupBy(key).agg(round_half_up(F.avg(value), digits).alias(name)).orderBy(F.desc(name), key)


def column_means(df: DataFrame, cols: Sequence[str], digits: int = 6, name: str = "variable",
                 value: str = "mean") -> DataFrame:
    """A9 + R4: one global aggregate of many means, then long form (variable, mean)."""
    wide = df.agg(*[round_half_up(F.avg(c), digits).alias(c) for c in cols])
    return wide.unpivot([], list(cols), name, value)


def global_bounds(df: DataFrame, col: str) -> tuple[float, float]:
    """Global (min, max) of one column: one aggregate, two scalars to the driver."""
    r = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    return r["lo"], r["hi"]


def histogram(df: DataFrame, col: str, bins: int = 30, log: bool = False, digits: int = 6) -> DataFrame:
    """Equal-width histogram over [min, max]; the maximum falls in the last bin.
    bin (1..bins), bin_start, n. ``log=True`` bins ``ln(x)`` of positive values."""
    x = F.ln(F.col(col)) if log else F.col(col)
    src = df.where(F.col(col) > 0) if log else df
    src = cut_lineage(src.select(x.alias("x")).where(F.col("x").isNotNull()))  # one column, read for the range and the counts
    lo, hi = global_bounds(src, "x")
    if lo is None:
        return src.sparkSession.createDataFrame([], "bin int, bin_start double, n bigint")
    width = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.floor((F.col("x") - F.lit(lo)) / F.lit(width)) + 1, F.lit(bins)).cast("int")
    return src.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n")).select(
        "bin", round_half_up(F.lit(lo) + (F.col("bin") - 1) * F.lit(width), digits).alias("bin_start"), "n")


def trend_lines(df: DataFrame, x: str, y: str, grouping_sets: Sequence[Sequence[str]], digits: int = 6) -> DataFrame:
    """Least-squares line per group for several groupings in one pass (GROUPING SETS):
    slope, intercept, r2, n, and ``facet_level`` = grouping id over all facet columns."""
    cols = _ordered_union(grouping_sets)
    aggs = [
        F.grouping_id(*cols).alias("facet_level") if cols else F.lit(0).alias("facet_level"),
        round_half_up(F.regr_slope(F.col(y), F.col(x)), digits).alias("slope"),
        round_half_up(F.regr_intercept(F.col(y), F.col(x)), digits).alias("intercept"),
        round_half_up(F.regr_r2(F.col(y), F.col(x)), digits).alias("r2"),
        F.regr_count(F.col(y), F.col(x)).alias("n"),
    ]
    if not cols:
        return df.agg(*aggs)
    return df.groupingSets([[F.col(c) for c in g] for g in grouping_sets], *cols).agg(*aggs)


def prediction_curves(df: DataFrame, value: str, grouping_sets: Sequence[Sequence[str]], digits: int = 6,
                      alias: str = "avg_predicted_rpi") -> DataFrame:
    """Mean prediction for several key lists in one pass (GROUPING SETS)."""
    cols = _ordered_union(grouping_sets)
    return df.groupingSets([[F.col(c) for c in g] for g in grouping_sets], *cols).agg(
        F.grouping_id(*cols).alias("facet_level"),
        round_half_up(F.avg(value), digits).alias(alias),
        F.count(F.lit(1)).alias("n"),
    )


#: No wide frame has more columns from its data than this; beyond it ``sparse`` works on rows.
MAX_LEVELS = 20_000


def distinct_values(df: DataFrame, col: str, limit: int = MAX_LEVELS) -> list:
    """Distinct levels of a categorical column, null last. They name the columns of a wide frame: more than ``limit``
    of them are an error (none is dropped), and only that many ever reach the driver."""
    rows = df.select(col).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{col} has more than {limit} levels: too many for one column each, use operators.sparse")
    return sorted((r[0] for r in rows), key=lambda v: (v is None, v))


def cost_per_install(daily: DataFrame, windows: Mapping[str, tuple[dt.date, dt.date]], spend: str = "daily_spend",
                     installs: str = "paid_installs") -> DataFrame:
    """P11 + A11: period label, filter *before* the aggregate, ratio of sums."""
    lab = daily.withColumn("period", label_period("date", windows)).where(F.col("period") != "other")
    return lab.groupBy("period").agg(
        money_sum(spend).alias("total_spend"),
        F.sum(installs).alias("total_paid_installs"),
    ).withColumn("cpi", safe_div(F.col("total_spend"), F.col("total_paid_installs")))


def daily_ratio(daily: DataFrame, num: str = "daily_spend", den: str = "paid_installs", name: str = "cpi") -> DataFrame:
    """Per-day ratio; null where the denominator is zero."""
    return daily.select("date", num, den, safe_div(F.col(num), F.col(den)).alias(name))
