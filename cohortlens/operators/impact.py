"""Campaign impact on daily series.

Input is a daily frame (date + metric columns). Metrics are stacked to (metric, date, value), so all
series are handled by one plan and in parallel across metrics.

Two baselines:
* ``impact_mean``: the counterfactual is the pre-period mean, intervals from the pre-period standard
  deviation; pure aggregates and windows (Catalyst end to end).
* ``impact_local_level``: a local-level state-space model per series (Kalman filter, level/noise
  variance ratio fixed), fitted on the pre-period and forecast over the post-period. One
  ``applyInPandas`` group per series: a group is one metric's daily values, bounded by the number of
  days, not by data volume.
Intervals are Gaussian (no MCMC); the series windows are parameters (SURVEY Q19).
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import round_half_up
from ..params import ImpactWindows

Z95 = 1.959963984540054  # two-sided 95 % normal quantile
DEFAULT_LEVEL_RATIO = 0.01 ** 2  # level-innovation variance / observation variance


def stack_series(daily: DataFrame, metrics: Sequence[str], date: str = "date") -> DataFrame:
    return daily.select(F.col(date).alias("date"), *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(
        ["date"], list(metrics), "metric", "value")


def impact_mean(daily: DataFrame, metrics: Sequence[str], windows: ImpactWindows, digits: int = 6) -> DataFrame:
    """Per metric and post-period day: actual, predicted (pre mean), 95 % band, point effect and
    cumulative effect (W3, running sum ordered by date within each metric)."""
    long = stack_series(daily, metrics)
    (pa, pb), (qa, qb) = windows.pre, windows.post
    pre = long.where(F.col("date").between(F.lit(pa), F.lit(pb))).groupBy("metric").agg(
        F.avg("value").alias("pre_mean"), F.stddev_samp("value").alias("pre_sd"), F.count("value").alias("n_pre"))
    post = long.where(F.col("date").between(F.lit(qa), F.lit(qb)))
    j = post.join(pre, "metric")  # pre has one row per metric
    order = Window.partitionBy("metric").orderBy("date")
    run = order.rowsBetween(Window.unboundedPreceding, 0)
    eff = F.col("value") - F.col("pre_mean")
    t = F.row_number().over(order)
    r = lambda c: round_half_up(c, digits)
    return j.select(
        "metric", "date",
        r(F.col("value")).alias("actual"),
        r(F.col("pre_mean")).alias("predicted"),
        r(F.col("pre_mean") - Z95 * F.col("pre_sd")).alias("predicted_lower"),
        r(F.col("pre_mean") + Z95 * F.col("pre_sd")).alias("predicted_upper"),
        r(eff).alias("point_effect"),
        r(F.sum(eff).over(run)).alias("cumulative_effect"),
        # sd of (sum of t new days - t x estimated mean): noise of t days plus the mean's own error
        r(F.col("pre_sd") * F.sqrt(t + t * t / F.col("n_pre"))).alias("cumulative_sd"),
    )


def impact_summary(per_day: DataFrame, digits: int = 6) -> DataFrame:
    """Average and cumulative actual / predicted / absolute and relative effect per metric."""
    r = lambda c: round_half_up(c, digits)
    g = per_day.groupBy("metric").agg(
        F.count(F.lit(1)).alias("n_days"),
        F.sum("actual").alias("actual_sum"), F.sum("predicted").alias("predicted_sum"),
        F.max_by("cumulative_sd", "date").alias("sd_cum"))
    eff = F.col("actual_sum") - F.col("predicted_sum")
    return g.select(
        "metric", "n_days",
        r(F.col("actual_sum") / F.col("n_days")).alias("actual_avg"),
        r(F.col("predicted_sum") / F.col("n_days")).alias("predicted_avg"),
        r(F.col("actual_sum")).alias("actual_cum"),
        r(F.col("predicted_sum")).alias("predicted_cum"),
        r(eff).alias("abs_effect_cum"),
        r(eff - Z95 * F.col("sd_cum")).alias("abs_effect_cum_lower"),
        r(eff + Z95 * F.col("sd_cum")).alias("abs_effect_cum_upper"),
        r(F.try_divide(eff, F.col("sd_cum"))).alias("z"),
        r(F.try_divide(eff, F.col("predicted_sum"))).alias("rel_effect"),
    )


# ---- local level model ------------------------------------------------------------------------

RATIO_GRID = tuple(10.0 ** e for e in range(-6, 2))  # 1e-6 .. 10, for ratio="mle"


def _filter(z: np.ndarray, ratio: float):
    """Kalman filter of a standardised local-level series, one value per day, with unit noise variance; a missing
    value only lets the level drift. Returns the final level, its variance, the one-step errors and their variances
    (the first observation initialises)."""
    a, p = z[0], 1.0
    vs, fs = [], []
    for t in range(1, len(z)):
        p += ratio
        if np.isnan(z[t]):
            continue
        f = p + 1.0
        v = z[t] - a
        k = p / f
        a, p = a + k * v, p * (1 - k)
        vs.append(v)
        fs.append(f)
    return a, p, np.asarray(vs), np.asarray(fs)


def concentrated_loglik(z: np.ndarray, ratio: float) -> float:
    """Log-likelihood with the noise variance profiled out: -(sum log F_t + n log sigma^2) / 2."""
    _a, _p, v, f = _filter(z, ratio)
    if len(v) == 0:
        return 0.0
    sigma2 = float(np.mean(v * v / f)) or 1e-300
    return -0.5 * (float(np.sum(np.log(f))) + len(v) * math.log(sigma2))


def smooth(z: np.ndarray, level: float, noise: float):
    """Smoothed level of a local-level series (NaN where missing) with exact diffuse start: the level before the first
    observation may be anything, so the first one sets it, with the variance of the noise. Returns the means, their
    variances and the covariances of neighbouring days, given all observations."""
    n = len(z)
    a, p = np.empty(n), np.empty(n)
    a[0], p[0] = z[0], noise
    for t in range(1, n):
        a[t], p[t] = a[t - 1], p[t - 1] + level
        if not np.isnan(z[t]):
            k = p[t] / (p[t] + noise)
            a[t], p[t] = a[t] + k * (z[t] - a[t]), p[t] * (1 - k)
    m, v, c = a.copy(), p.copy(), np.zeros(max(n - 1, 0))
    for t in range(n - 2, -1, -1):
        ahead = p[t] + level
        j = p[t] / ahead if ahead > 0 else 1.0
        m[t] = a[t] + j * (m[t + 1] - a[t])
        c[t] = j * v[t + 1]
        v[t] = p[t] + j * j * (v[t + 1] - ahead)
    return m, v, c


def diffuse_loglik(z: np.ndarray, level: float, noise: float) -> float:
    """Log-likelihood of all observations but the first, which the diffuse start takes up."""
    a, p, out = z[0], noise, 0.0
    for x in z[1:]:
        p += level
        if not np.isnan(x):
            f = p + noise
            out -= 0.5 * (math.log(2 * math.pi * f) + (x - a) ** 2 / f)
            a, p = a + p / f * (x - a), p * noise / f
    return out


def learn_variances(z: np.ndarray, rounds: int = 2000, tol: float = 1e-9) -> tuple[float, float]:
    """(level variance, noise variance) of greatest likelihood, by expectation maximisation: the smoother gives the expected
    squares of noises and drifts under the present variances, and their means are the next ones. ``z`` begins and ends
    with an observation. It starts from the best ratio of ``RATIO_GRID``; with fewer than three observations nothing can
    be told apart, and that start is returned."""
    seen = ~np.isnan(z)
    ratio = max(RATIO_GRID, key=lambda r: concentrated_loglik(z, r))
    _a, _p, v, f = _filter(z, ratio)
    noise = float(np.mean(v * v / f)) if len(v) else 1.0
    level = ratio * noise
    if seen.sum() < 3 or noise == 0.0:
        return level, max(noise, 1e-12)  # a flat series has no noise to learn
    last = diffuse_loglik(z, level, noise)
    for _ in range(rounds):
        m, var, cov = smooth(z, level, noise)
        noise = float(np.mean((z[seen] - m[seen]) ** 2 + var[seen]))
        level = float(np.mean(np.diff(m) ** 2 + var[1:] + var[:-1] - 2 * cov))
        if noise <= 1e-12 or level <= 0.0:
            break
        now = diffuse_loglik(z, level, noise)
        if abs(now - last) <= tol * (abs(last) + 1):
            break
        last = now
    return max(level, 0.0), max(noise, 1e-12)


def local_level_forecast(pre: np.ndarray, steps: int | np.ndarray, ratio: float | str = DEFAULT_LEVEL_RATIO):
    """Fit a local-level model on ``pre`` (one value per day, NaN where missing; level variance = ratio x noise
    variance, noise variance by concentrated maximum likelihood) and forecast the days ``steps`` ahead (or 1, 2, ..
    up to a number). ``ratio="mle"`` picks the ratio from ``RATIO_GRID`` by concentrated likelihood (pre-periods are
    short; the fixed default is safer); ``ratio="em"`` learns both variances (``learn_variances``). Returns (mean, sd of each day, sd of the running sum up to each day)."""
    h = np.arange(1, steps + 1, dtype=float) if np.isscalar(steps) else np.asarray(steps, dtype=float)
    y = np.asarray(pre, dtype=float)
    seen = np.flatnonzero(~np.isnan(y))
    if len(seen) == 0:
        return np.full(len(h), np.nan), np.full(len(h), np.nan), np.full(len(h), np.nan)
    y = y[seen[0]:seen[-1] + 1]
    middle, scale = float(np.nanmean(y)), float(np.nanstd(y)) or 1.0
    z = (y - middle) / scale
    if ratio == "mle":
        ratio = max(RATIO_GRID, key=lambda r: concentrated_loglik(z, r))
    if ratio == "em":
        level, noise = learn_variances(z)
        m, v, _ = smooth(z, level, noise)
        n = np.arange(1, len(h) + 1)
        shared = np.cumsum(h) + 2 * np.cumsum(np.cumsum(h) - h)
        var_step, var_cum = v[-1] + h * level + noise, n ** 2 * v[-1] + level * shared + n * noise
        return np.full(len(h), m[-1] * scale + middle), np.sqrt(var_step) * scale, np.sqrt(var_cum) * scale
    a, p, vs, fs = _filter(z, float(ratio))
    sigma2 = float(np.mean(np.square(vs) / fs)) if len(vs) else 1.0
    n = np.arange(1, len(h) + 1)
    var_step = (p + h * ratio + 1.0) * sigma2
    # variance of a sum of n days: level error in each, n noises, and drifts shared by pairs (the nearer day's steps)
    shared = np.cumsum(h) + 2 * np.cumsum(np.cumsum(h) - h)
    var_cum = (n ** 2 * p + ratio * shared + n) * sigma2
    return np.full(len(h), a * scale + middle), np.sqrt(var_step) * scale, np.sqrt(var_cum) * scale


def impact_local_level(daily: DataFrame, metrics: Sequence[str], windows: ImpactWindows,
                       ratio: float | str = DEFAULT_LEVEL_RATIO, digits: int = 6) -> DataFrame:
    """M9 with a local-level baseline, one pandas group per metric (bounded by the days of both periods).

    The level moves once per calendar day, whether or not that day was observed: a missing day counts as time, and
    a post day lies as many steps ahead as it is days after the last observed pre day. The effect is summed from
    the start of the post period on."""
    (pa, pb), (qa, qb) = windows.pre, windows.post
    day = F.col("date")
    long = stack_series(daily, metrics).where(day.between(F.lit(pa), F.lit(pb)) | day.between(F.lit(qa), F.lit(qb)))
    pre_end = pd.Timestamp(pb)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("date")
        dates = pd.to_datetime(pdf["date"])
        before = (dates <= pre_end) & pdf["value"].notna()
        post = pdf.loc[dates > pre_end]
        if not before.any():
            nothing = np.full(len(post), np.nan)
            mean, sd, cum_sd = nothing, nothing, nothing
        else:
            first, last = dates[before].min(), dates[before].max()
            pre = np.full((last - first).days + 1, np.nan)
            pre[(dates[before] - first).dt.days.to_numpy()] = pdf.loc[before, "value"].to_numpy()
            mean, sd, cum_sd = local_level_forecast(pre, (dates[dates > pre_end] - last).dt.days.to_numpy(), ratio)
        eff = post["value"].to_numpy() - mean
        return pd.DataFrame({
            "metric": post["metric"].to_numpy(), "date": post["date"].to_numpy(),
            "actual": post["value"].to_numpy(), "predicted": mean,
            "predicted_lower": mean - Z95 * sd, "predicted_upper": mean + Z95 * sd,
            "point_effect": eff, "cumulative_effect": np.cumsum(eff), "cumulative_sd": cum_sd,
        })

    schema = ("metric string, date date, actual double, predicted double, predicted_lower double, "
              "predicted_upper double, point_effect double, cumulative_effect double, cumulative_sd double")
    out = long.groupBy("metric").applyInPandas(fit, schema)
    return out.select("metric", "date", *[round_half_up(c, digits).alias(c) for c in out.columns[2:]])


def organic_ltv(revenue_7day: DataFrame, attributed_installs: float, multiplier: float = 3.0,
                ads_uplift: float = 1.34, digits: int = 6) -> DataFrame:
    """M10 + J8: 7-day revenue per install x multiplier x attributed installs, plus ads uplift.
    ``attributed_installs`` is a scalar (the cumulative absolute effect), attached as a literal."""
    r = lambda c: round_half_up(c, digits)
    est = F.col("rpi_7day") * multiplier
    total = est * F.lit(attributed_installs)
    return revenue_7day.select(
        r(F.col("revenue_7_day")).alias("revenue_7_day"),
        r(F.col("rpi_7day")).alias("rpi_7day"),
        r(F.lit(attributed_installs)).alias("attributed_organic_installs"),
        r(est).alias("estimated_rpi_365_ltv"),
        r(total).alias("estimated_total_organic_revenue"),
        r(total * ads_uplift).alias("estimated_total_revenue_with_ads"),
    )


def window_dates(a: dt.date, b: dt.date) -> list[dt.date]:
    return [a + dt.timedelta(days=i) for i in range((b - a).days + 1)]
