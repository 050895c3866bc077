"""Per-device features over day horizons.

Plan shape (why it holds at 100 TB):
* Every activity table is scanned **once** for all horizons: conditional sums
  ``sum(when(age <= h, x))`` replace one CTE per horizon (the reference scans revenue and utility twice).
* Activity is first reduced to one row per (device, day) with map-side partial aggregation, so a
  device holding a third of all rows shrinks to at most one row per day *before* the shuffle on the
  device id; the join and the per-device aggregate then see bounded groups.
* Each scan gets a constant upper date bound (``window_end + max horizon``) that Catalyst cannot
  derive from the age predicate; it reaches the parquet reader as a pushed filter.
* First touch is an aggregate (``min_by`` over (time, id)) instead of ``row_number`` over a window:
  partial aggregation again protects against a hot ad id, and the tie-break is explicit (Q7).
* ``build_features`` stacks the three reduced activity streams and left-joins them to the installs
  base once on the device id: one shuffle of the base, one join, and one per-device aggregate for all
  metrics and horizons that reuses the join's partitioning. Whether the base is broadcast is left to
  AQE, which checks its runtime size.
* Activity is pruned by the devices of the base *before* it is aggregated: a membership filter of the
  installs in the window (``membership``, broadcast with a proven bound) stands in front of every
  activity scan's partial aggregate, so neither a training build nor a one-day cohort aggregates and
  shuffles the history of every device, and raw activity rows never move. The exact join follows.
* Scoring (E2, E5) works per cohort: everything is keyed by (device, cohort date) and first touches by
  (ad id, day), so scoring a range gives what scoring its days one by one gives.
* The single-metric functions (``sessions_by_horizon`` etc.) expose the same computations one table at
  a time (registered as their own queries).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import (
    flag, match_game, null_tolerant_equals, partition_date, platform_of, round_half_up, safe_div,
    strip_device_prefix,
)
from ..params import FeatureParams
from ..session import stage
from .membership import keep_members, member_words


def scan_dates(df: DataFrame, start: dt.date, end: dt.date, parts: Sequence[str] = ("year", "month", "day")) -> DataFrame:
    """Keep rows whose zero-padded partition date lies in ``[start, end]`` (inclusive)."""
    d = partition_date(*parts)
    return df.where((d >= F.lit(start.isoformat())) & (d <= F.lit(end.isoformat())))


def installs_in_window(installs: DataFrame, p: FeatureParams, start: dt.date, end: dt.date) -> DataFrame:
    """Installs of the game in the window: s, install_dt, platform, usa."""
    return scan_dates(installs, start, end).where(match_game("game_name", p.game, p.exclude_qa)).select(
        "s",
        F.to_date("install_dt").alias("install_dt"),
        platform_of("game_name").alias("platform"),
        flag(F.col("country") == F.lit(p.usa_country)).alias("usa"),
        F.to_date(partition_date()).alias("cohort_date"),
    )


def first_touch(touches: DataFrame, p: FeatureParams, start: dt.date, end: dt.date, per_day: bool = False) -> DataFrame:
    """Earliest ad touch per ad id in the window (order: time stamp, then touch id); with ``per_day``, per ad id
    and day."""
    t = scan_dates(touches, start, end, ("yy", "mm", "dd")).where(F.lower("game_name") == p.game.lower())
    keys = ["adx_id", F.to_date(partition_date("yy", "mm", "dd")).alias("touch_date")] if per_day else ["adx_id"]
    return t.groupBy(*keys).agg(
        F.min_by("publisher_name", F.struct("time_stamp", "touch_id")).alias("publisher_name"))


def installs_base(installs_w: DataFrame, touches_first: DataFrame, per_cohort: bool = False) -> DataFrame:
    """A1 + J1: one row per device (min of each attribute, SURVEY Q6), first-touch publisher attached
    through the stripped, upper-cased device id. With ``per_cohort``: one row per device and cohort date, with the
    first touch of that day."""
    keys = ["s", "cohort_date"] if per_cohort else ["s"]
    per_device = installs_w.groupBy(*keys).agg(
        F.min("install_dt").alias("install_dt"),
        F.min("platform").alias("platform"),
        F.min("usa").alias("usa"),
    )
    on = strip_device_prefix("s") == F.col("adx_id")
    if per_cohort:
        on = on & (F.col("cohort_date") == F.col("touch_date"))
    return per_device.join(touches_first, on, "left").select(*keys, "install_dt", "platform", "usa", "publisher_name")


def cohort_base(tables, p: FeatureParams, start: dt.date, end: dt.date) -> DataFrame:
    """The installs base of every cohort date in ``[start, end]``, each as if it were scored alone."""
    return installs_base(installs_in_window(tables.installs, p, start, end),
                         first_touch(tables.touches, p, start, end, per_day=True), per_cohort=True)


def _age_ok(activity_date: Column, install_dt: Column, n: int, min_age: int | None) -> Column:
    """``date_diff(install, activity) <= n`` written as a date comparison (J2); no lower bound unless
    ``min_age`` is given (SURVEY Q3)."""
    cond = activity_date <= F.date_add(install_dt, n)
    if min_age is not None:
        cond = cond & (activity_date >= F.date_add(install_dt, min_age))
    return cond


def _keys(base: DataFrame) -> list[str]:
    """The key of the base: the device, or the device and its cohort."""
    return [c for c in ("s", "cohort_date") if c in base.columns]


def _of_base(activity: DataFrame, base: DataFrame, *cols: str) -> DataFrame:
    """The activity rows whose device may be in the base, before anything is aggregated."""
    return keep_members(activity.select("s", "activity_date", *cols), "s", member_words(base, "s"))


def sessions_by_horizon(base: DataFrame, sessions: DataFrame, p: FeatureParams, horizons: Sequence[int],
                        bound: dt.date) -> DataFrame:
    """A2: session count and total session seconds per device for each horizon, one scan."""
    daily = (
        _of_base(sessions.where(match_game("game_name", p.game, p.exclude_qa) & (F.col("activity_date") <= F.lit(bound))),
                 base, "session_length")
        .groupBy("s", "activity_date")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("session_length").cast("decimal(28,6)")).alias("len"))
    )
    j = base.select(*_keys(base), "install_dt").join(daily, "s")
    aggs = []
    for h in horizons:
        ok = _age_ok(F.col("activity_date"), F.col("install_dt"), h, p.min_age)
        aggs.append(F.sum(F.when(ok, F.col("n"))).alias(f"sessions_day_{h}"))
        aggs.append((F.sum(F.when(ok, F.col("len"))).cast("double") / 1000).alias(f"sum_session_time_day_{h}"))
    return j.groupBy(*_keys(base)).agg(*aggs)


def utility_by_horizon(base: DataFrame, utility: DataFrame, p: FeatureParams, horizons: Sequence[int],
                       bound: dt.date) -> DataFrame:
    """A3 + A4: utility per horizon and the early-half sum, one scan of the daily utility table."""
    u = (_of_base(utility.where((F.lower("game_base") == p.game.lower()) & (F.col("activity_date") <= F.lit(bound))), base, "utility")
         .groupBy("s", "activity_date").agg(F.sum("utility").alias("utility")))
    j = base.select(*_keys(base), "install_dt").join(u, "s")
    aggs = [
        F.sum(F.when(_age_ok(F.col("activity_date"), F.col("install_dt"), h, p.min_age), F.col("utility"))).alias(f"utility_day_{h}")
        for h in horizons
    ]
    aggs.append(F.sum(F.when(_age_ok(F.col("activity_date"), F.col("install_dt"), p.early_days, p.min_age),
                             F.col("utility"))).alias("early_utility_sum"))
    return j.groupBy(*_keys(base)).agg(*aggs)


def spend_by_horizons(base: DataFrame, revenue: DataFrame, p: FeatureParams, horizons: Sequence[int],
                      bound: dt.date) -> DataFrame:
    """A5: in-app spend per device for every horizon in one pass (P6 keeps null channels)."""
    daily = (
        _of_base(revenue.where(null_tolerant_equals("channel", p.iap_channel)
                               & match_game("game_name", p.game, p.exclude_qa)
                               & (F.col("activity_date") <= F.lit(bound))), base, "amt")
        .groupBy("s", "activity_date")
        .agg(F.sum(F.col("amt").cast("decimal(28,6)")).alias("amt"))
    )
    j = base.select(*_keys(base), "install_dt").join(daily, "s")
    return j.groupBy(*_keys(base)).agg(*[
        F.sum(F.when(_age_ok(F.col("activity_date"), F.col("install_dt"), h, p.min_age), F.col("amt"))).cast("double").alias(f"spend_day_{h}")
        for h in horizons
    ])


def activity_daily(tables, p: FeatureParams, start: dt.date | None = None, end: dt.date | None = None,
                   devices: DataFrame | None = None) -> DataFrame:
    """The three activity tables reduced to one row per (device, day) each, with map-side partial
    aggregation, and stacked: s, activity_date, n, len (sessions), util (utility), amt (IAP spend).
    Each table is scanned once with its own constant date bounds (a lower one only where ages have one); without a
    window there are none. With
    ``devices`` (s, repeats allowed), rows of other devices are dropped before the aggregation by a membership filter,
    which lets a few of them through; the join with the base drops those."""
    f, t = p.day_from, p.day_to
    members = None if devices is None else member_words(devices, "s")

    def rows(table: DataFrame, match: Column, days: int, *cols: str) -> DataFrame:
        kept = table.where(match)
        if end is not None:
            kept = kept.where(F.col("activity_date") <= F.lit(end + dt.timedelta(days=days)))
        if start is not None and p.min_age is not None:
            kept = kept.where(F.col("activity_date") >= F.lit(start + dt.timedelta(days=p.min_age)))
        kept = kept.select("s", "activity_date", *cols)
        kept = kept if members is None else keep_members(kept, "s", members)
        return kept.groupBy("s", "activity_date")

    name = match_game("game_name", p.game, p.exclude_qa)
    sess = rows(tables.sessions, name, f, "session_length").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("session_length").cast("decimal(28,6)")).alias("len"))
    util = rows(tables.utility, F.lower("game_base") == p.game.lower(), f, "utility").agg(F.sum("utility").alias("util"))
    spend = rows(tables.revenue, null_tolerant_equals("channel", p.iap_channel) & name, max(f, t), "amt").agg(
        F.sum(F.col("amt").cast("decimal(28,6)")).alias("amt"))
    return sess.unionByName(util, allowMissingColumns=True).unionByName(spend, allowMissingColumns=True)


class SharedActivity:
    """The tables of several feature builds ``(p, start, end)`` that differ in window and ``day_to`` only: raw activity is
    read once for all of them. Device-days of every device installed between the first start and the last end are stored,
    as far as the longest horizon reaches; each build joins its own base and sums its own ages, so it gives what it gives
    from the raw tables. Nothing is read before the first build asks."""

    def __init__(self, tables, builds: Sequence[tuple[FeatureParams, dt.date, dt.date]]):
        self.tables = tables
        self.params = builds[0][0].with_(day_to=max(p.day_to for p, _, _ in builds))
        self.start, self.end = min(b[1] for b in builds), max(b[2] for b in builds)

    @property
    def installs(self) -> DataFrame:
        return self.tables.installs

    @property
    def touches(self) -> DataFrame:
        return self.tables.touches

    @cached_property
    def _daily(self) -> DataFrame:
        devices = installs_in_window(self.installs, self.params, self.start, self.end).select("s")
        return stage(activity_daily(self.tables, self.params, self.start, self.end, devices), "device-days")

    def device_days(self, p: FeatureParams, start: dt.date, end: dt.date) -> DataFrame:
        if p.with_(day_to=self.params.day_to) != self.params or p.day_to > self.params.day_to or start < self.start or end > self.end:
            raise ValueError("this build is not one of those that share their activity")
        return self._daily


def _activity(tables, p: FeatureParams, start: dt.date, end: dt.date, devices: DataFrame) -> DataFrame:
    """The device-days of a build: shared ones, or its own from the raw tables."""
    if isinstance(tables, SharedActivity):
        return tables.device_days(p, start, end)
    return activity_daily(tables, p, start, end, devices)


def features_of(base: DataFrame, activity: DataFrame, p: FeatureParams) -> DataFrame:
    """Feature rows of an installs base (per device, or per device and cohort) and its stacked activity: one left
    join on the device, one aggregate with conditional sums for every metric and horizon."""
    f, t = p.day_from, p.day_to
    keys = [*_keys(base), "install_dt", "platform", "usa", "publisher_name"]
    age = lambda n: _age_ok(F.col("activity_date"), F.col("install_dt"), n, p.min_age)
    agg = base.join(activity, "s", "left").groupBy(*keys).agg(
        F.sum(F.when(age(f), F.col("n"))).alias(f"sessions_day_{f}"),
        (F.sum(F.when(age(f), F.col("len"))).cast("double") / 1000).alias(f"sum_session_time_day_{f}"),
        F.sum(F.when(age(f), F.col("util"))).alias(f"utility_day_{f}"),
        F.sum(F.when(age(p.early_days), F.col("util"))).alias("early_utility_sum"),
        *[F.sum(F.when(age(h), F.col("amt"))).cast("double").alias(f"spend_day_{h}") for h in sorted({f, t})],
    )
    util = F.col(f"utility_day_{f}")
    return agg.select(
        *keys,
        F.coalesce(F.col(f"sessions_day_{f}"), F.lit(0)).alias(f"sessions_day_{f}"),
        F.coalesce(F.col(f"sum_session_time_day_{f}"), F.lit(0.0)).alias(f"sum_session_time_day_{f}"),
        F.coalesce(util, F.lit(0.0)).alias(f"utility_day_{f}"),
        F.coalesce(F.col(f"spend_day_{f}"), F.lit(0.0)).alias(f"spend_day_{f}"),
        # named "recent" in the reference, but it is the first half of the horizon
        round_half_up(F.coalesce(safe_div(F.col("early_utility_sum"), util), F.lit(0.0)), 2).alias("recent_utility_ratio"),
        F.coalesce(F.col(f"spend_day_{t}"), F.lit(0.0)).alias(f"spend_day_{t}"),
    )


def build_features(tables, p: FeatureParams, start: dt.date, end: dt.date) -> DataFrame:
    """Feature rows for installs in ``[start, end]``, one per device. ``tables`` provides ``installs``, ``touches``,
    ``sessions``, ``utility`` and ``revenue`` DataFrames (the reference's five warehouse tables).

    Plan: the stacked per-device-day activity (``activity_daily``) is joined **once** to the installs
    base (left join on ``s``) and aggregated **once** per device with conditional sums for every metric
    and horizon. The base is therefore computed and shuffled once, each activity table is scanned
    once, and the aggregate reuses the join's partitioning on ``s``. Activity of devices outside the base is
    dropped in front of each scan's partial aggregate."""
    installs = installs_in_window(tables.installs, p, start, end)
    base = installs_base(installs, first_touch(tables.touches, p, start, end))
    return features_of(base, _activity(tables, p, start, end, installs.select("s")), p)


def cohort_features(tables, p: FeatureParams, start: dt.date, end: dt.date) -> DataFrame:
    """Feature rows of every cohort date in ``[start, end]``, keyed by (s, cohort_date): the union of what each day
    gives when it is scored alone."""
    devices = installs_in_window(tables.installs, p, start, end).select("s")
    return features_of(cohort_base(tables, p, start, end), _activity(tables, p, start, end, devices), p)


def training_features(tables, p: FeatureParams) -> DataFrame:
    """Features of installs in the training window ``[T-(day_to+91), T-(day_to+1)]``."""
    return build_features(tables, p, p.window_start, p.window_end)


def scoring_features(tables, p: FeatureParams, cohort_date: dt.date) -> DataFrame:
    """Features of one install cohort (partition equality on the cohort date)."""
    return cohort_features(tables, p, cohort_date, cohort_date).drop("cohort_date")


def model_frame(features: DataFrame, p: FeatureParams) -> DataFrame:
    """Typed model frame (P3, P8, P9): flags, unknown publisher, spender label."""
    f, t = p.day_from, p.day_to
    pub = F.coalesce(F.col("publisher_name"), F.lit(p.unknown_publisher))
    return features.select(
        *_keys(features),
        flag(F.col("platform") == p.ios_platform).alias("ios"),
        F.col("usa").cast("int").alias("usa"),
        flag(pub == p.organic_publisher).alias("is_publisher_organic"),
        flag(pub == p.facebook_publisher).alias("is_publisher_facebook"),
        F.col(f"sessions_day_{f}").cast("double").alias(f"sessions_day_{f}"),
        F.col(f"utility_day_{f}").cast("double").alias(f"utility_day_{f}"),
        F.col("recent_utility_ratio").cast("double").alias("recent_utility_ratio"),
        F.col(f"spend_day_{f}").cast("double").alias(f"spend_day_{f}"),
        F.col(f"spend_day_{t}").cast("double").alias(f"spend_day_{t}"),
        (F.col(f"spend_day_{t}") != 0).alias("spender"),
    )


def feature_lists(p: FeatureParams) -> tuple[list[str], list[str]]:
    """Classifier and regressor inputs; one list for CV, final fit and scoring."""
    common = [f"utility_day_{p.day_from}", "recent_utility_ratio", "ios", "usa",
              "is_publisher_organic", "is_publisher_facebook"]
    return common, common + [f"spend_day_{p.day_from}"]
