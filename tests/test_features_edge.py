"""Hand-made edge fixtures for the feature build (FIXTURES X1-X7)."""

import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from cohortlens.functions.scalar import match_game, platform_of, strip_device_prefix
from cohortlens.operators import features as feat
from cohortlens.params import FeatureParams

D = dt.date
P = FeatureParams(game="mygame", day_from=7, day_to=30, training_date=D(2020, 3, 1), exclude_qa=True)  # window 2019-11-01..2020-01-30


def parts(d):
    return f"{d:%Y}", f"{d:%m}", f"{d:%d}"


def world(spark, installs, touches=(), sessions=(), utility=(), revenue=()):
    inst = spark.createDataFrame(
        [(s, d, g, c, *parts(d)) for s, d, g, c in installs],
        "s string, install_dt date, game_name string, country string, year string, month string, day string")
    tch = spark.createDataFrame(
        [(a, p, "mygame", ts, i, *parts(ts.date())) for a, p, ts, i in touches],
        "adx_id string, publisher_name string, game_name string, time_stamp timestamp, touch_id long, "
        "yy string, mm string, dd string")
    ses = spark.createDataFrame(list(sessions), "s string, game_name string, activity_date date, session_length double")
    uti = spark.createDataFrame(list(utility), "s string, game_base string, activity_date date, utility double")
    rev = spark.createDataFrame(list(revenue), "s string, game_name string, activity_date date, amt double, channel string")
    return SimpleNamespace(installs=inst, touches=tch, sessions=ses, utility=uti, revenue=rev)


def test_x1_game_match_and_platform(spark):
    names = ["Mygame_IOS", "MygameQA_IOS", "my.game_IOS", "mygame"]
    df = spark.createDataFrame([(n,) for n in names], "g string").select(
        "g", match_game("g", "mygame", True).alias("fixed"), match_game("g", "mygame", False).alias("literal"),
        platform_of("g").alias("platform"))
    got = {r["g"]: (r["fixed"], r["literal"], r["platform"]) for r in df.collect()}
    assert got["Mygame_IOS"] == (True, True, "IOS")
    assert got["MygameQA_IOS"] == (False, True, "IOS")  # literal pattern never excluded QA (Q1)
    assert got["my.game_IOS"] == (False, False, "IOS")
    assert got["mygame"] == (True, True, None)  # missing part -> null, not an error (Q27)


def test_strip_prefix(spark):
    df = spark.createDataFrame([("IDFV-abc",), ("idfv-x",), ("cust-1",)], "s string")
    assert [r[0] for r in df.select(strip_device_prefix("s")).collect()] == ["ABC", "IDFV-X", "CUST-1"]


def test_x2_window_edges_inclusive(spark):
    a, b = P.window_start, P.window_end
    assert (a, b) == (D(2019, 11, 1), D(2020, 1, 30))  # 91 days inclusive (Q2)
    w = world(spark, [("d1", a, "Mygame_IOS", "US"), ("d2", b, "Mygame_IOS", "US"),
                      ("d3", a - dt.timedelta(1), "Mygame_IOS", "US"), ("d4", b + dt.timedelta(1), "Mygame_IOS", "US")])
    out = feat.training_features(w, P)
    assert sorted(r["s"] for r in out.collect()) == ["d1", "d2"]


def test_x3_horizon_has_no_lower_bound(spark):
    i = D(2019, 12, 1)
    ages = [-1, 0, 7, 8]
    rev = [("d1", "Mygame_IOS", i + dt.timedelta(a), 10.0 * (k + 1), "IAP") for k, a in enumerate(ages)]
    w = world(spark, [("d1", i, "Mygame_IOS", "US")], revenue=rev)
    r = feat.training_features(w, P).first()
    assert r["spend_day_7"] == 10.0 + 20.0 + 30.0  # ages -1, 0, 7 (Q3)
    assert r["spend_day_30"] == 100.0
    r2 = feat.training_features(w, P.with_(min_age=0)).first()
    assert r2["spend_day_7"] == 50.0


def test_x4_utility_ratio(spark):
    i = D(2019, 12, 1)
    util = [("zero", "Mygame", i, 0.0),
            ("early", "Mygame", i + dt.timedelta(1), 4.0),
            ("late", "mygame", i + dt.timedelta(1), 1.0), ("late", "mygame", i + dt.timedelta(6), 3.0)]
    w = world(spark, [(s, i, "Mygame_IOS", "US") for s in ("zero", "absent", "early", "late")], utility=util)
    got = {r["s"]: (r["utility_day_7"], r["recent_utility_ratio"]) for r in feat.training_features(w, P).collect()}
    assert got["zero"] == (0.0, 0.0)  # 0/0 -> 0, no divide-by-zero error under ANSI (Q5)
    assert got["absent"] == (0.0, 0.0)
    assert got["early"] == (4.0, 1.0)
    assert got["late"] == (4.0, 0.25)  # early half = age <= floor(7/2) = 3 (Q4)


def test_x5_one_row_per_device(spark):
    i = D(2019, 12, 1)
    w = world(spark, [("d1", i, "Mygame_IOS", "United States"), ("d1", i, "Mygame_ANDROID", "Canada")],
              revenue=[("d1", "Mygame_IOS", i, 5.0, "IAP")])
    rows = feat.training_features(w, P).collect()
    assert len(rows) == 1  # no doubling of sums (Q6)
    assert rows[0]["platform"] == "ANDROID" and rows[0]["usa"] == 0 and rows[0]["spend_day_7"] == 5.0


def test_x6_first_touch_tie_break_and_null_publisher(spark):
    i = D(2019, 12, 1)
    ts = dt.datetime(2019, 12, 1, 10)
    w = world(spark, [("IDFV-a", i, "Mygame_IOS", "US"), ("b", i, "Mygame_IOS", "US")],
              touches=[("A", "zeta", ts, 2), ("A", "alpha", ts, 1), ("B", None, ts, 1),
                       ("B", "late", ts + dt.timedelta(hours=1), 0)])
    got = {r["s"]: r["publisher_name"] for r in feat.training_features(w, P).collect()}
    assert got == {"IDFV-a": "alpha", "b": None}  # equal time -> lower touch id (Q7); null kept
    mf = feat.model_frame(feat.training_features(w, P), P).collect()
    assert all(r["is_publisher_organic"] == 0 for r in mf)


def test_x7_channel_null_counts_as_iap(spark):
    i = D(2019, 12, 1)
    w = world(spark, [("d1", i, "Mygame_IOS", "US")],
              revenue=[("d1", "Mygame_IOS", i, 1.0, None), ("d1", "Mygame_IOS", i, 2.0, "IAP"),
                       ("d1", "Mygame_IOS", i, 4.0, "ADS"), ("d1", "MygameQA_IOS", i, 8.0, "IAP")])
    assert feat.training_features(w, P).first()["spend_day_7"] == 3.0


def test_horizons_monotone(spark):
    from conftest import SF_SMALL
    from cohortlens.plans.queries import QUERIES, SPEND_HORIZONS
    rows = QUERIES["spend_by_horizons"](spark, SF_SMALL).collect()
    assert rows
    for r in rows:
        vals = [r[f"spend_day_{h}"] or 0.0 for h in SPEND_HORIZONS]
        assert vals == sorted(vals)


@pytest.mark.parametrize("cohort", [D(1995, 1, 1)])
def test_scoring_is_one_cohort(spark, cohort):
    from conftest import SF_SMALL
    from cohortlens.plans.queries import QUERIES
    rows = QUERIES["scoring_features"](spark, SF_SMALL).collect()
    assert {r["install_dt"] for r in rows} <= {cohort}
