"""End-to-end jobs E3-E8 run on the test tables (smoke + properties)."""

import datetime as dt
import math
import os

import pytest
from pyspark.sql import functions as F

from cohortlens.params import TEST_FEATURES, CampaignParams, HurdleParams
from cohortlens.plans import jobs
from cohortlens.plans.queries import OVERLAYS, TEST_USA_CANADA
from cohortlens.sources.testdata import load_world
from conftest import SF_MID, SF_SMALL


def test_player_value_report(spark):
    w = load_world(spark, SF_SMALL)
    out = jobs.player_value_report(w.players, w.spend, None,
                                   insignificant=("Spend_Distr_LARGE", "Spend_Distr_MEDIUM"), folds=3)
    comp = {r["model"]: r for r in out["fit_comparison"].collect()}
    assert set(comp) == {"model_full", "model_no_spend_distribution", "model_full_log", "model_no_spend_distribution_log"}
    assert comp["model_full_log"]["response"] == "log(d365_RPI)"
    assert all(0 <= r["r2"] <= 1 for r in comp.values())
    assert out["cv"].count() == 5
    terms = [r["term"] for r in out["coefficients"].collect()]
    shares = [t for t in terms if "Distr" in t]
    assert terms[-len(shares):] == shares  # share terms last (U2)
    assert out["predictions"].where(F.col("predictions") <= 0).count() == 0  # exp back-transform
    assert out["curves"].count() > 0 and out["histogram"].count() <= 30


def test_segment_users(spark):
    w = load_world(spark, SF_SMALL)
    out = jobs.segment_users(w.userbase, None, None, TEST_USA_CANADA, ks=(3, 4, 5), chosen_k=4)
    assert out["k"] == 4
    assert out["clusters"].count() == w.userbase.count()
    prof = out["profile"].collect()
    assert sum(r["n"] for r in prof) == w.userbase.count() and len(prof) <= 4
    scaled = out["scaled"]
    for c in scaled.columns:
        if c in ("s", "vip"):
            continue
        lo, hi = scaled.agg(F.min(c), F.max(c)).first()
        assert 0.0 <= lo <= hi <= 1.0
    wss = sorted((r["k"], r["wss"]) for r in out["wss"].collect())
    assert len(wss) == 3


def test_campaign_report(spark):
    w = load_world(spark, SF_SMALL)
    for local in (False, True):
        out = jobs.campaign_report(w.daily, w.revenue_7day, CampaignParams(), overlays=OVERLAYS, local_level=local)
        summ = {r["metric"]: r for r in out["impact_summary"].collect()}
        assert set(summ) == {"organic_installs", "organic_revenue", "dau"}
        ltv = out["organic_ltv"].first()
        assert math.isclose(ltv["estimated_total_revenue_with_ads"], 1.34 * ltv["estimated_total_organic_revenue"],
                            rel_tol=1e-5, abs_tol=1e-5)
        assert {r["period"] for r in out["cpi"].collect()} == {"pre_period", "post_period"}


@pytest.mark.slow
def test_train_score_publish_backfill(spark, tmp_dir):
    w = load_world(spark, SF_MID)
    hp = HurdleParams(folds=2, nrounds=(3, 6), etas=(0.1,), hurdles=(0.1, 0.3), parallelism=4)
    root = os.path.join(tmp_dir, "models")
    res = jobs.train_revenue_model(w, TEST_FEATURES, hp, model_root=root)
    assert res["cv"].count() == 4  # 2 nrounds x 1 eta x 2 hurdles
    assert res["best"]["nrounds"] in (3, 6)
    assert os.path.isdir(res["path"])
    from cohortlens.sources import registry
    model = registry.load_latest_model(spark, root, "shop", TEST_FEATURES.day_from, TEST_FEATURES.day_to)
    table = os.path.join(tmp_dir, "revenue_predictions_shop")
    cols = ["day_90_day_365", "day_90_day_730"]
    d = dt.date(1995, 1, 1)
    pub = jobs.score_and_publish(w, TEST_FEATURES, d, model, table, cols)
    scored = jobs.score_cohort(w, TEST_FEATURES, d, model)
    assert pub.count() == scored.count()
    assert pub.where(F.col("day_90_day_730").isNotNull()).count() == 0
    back = jobs.backfill_predictions(w, TEST_FEATURES, d, dt.date(1995, 1, 31), {365: model})
    assert back.where(F.col("cohort_date") == d).count() == scored.count()
    a = {r["s"]: r["day_90_day_365"] for r in back.where(F.col("cohort_date") == d).collect()}
    b = {r["s"]: r["day_90_day_365"] for r in scored.collect()}
    assert a.keys() == b.keys()
    jobs.backfill(w, TEST_FEATURES, d, dt.date(1995, 1, 31), {365: model}, table, cols)
    days = {(r["month"], r["day"]) for r in spark.read.parquet(table).select("month", "day").distinct().collect()}
    assert len(days) == back.select("cohort_date").distinct().count()


def test_query_registry_rejects_duplicates():
    from cohortlens.plans.queries import query
    with pytest.raises(ValueError):
        query("training_features")(lambda spark, sf_dir: None)


@pytest.mark.slow
def test_backfill_equals_scoring_the_days_alone(spark):
    from types import SimpleNamespace
    from cohortlens.plans import model_queries as mq
    w = load_world(spark, SF_SMALL)
    again = SimpleNamespace(**{t: getattr(w, t) for t in ("touches", "sessions", "utility", "revenue")}, installs=w.installs_again)
    model, _ = mq.train_final(w, nrounds=3)
    a, days = dt.date(1995, 1, 1), 12
    whole = jobs.backfill_predictions(again, TEST_FEATURES, a, a + dt.timedelta(days - 1), {TEST_FEATURES.day_to: model})
    got = sorted((r["s"], r["cohort_date"], r[2]) for r in whole.collect())
    want = []
    for k in range(days):
        d = a + dt.timedelta(k)
        want += [(r["s"], d, r[1]) for r in jobs.score_cohort(again, TEST_FEATURES, d, model).collect()]
    assert len(want) >= 5 and got == sorted(want)


def test_backfill_query_trains_with_the_final_setting(monkeypatch):
    from cohortlens.plans import model_queries as mq
    asked = []
    monkeypatch.setattr(mq, "load_world", lambda spark, sf_dir: "world")
    monkeypatch.setattr(mq, "train_final", lambda w, day_to, **setting: asked.append((day_to, setting)) or (f"model {day_to}", None))
    monkeypatch.setattr(mq.jobs, "backfill_predictions", lambda w, p, start, end, models: models)
    assert mq.backfill_predictions(None, "") == {h: f"model {h}" for h in mq.BACKFILL_MODELS}
    assert asked == [(h, {}) for h in mq.BACKFILL_MODELS]  # as score_cohort: no setting but the final one


def test_fits_begin_at_a_checkpoint(spark, monkeypatch):
    """Every small job of a fit carries the lineage of its input: neither the frame nor what cross-validation fits on may
    lead back to the joins behind it."""
    from cohortlens.operators import hurdle as hd
    from cohortlens.plans import model_queries as mq
    frame = jobs.revenue_model_frame(load_world(spark, SF_SMALL), TEST_FEATURES, mq.HP)
    seen = []
    real = hd.HurdleRegressor._fit
    monkeypatch.setattr(hd.HurdleRegressor, "_fit", lambda self, df: seen.append(df) or real(self, df))
    joined = frame.where("split = 'train'").join(frame.select("s").distinct(), "s")
    hd.hurdle_cv(joined, jobs.base_spec(TEST_FEATURES, mq.HP), 2, (2,), (0.1,), (0.2,), parallelism=2)
    lineage = [df._jdf.queryExecution().toRdd().toDebugString() for df in (frame, *seen)]
    assert len(lineage) == 3 and not any("Shuffled" in text or "InMemory" in text for text in lineage)


def test_builds_that_share_their_activity(spark, monkeypatch):
    """Device-days that are stored once give each build what it reads from the raw tables."""
    from cohortlens.operators import features as feat
    w, p, q = load_world(spark, SF_SMALL), TEST_FEATURES, TEST_FEATURES.with_(day_to=180)
    a, b = dt.date(1995, 1, 1), dt.date(1995, 1, 31)
    shared = feat.SharedActivity(w, [(p, a, b), *((x, x.window_start, x.window_end) for x in (p, q))])
    reads, real = [], feat.activity_daily
    want = [feat.training_features(w, p), feat.training_features(w, q), feat.cohort_features(w, p, a, b)]
    monkeypatch.setattr(feat, "activity_daily", lambda *args, **kw: reads.append(1) or real(*args, **kw))
    got = [feat.training_features(shared, p), feat.training_features(shared, q), feat.cohort_features(shared, p, a, b)]
    for one, other in zip(got, want):
        rows = sorted(map(repr, one.collect()))
        assert rows and rows == sorted(map(repr, other.collect()))
    assert len(reads) == 1
    for other, start in ((p.with_(day_from=30), a), (p.with_(day_to=720), a), (p, a - dt.timedelta(1))):
        with pytest.raises(ValueError, match="share"):
            feat.cohort_features(shared, other, start, b)


def test_registry_query_builds_its_frame_once(spark, monkeypatch):
    from cohortlens.operators import features as feat
    from cohortlens.plans import model_queries as mq
    frames, reads, build, daily = [], [], jobs.revenue_model_frame, feat.activity_daily
    monkeypatch.setattr(jobs, "revenue_model_frame", lambda *a: frames.append(1) or build(*a))
    monkeypatch.setattr(feat, "activity_daily", lambda *a, **kw: reads.append(1) or daily(*a, **kw))
    rows = mq.registry_round_trip(spark, SF_SMALL).collect()
    assert all(r["loaded"] == r["in_memory"] for r in rows)
    assert (len(frames), len(reads)) == (1, 1)
