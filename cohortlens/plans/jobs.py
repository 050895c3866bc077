"""End-to-end jobs. Each returns DataFrames (or a dict of them); the only
driver-side data are model objects, p x p matrices, metric rows and a few scalars."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.maps import map_keys, parse_map
from ..operators import features as feat
from ..operators import hurdle as hd
from ..operators import impact as imp
from ..operators import intervals as iv
from ..operators import linear as lin
from ..operators import prepare as prep
from ..operators import reshape as rs
from ..operators import sampling as smp
from ..operators import scaling as sc
from ..operators import segments as seg
from ..operators import sparse as sp
from ..operators import summarise as sm
from ..params import CampaignParams, FeatureParams, HurdleParams
from ..session import cut_lineage, right_size
from ..sources import activity_store, registry, sinks, snapshots

# ---- revenue model (E1-E5) ------------------------------------------------------------------------

training_features = feat.training_features  # E1
scoring_features = feat.scoring_features    # E2


def revenue_model_frame(tables, p: FeatureParams, hp: HurdleParams) -> DataFrame:
    """E1 -> typed model frame -> optional fixed-size sample (O3) -> train/test label (O4) ->
    stratified folds within train (O5). The finished frame is checkpointed: a fit runs thousands of small jobs, each of
    which carries the whole lineage of its input, so theirs begins at the checkpoint and not at the fold joins."""
    mf = feat.model_frame(feat.training_features(tables, p), p)
    h = smp.string_key_hash("s", hp.seed)
    if hp.sample_rows:
        mf = smp.sample_n(mf, hp.sample_rows, "s", hash_col=h)
    mf = smp.train_test_split(mf, "s", hp.train_fraction, hash_col=h)
    # strata (split, spender): exact spender-stratified folds within the training rows; the fold
    # assignment checkpoints the frame once, so the features are computed a single time
    folds = smp.stratified_folds(mf, "s", ["split", "spender"], hp.folds,
                                 hash_col=smp.string_key_hash("s", hp.seed + 1))
    return cut_lineage(right_size(folds.withColumn("fold", F.when(F.col("split") == "test", F.lit(-1)).otherwise(F.col("fold")))))


def base_spec(p: FeatureParams, hp: HurdleParams) -> hd.HurdleSpec:
    clf, reg = feat.feature_lists(p)
    return hd.HurdleSpec(clf, reg, label=f"spend_day_{p.day_to}", observed=f"spend_day_{p.day_from}",
                         max_depth=hp.max_depth, seed=hp.seed, spenders_only=hp.spenders_only,
                         meta={"game": p.game, "day_from": p.day_from, "day_to": p.day_to})


def train_revenue_model(tables, p: FeatureParams, hp: HurdleParams, model_root: str | None = None) -> dict:
    """Features, split, folds, CV over (nrounds, eta) x hurdles, best setting, final fit, hold-out
    metrics, importances, optional save to the registry."""
    frame = revenue_model_frame(tables, p, hp)
    train, test = frame.where(F.col("split") == "train"), frame.where(F.col("split") == "test")
    spec0 = base_spec(p, hp)
    per_fold = hd.hurdle_cv(train, spec0, hp.folds, hp.nrounds, hp.etas, hp.hurdles, parallelism=hp.parallelism)
    summary = hd.summarise_settings(per_fold)
    best = hd.best_setting(summary).first()
    spec = replace(spec0, nrounds=int(best["nrounds"]), eta=float(best["eta"]), hurdle=best["hurdle_pct"] / 100)
    model, holdout = hd.fit_final(train, test, spec)
    out = {"cv": summary, "best": best, "model": model, "holdout": holdout,
           "importance": model.feature_importance(frame.sparkSession)}
    if model_root:
        m = holdout.first()
        out["path"] = registry.save_model(frame.sparkSession, model, model_root, p.game, p.day_from, p.day_to,
                                          metrics=f"rmse={m['rmse']};mae={m['mae']}")
    return out


def prediction_column(p: FeatureParams) -> str:
    return f"day_{p.day_from}_day_{p.day_to}"


def score_cohort(tables, p: FeatureParams, cohort_date: dt.date, model: hd.HurdleModel) -> DataFrame:
    """One cohort's features -> model -> (s, day_<from>_day_<to>)."""
    mf = feat.model_frame(feat.scoring_features(tables, p, cohort_date), p)
    return model.transform(mf).select("s", F.col("prediction").alias(prediction_column(p)))


def score_and_publish(tables, p: FeatureParams, cohort_date: dt.date, model: hd.HurdleModel, table_path: str,
                      all_columns: Sequence[str]) -> DataFrame:
    """Score a cohort and upsert its prediction column into the date-partitioned table."""
    preds = score_cohort(tables, p, cohort_date, model)
    return sinks.upsert_cohort(preds.sparkSession, table_path, cohort_date, preds, prediction_column(p), all_columns)


def add_activity(store: activity_store.ActivityStore, arrived, p: FeatureParams, batch: str) -> int:
    """E4 upkeep: the raw activity that arrived with a batch (``sessions``, ``utility``, ``revenue``) as device-days into
    the store, in place of what the batch held before."""
    return store.put(batch, feat.activity_daily(arrived, p))


def publish_cohorts(tables, p: FeatureParams, start: dt.date, end: dt.date, models: Mapping[int, hd.HurdleModel],
                    root: str, all_columns: Sequence[str], store: activity_store.ActivityStore | None = None) -> int:
    """E4 / E5 into a versioned table: all cohorts in [start, end] for every horizon model become visible at once, as one
    new version, which is returned. With a ``store`` its device-days are used and no raw activity is read."""
    preds = backfill_predictions(tables, p, start, end, models, store)
    cols = [f"day_{p.day_from}_day_{h}" for h in sorted(models)]
    return snapshots.upsert_snapshot(preds.sparkSession, root, preds, "cohort_date", cols, all_columns)


def backfill_predictions(tables, p: FeatureParams, start: dt.date, end: dt.date,
                         models: Mapping[int, hd.HurdleModel],
                         store: activity_store.ActivityStore | None = None) -> DataFrame:
    """Every cohort in [start, end] x every horizon in one job: one feature build keyed by (device, cohort
    date) (the model inputs do not depend on the horizon), one projection per horizon model; no loop of queries.
    Equals the union of ``score_cohort`` over the days."""
    rows = (feat.cohort_features(tables, p, start, end) if store is None
            else activity_store.features(store, tables, p, start, end, per_cohort=True))
    mf = feat.model_frame(rows, p)
    cols = []
    for h, model in sorted(models.items()):
        name = f"day_{p.day_from}_day_{h}"
        mf = model.predict_with(mf, name=name).drop("p_spender", "amount")
        cols.append(name)
    return mf.select("s", "cohort_date", *cols)


def backfill(tables, p: FeatureParams, start: dt.date, end: dt.date, models: Mapping[int, hd.HurdleModel],
             table_path: str, all_columns: Sequence[str]) -> DataFrame:
    """E5: score every cohort in [start, end] for every horizon model and upsert all of them into the
    date-partitioned table with one write."""
    preds = backfill_predictions(tables, p, start, end, models)
    cols = [f"day_{p.day_from}_day_{h}" for h in sorted(models)]
    return sinks.upsert_partitions(preds.sparkSession, table_path, preds, "cohort_date", cols, all_columns)


# ---- player value report (E6) ---------------------------------------------------------------------

BASE_FEATURES = ["submissions", "sessions", "avg_rating_received", "united_states", "facebook_connected",
                 "paid_source", "returner"]


def player_model_frame(players: DataFrame, spend: DataFrame, categories: Sequence[str] | None = None) -> tuple[DataFrame, list[str]]:
    """Cleaned players + spend shares wide (R3, J4) + squared and interaction terms (M13). Without ``categories``
    they are those found in ``spend``."""
    clean = prep.clean_players(players)
    wide = prep.sanitize_names(rs.pivot_long(spend, "player_id", "category_name", "pct_spend", categories,
                                             prefix="Spend Distr "))
    share_cols = [c for c in wide.columns if c != "player_id"]
    df = clean.join(wide, "player_id", "left").fillna(0.0, subset=share_cols)
    df = prep.add_terms(df, prep.PLAYER_SQUARES, prep.PLAYER_INTERACTIONS)
    return df, share_cols


def comparison_specs(share_cols: Sequence[str], label: str = "d365_RPI") -> dict[str, tuple]:
    """The four fits compared by adjusted R² and AIC: with / without spend shares, raw / log response."""
    full = BASE_FEATURES + list(share_cols)
    return {"model_full": (full, label, False), "model_no_spend_distribution": (BASE_FEATURES, label, False),
            "model_full_log": (full, label, True), "model_no_spend_distribution_log": (BASE_FEATURES, label, True)}


def linear_specs(share_cols: Sequence[str], insignificant: Sequence[str]) -> dict[str, list[str]]:
    full = BASE_FEATURES + list(share_cols)
    sq = [f"{c}Sqd" for c in prep.PLAYER_SQUARES]
    inter = list(prep.PLAYER_INTERACTIONS)
    refined = [c for c in full if c not in insignificant] + sq + ["fb_x_sessions", "fb_x_united_states"]
    return {"model_full": full, "model_quadratic": full + sq, "model_interaction": full + inter,
            "model_combo": full + sq + inter, "model_refined": refined}


def player_value_report(players: DataFrame, spend: DataFrame, categories: Sequence[str] | None = None,
                        insignificant: Sequence[str] = (), folds: int = 10, seed: int = 123) -> dict:
    """Summaries, charts' data, model comparison, CV, coefficients, effects, prediction curves."""
    spark = players.sparkSession
    df, shares = player_model_frame(players, spend, categories)
    df = right_size(cut_lineage(prep.bin_players(df)))
    flags = ["united_states", "facebook_connected", "paid_source", "returner"]
    out = {
        "group_summary": sm.group_summary(df, flags),
        "histogram": sm.histogram(df, "d365_RPI"),
        "histogram_log": sm.histogram(df, "d365_RPI", log=True),
        "histogram_rating": sm.histogram(df, "avg_rating_received"),
        "category_mean": sm.category_mean(spend, "category_name", "pct_spend"),
    }
    out["fit_comparison"] = lin.compare_fits(spark, lin.fit_many(df, comparison_specs(shares)))
    specs = linear_specs(shares, insignificant)
    folded = smp.hash_folds(df, "player_id", folds, seed)
    out["cv_folds"], out["cv"] = lin.linear_cv(folded, specs, "d365_RPI", log_label=True, k=folds)
    refined = lin.fit_linear(df, specs["model_refined"], "d365_RPI", log_label=True)
    out["refined"] = refined
    out["coefficients"] = refined.coefficients(spark)
    out["effects"] = spark.createDataFrame([
        refined.effect_size("sessions", 0, 1), refined.effect_size("submissions", 0, 1),
        refined.effect_size("facebook_connected", 0, 1), refined.effect_size("paid_source", 0, 1)],
        "variable string, `from` double, `to` double, slope double, pct_change double")
    preds = refined.predict(df, "predictions")
    out["predictions"] = preds.select("player_id", "d365_RPI", "predictions")
    s, fb, sb, st = "sessions", "facebook_connected", "submissions_bin", "stars_received_bin"
    out["curves"] = sm.prediction_curves(preds.where(F.col("sessions").between(0, 150)), "predictions",
                                         [[s], [s, fb], [s, fb, sb], [s, fb, sb, st]])
    return out


# ---- user-base segmentation (E7) ------------------------------------------------------------------


def userbase_features(userbase: DataFrame, spend_keys: Sequence[str] | None, started_keys: Sequence[str] | None,
                      usa_canada: Sequence[str]) -> DataFrame:
    """Typed, region bucket, text maps to one column per key (given, or found in the data), one-hot
    region/channel.
    (The reference's 100,000-row chunk loop over worker processes becomes this single projection.)"""
    # both maps are parsed once per row; the frame is read for the keys, the levels and the columns
    u = cut_lineage(userbase.withColumns({"_spent": parse_map("map_of_spent"), "_started": parse_map("map_of_started")}))
    spend_keys = map_keys(u, "_spent") if spend_keys is None else spend_keys
    started_keys = map_keys(u, "_started") if started_keys is None else started_keys
    u = u.select(
        "s", "country", "marketing_channel", "veteran", "vip", "club_member",
        (F.col("ltv_7d") / 100).alias("ltv_7d"), F.col("tenure_days").cast("double").alias("tenure_days"),
        F.col("avg_daily_sessions").cast("double").alias("avg_daily_sessions"),
        prep.region_bucket("country", usa_canada).alias("region"),
        *[F.coalesce(F.col("_spent")[k], F.lit(0.0)).alias(f"hc_category_{k}") for k in spend_keys],
        *[F.coalesce(F.col("_started")[k], F.lit(0.0)).alias(f"competition_{k}") for k in started_keys])
    u = rs.one_hot(u, "region", sm.distinct_values(u, "region"), "region_")
    return rs.one_hot(u, "marketing_channel", sm.distinct_values(u, "marketing_channel"), "channel_")


def segment_inputs(userbase: DataFrame, spend_keys: Sequence[str] | None, started_keys: Sequence[str] | None,
                   usa_canada: Sequence[str]):
    """Checkpointed wide user features and their min-max scaled clustering columns (VIP and the
    redundant channel / club / revenue columns are not clustering inputs).
    Returns (features, scaled, used columns, dropped constant columns, spend columns, start columns)."""
    u = userbase_features(userbase, spend_keys, started_keys, usa_canada)
    hc = [c for c in u.columns if c.startswith("hc_category_")]
    comp = [c for c in u.columns if c.startswith("competition_")]
    cluster_cols = ["region_USA_Canada", "tenure_days", "avg_daily_sessions", "veteran", "ltv_7d"] + hc + comp
    cluster_cols = [c for c in cluster_cols if c in u.columns]
    scaled, dropped = sc.min_max_scale(u, cluster_cols, keep=["s", "vip"])
    scaled = right_size(cut_lineage(scaled))
    used = [c for c in cluster_cols if c not in dropped]
    return u, scaled, used, dropped, hc, comp


PROFILE_EXTRA = ["tenure_days", "veteran", "vip", "ltv_7d", "avg_daily_sessions"]


def segment_users(userbase: DataFrame, spend_keys: Sequence[str] | None, started_keys: Sequence[str] | None,
                  usa_canada: Sequence[str], ks: Sequence[int] = tuple(range(3, 13)), chosen_k: int | None = 8,
                  seed: int = 123) -> dict:
    """Shares, means, min-max scaling, PCA, k-means sweep (VIP excluded from the inputs), chosen k,
    cluster profile (and its transpose)."""
    u, scaled, used, dropped, hc, comp = segment_inputs(userbase, spend_keys, started_keys, usa_canada)
    scores, contrib = seg.pca_profile(scaled, used, k=min(4, len(used)), key="s", color="vip")
    wss, models = seg.kmeans_sweep(scaled, used, ks, seed=seed)
    k = chosen_k or seg.elbow([(r["k"], r["wss"]) for r in wss.collect()])
    labelled = seg.assign_clusters(scaled.select("s", *used), used, models[k], "cluster").select("s", "cluster")
    prof_cols = hc + comp + PROFILE_EXTRA
    profile = seg.cluster_profile(u.join(labelled, "s"), "cluster", prof_cols)
    return {"features": u, "shares": sm.share_of_total(u, "vip").unionByName(sm.share_of_total(u, "region")),
            "means": sm.column_means(u, hc + comp), "scaled": scaled, "dropped": dropped,
            "pca_scores": scores, "pca_contributions": contrib, "wss": wss, "k": k, "clusters": labelled,
            "profile": profile, "profile_t": rs.transpose(profile, "cluster", ["n"] + prof_cols)}


def segment_users_sparse(users: DataFrame, key: str, maps: Mapping[str, str], ks: Sequence[int] = tuple(range(3, 13)),
                         chosen_k: int | None = None, components: int = 4, seed: int = 123) -> dict:
    """E7 on maps with any number of keys: ``maps`` names map<string,double> columns of ``users`` (unique ``key``) and the
    prefixes of their keys. Means, scaling, components, clusters and profiles as ``segment_users`` has them, without a
    column per key."""
    frame = cut_lineage(users.select(key, *maps))
    long = None
    for column, prefix in maps.items():
        part = sp.entries(frame, key, column).withColumn("name", F.concat(F.lit(prefix), "name"))
        long = part if long is None else long.unionByName(part)
    long, n = cut_lineage(long), frame.count()
    names = cut_lineage(sp.dictionary(long))
    rows = cut_lineage(sp.indexed(sp.scale_by_largest(long), key, names))
    scores, contrib = sp.pca_profile(rows, key, names, n, components)
    vec = cut_lineage(sp.vectors(rows, key, frame, max(names.count(), 1)))
    wss, models = sp.kmeans(vec, key, ks, seed=seed)
    k = chosen_k or seg.elbow([(r["k"], r["wss"]) for r in wss.collect()])
    labels = models[k].transform(vec).select(key, F.col(models[k].getPredictionCol()).alias("cluster"))
    return {"dictionary": names, "means": sp.means(long, n), "pca_scores": scores, "pca_contributions": contrib, "wss": wss,
            "k": k, "clusters": labels, "profile": sp.profile(long, key, labels)}


# ---- campaign report (E8) -------------------------------------------------------------------------


def campaign_report(daily: DataFrame, revenue_7day: DataFrame, cp: CampaignParams,
                    metrics: Sequence[str] = ("organic_installs", "organic_revenue", "dau"),
                    overlays: Mapping[str, tuple[dt.date, dt.date]] | DataFrame | None = None, local_level: bool = False,
                    ratio: float | str = imp.DEFAULT_LEVEL_RATIO) -> dict:
    """Impact per metric (mean or local-level baseline; ``ratio`` as in ``impact.local_level_forecast``), CPI by period
    and per day, event overlay (of literal intervals or of a table: name, start, end), organic LTV from the attributed
    installs."""
    days = daily.select("date")
    overlay = (iv.label_events_from(days, "date", overlays, "name", "start", "end") if isinstance(overlays, DataFrame)
               else days.withColumn("event_labels", prep.label_events("date", overlays or {})))
    per_day = (imp.impact_local_level(daily, metrics, cp.impact, ratio) if local_level
               else imp.impact_mean(daily, metrics, cp.impact))
    summary = imp.impact_summary(per_day)
    installs = summary.where(F.col("metric") == "organic_installs").select("abs_effect_cum").first()
    attributed = float(installs[0]) if installs else 0.0
    return {
        "impact": per_day, "impact_summary": summary,
        "cpi": sm.cost_per_install(daily, {"pre_period": cp.cpi_pre, "post_period": cp.cpi_post}),
        "daily_cpi": sm.daily_ratio(daily),
        "overlay": overlay,
        "organic_ltv": imp.organic_ltv(revenue_7day, attributed, cp.ltv_multiplier, cp.ads_uplift),
    }
