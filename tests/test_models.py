"""Model operators: hurdle rule (X8), rank deficiency (X14), numpy cross-checks (M11 M12 M15 M17),
impact (X15, local level vs numpy), best setting ties (X16), clustering properties."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.operators import hurdle as hd
from cohortlens.operators import impact as imp
from cohortlens.operators import linear as lin
from cohortlens.operators import segments as seg
from cohortlens.params import ImpactWindows


def test_x8_hurdle_rule_grid(spark):
    rows = [(1.0, 0.05, 10.0), (0.0, 0.2, 10.0), (0.0, 0.3, 10.0), (0.0, 0.1, -5.0), (0.0, 0.6, -5.0)]
    df = spark.createDataFrame(rows, "observed double, p double, amount double")
    o, p, a = F.col("observed"), F.col("p"), F.col("amount")
    out = df.select(hd.hurdle_prediction(o, p, a, 0.2).alias("h"), hd.product_prediction(o, p, a).alias("prod"),
                    hd.threshold_prediction(p, a).alias("thr")).collect()
    assert [r["h"] for r in out] == [10.0, 2.0, 10.0, -0.5, -5.0]  # p == hurdle is not above it
    assert [r["prod"] for r in out] == [10.0, 2.0, 3.0, -0.5, -3.0]
    assert [r["thr"] for r in out] == [0.0, 0.0, 0.0, 0.0, 0.0]
    for r, (ob, pp, am) in zip(out, rows):  # hurdle output is either the amount or p x amount
        assert r["h"] in (am, pp * am)


def test_x16_best_setting_ties(spark):
    s = spark.createDataFrame([(50, 0.1, 20, 1.0), (25, 0.1, 30, 1.0), (25, 0.05, 10, 2.0)],
                              "nrounds int, eta double, hurdle_pct int, rmse double")
    best = hd.best_setting(s).collect()
    assert len(best) == 1 and (best[0]["nrounds"], best[0]["hurdle_pct"]) == (25, 30)


def _linear_data(spark, n=200, seed=0):
    rng = np.random.default_rng(seed)
    x1 = rng.normal(size=n)
    x2 = rng.normal(size=n)
    y = np.exp(1.0 + 0.5 * x1 - 0.25 * x2 + rng.normal(scale=0.1, size=n))
    rows = [(int(i), float(a), float(b), float(2 * a), 1.0, float(c)) for i, (a, b, c) in enumerate(zip(x1, x2, y))]
    return spark.createDataFrame(rows, "id long, x1 double, x2 double, x1_twice double, const double, y double"), x1, x2, y


def test_x14_aliased_columns_dropped_in_order(spark):
    df, *_ = _linear_data(spark)
    assert lin.aliased_columns(df, ["x1", "x2", "x1_twice", "const"]) == ["x1_twice", "const"]
    fit = lin.fit_linear(df, ["x1", "x2", "x1_twice", "const"], "y", log_label=True)
    assert fit.features == ["x1", "x2"] and fit.dropped == ["x1_twice", "const"]


def test_linear_matches_numpy(spark):
    df, x1, x2, y = _linear_data(spark)
    fit = lin.fit_linear(df, ["x1", "x2"], "y", log_label=True)
    X = np.column_stack([x1, x2, np.ones_like(x1)])
    ly = np.log(y)
    beta, *_ = np.linalg.lstsq(X, ly, rcond=None)
    assert np.allclose(list(fit.coef) + [fit.intercept], beta, atol=1e-8)
    resid = ly - X @ beta
    n, p = X.shape
    sigma2 = resid @ resid / (n - p)
    se = np.sqrt(np.diag(sigma2 * np.linalg.inv(X.T @ X)))
    coef = {r["term"]: r for r in fit.coefficients(spark).collect()}
    assert math.isclose(coef["x1"]["std_error"], se[0], rel_tol=1e-6)
    assert math.isclose(coef["x1"]["transformed_estimate"], (math.exp(beta[0]) - 1) * 100, rel_tol=1e-9)
    # R's lm AIC: n log(2 pi RSS/n) + n + 2 (p + 1)
    rss = resid @ resid
    aic = n * math.log(2 * math.pi * rss / n) + n + 2 * (p + 1)
    row = fit.summary_row("m")
    assert math.isclose(row[4], aic, rel_tol=1e-9)
    r2 = 1 - rss / np.sum((ly - ly.mean()) ** 2)
    assert math.isclose(row[2], r2, rel_tol=1e-9)
    assert math.isclose(row[3], 1 - (1 - r2) * (n - 1) / (n - p), rel_tol=1e-9)
    eff = fit.effect_size("x1", 0, 1)
    assert math.isclose(eff["pct_change"], (math.exp(beta[0]) - 1) * 100, rel_tol=1e-9)


def test_vif_matches_numpy(spark):
    df, x1, x2, _ = _linear_data(spark)
    got = {r["variable"]: r["vif"] for r in lin.vif(df, ["x1", "x2"]).collect()}
    c = np.corrcoef(np.vstack([x1, x2]))
    want = np.diag(np.linalg.inv(c))
    assert math.isclose(got["x1"], want[0], rel_tol=1e-9) and math.isclose(got["x2"], want[1], rel_tol=1e-9)


def _daily(spark, values):
    start = dt.date(2024, 1, 1)
    rows = [(start + dt.timedelta(i), float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "date date, m double")


W = ImpactWindows((dt.date(2024, 1, 1), dt.date(2024, 1, 10)), (dt.date(2024, 1, 11), dt.date(2024, 1, 20)))


def test_x15_flat_and_step_series(spark):
    flat = imp.impact_summary(imp.impact_mean(_daily(spark, [5] * 20), ["m"], W)).first()
    assert flat["abs_effect_cum"] == 0.0
    step = imp.impact_summary(imp.impact_mean(_daily(spark, [5] * 10 + [8] * 10), ["m"], W)).first()
    assert step["abs_effect_cum"] == 30.0 and step["rel_effect"] == 0.6
    per_day = imp.impact_mean(_daily(spark, [5] * 10 + [8] * 10), ["m"], W).orderBy("date").collect()
    assert [r["cumulative_effect"] for r in per_day] == [3.0 * k for k in range(1, 11)]
    missing = imp.impact_mean(_daily(spark, [5] * 10 + [8] * 10).where(F.col("date") != dt.date(2024, 1, 15)), ["m"], W)
    assert missing.count() == 9


def test_local_level_numpy(spark):
    rng = np.random.default_rng(1)
    pre = 10 + rng.normal(scale=0.5, size=12)
    mean, sd, sd_cum = imp.local_level_forecast(pre, 5)
    assert np.allclose(mean, mean[0]) and abs(mean[0] - pre[-6:].mean()) < 1.5
    assert np.all(np.diff(sd) >= 0) and np.all(np.diff(sd_cum) > 0) and np.isclose(sd_cum[0], sd[0])
    vals = list(pre) + [12.0] * 8
    start = dt.date(2024, 1, 1)
    w = ImpactWindows((start, start + dt.timedelta(11)), (start + dt.timedelta(12), start + dt.timedelta(19)))
    out = imp.impact_local_level(_daily(spark, vals), ["m"], w).orderBy("date").collect()
    m8, _, _ = imp.local_level_forecast(pre, 8)
    assert len(out) == 8 and np.allclose([r["predicted"] for r in out], m8)
    assert math.isclose(out[-1]["cumulative_effect"], float(np.sum(12.0 - m8)), rel_tol=1e-6)


def test_local_level_starts_with_the_post_period_and_counts_missing_days(spark):
    rng = np.random.default_rng(4)
    pre = list(10 + rng.normal(scale=0.5, size=10))
    start = dt.date(2024, 1, 1)
    df = _daily(spark, pre + [99.0] * 5 + [12.0] * 5).where(F.col("date") != start + dt.timedelta(4))
    w = ImpactWindows((start, start + dt.timedelta(9)), (start + dt.timedelta(15), start + dt.timedelta(19)))
    out = imp.impact_local_level(df, ["m"], w).orderBy("date").collect()
    assert [r["date"] for r in out] == [start + dt.timedelta(k) for k in range(15, 20)]  # not the days in between
    pre[4] = np.nan
    mean, sd, cum = imp.local_level_forecast(np.array(pre), np.arange(6, 11))
    assert np.allclose([r["predicted"] for r in out], mean) and np.allclose([r["cumulative_sd"] for r in out], cum)
    # the running sum's variance, from the covariance of the days: p + ratio * min(h_i, h_j), plus noise
    z = (np.array(pre) - np.nanmean(pre)) / np.nanstd(pre)
    _, p, vs, fs = imp._filter(z, imp.DEFAULT_LEVEL_RATIO)
    h = np.arange(6, 11)
    cov = p + imp.DEFAULT_LEVEL_RATIO * np.minimum.outer(h, h) + np.eye(5)
    scale = np.nanstd(pre) * math.sqrt(np.mean(vs * vs / fs))
    assert np.allclose(cum, [scale * math.sqrt(cov[:n, :n].sum()) for n in range(1, 6)])


def test_large_means_are_not_collinear(spark):
    rng = np.random.default_rng(3)
    x1, x2 = 100_000 + rng.normal(size=400), rng.normal(size=400)
    df = spark.createDataFrame([(float(a), float(b), float(a - 3 * b), 7.0) for a, b in zip(x1, x2)], "x1 double, x2 double, mix double, c double")
    assert lin.aliased_columns(df, ["x1", "x2", "mix", "c"]) == ["mix", "c"]


def test_kmeans_and_pca_properties(spark):
    rng = np.random.default_rng(2)
    pts = np.vstack([rng.normal(loc=c, scale=0.1, size=(50, 3)) for c in (0, 3, 6)])
    df = spark.createDataFrame([(f"u{i}", 0, *map(float, p)) for i, p in enumerate(pts)], "s string, vip int, a double, b double, c double")
    wss, models = seg.kmeans_sweep(df, ["a", "b", "c"], ks=(2, 3, 4, 5), seed=1)
    w = {r["k"]: r["wss"] for r in wss.collect()}
    assert w[3] < w[2] * 0.2 and w[4] <= w[3] * 1.05
    assert seg.elbow(sorted(w.items())) == 3
    lab = seg.assign_clusters(df, ["a", "b", "c"], models[3], "cluster")
    assert lab.select("s").distinct().count() == 150 and lab.select("cluster").distinct().count() == 3
    _scores, contrib = seg.pca_profile(df, ["a", "b", "c"], k=2)
    for comp in (1, 2):
        tot = sum(r["contribution"] for r in contrib.where(F.col("component") == comp).collect())
        assert math.isclose(tot, 100.0, rel_tol=1e-9)


@pytest.mark.slow
def test_hurdle_model_beats_mean_and_round_trips(spark, tmp_dir):
    from conftest import SF_MID
    from cohortlens.params import TEST_FEATURES, HurdleParams
    from cohortlens.plans import jobs
    from cohortlens.sources import registry
    from cohortlens.sources.testdata import load_world

    w = load_world(spark, SF_MID)
    hp = HurdleParams(nrounds=(10,), etas=(0.1,), hurdles=(0.2,), folds=2)
    frame = jobs.revenue_model_frame(w, TEST_FEATURES, hp)
    train, test = frame.where("split = 'train'"), frame.where("split = 'test'")
    spec = jobs.base_spec(TEST_FEATURES, hp)
    model, hold = hd.fit_final(train, test, spec)
    label = spec.label
    mean = train.agg(F.avg(label)).first()[0]
    in_sample = hd.error_metrics(model.transform(train), label, "prediction", [], digits=None).first()["rmse"]
    base = train.agg(F.sqrt(F.avg((F.col(label) - F.lit(mean)) ** 2))).first()[0]
    assert in_sample < base  # the fit explains training variance
    h = hold.first()
    assert math.isfinite(h["rmse"]) and math.isfinite(h["mae"]) and h["n"] == test.count()
    root = tmp_dir + "/models"
    registry.save_model(spark, model, root, "shop", 90, 365)
    last = registry.save_model(spark, model, root, "shop", 90, 365)
    assert registry.latest_model_path(spark, root, "shop", 90, 365) == last
    assert [r["version"] for r in registry.list_models(spark, root, "shop").orderBy("version").collect()] == [1, 2]
    again = registry.load_latest_model(spark, root, "shop", 90, 365)
    a = model.transform(test).select("s", "prediction").collect()
    b = again.transform(test).select("s", "prediction").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_tree_prefix_equals_smaller_fit(spark):
    from cohortlens.operators.hurdle import HurdleRegressor, HurdleSpec
    rng = np.random.default_rng(4)
    rows = []
    for i in range(300):
        a, b = float(rng.uniform(0, 10)), float(rng.uniform(0, 5))
        y = 2 * a + b * b + float(rng.normal())
        rows.append((f"k{i}", a, b, y, float(a > 5) * y, y > 20))
    df = spark.createDataFrame(rows, "s string, a double, b double, y double, obs double, spender boolean")
    spec = HurdleSpec(["a", "b"], ["a", "b", "obs"], label="y", observed="obs", nrounds=8, eta=0.2, max_depth=3)
    big = HurdleRegressor(spec).fit(df)
    small = HurdleRegressor(HurdleSpec(**{**spec.__dict__, "nrounds": 3})).fit(df)
    pre = big.prefix_scores(df, [3, 8]).select("s", "p_spender_3", "amount_3", "amount_8")
    ref = small.raw(df).select("s", "p_spender", "amount")
    j = pre.join(ref, "s").collect()
    assert max(abs(r["p_spender_3"] - r["p_spender"]) for r in j) < 1e-12
    assert max(abs(r["amount_3"] - r["amount"]) for r in j) < 1e-9
    full = big.raw(df).select("s", F.col("amount").alias("a8")).join(pre, "s").collect()
    assert max(abs(r["a8"] - r["amount_8"]) for r in full) < 1e-9


def test_hurdle_in_pipeline(spark):
    from pyspark.ml import Pipeline
    from cohortlens.operators.hurdle import HurdleRegressor, HurdleSpec
    rows = [(f"k{i}", float(i % 7), float(i % 5), float(i % 11) * 3.0, float(i % 3), i % 4 > 0) for i in range(120)]
    df = spark.createDataFrame(rows, "s string, a double, b double, y double, obs double, spender boolean")
    spec = HurdleSpec(["a", "b"], ["a", "b", "obs"], label="y", observed="obs", nrounds=3, eta=0.3, max_depth=2)
    pm = Pipeline(stages=[HurdleRegressor(spec)]).fit(df)
    out = pm.transform(df)
    assert {"p_spender", "amount", "prediction"} <= set(out.columns) and out.count() == 120


def test_effect_size_derived(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(300):
        x, z = float(rng.uniform(0, 4)), float(rng.integers(0, 2))
        y = math.exp(0.2 * x + 0.05 * x * x + 0.3 * x * z + float(rng.normal(scale=0.01)))
        rows.append((x, x * x, z, x * z, y))
    df = spark.createDataFrame(rows, "x double, xSqd double, z double, x_z double, y double")
    fit = lin.fit_linear(df, ["x", "xSqd", "z", "x_z"], "y", log_label=True)
    plain = fit.effect_size("x", 1, 2)
    at = lin.typical_values(df, ["z"])
    full = fit.effect_size("x", 1, 2, derived=True, squares={"x": "xSqd"}, interactions={"x_z": ("x", "z")}, at=at)
    b = dict(zip(fit.features, fit.coef))
    assert math.isclose(plain["slope"], b["x"], rel_tol=1e-12)
    want = b["x"] + b["xSqd"] * 3 + b["x_z"] * at["z"]
    assert math.isclose(full["slope"], want, rel_tol=1e-12)
    assert abs(full["slope"] - (0.2 + 0.05 * 3 + 0.3 * at["z"])) < 0.02


def test_smearing_factor(spark):
    rng = np.random.default_rng(6)
    x = rng.uniform(0, 1, 4000)
    y = np.exp(1.0 + 2.0 * x + rng.normal(scale=0.5, size=4000))
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    fit = lin.fit_linear(df, ["x"], "y", log_label=True)
    f = fit.smearing_factor(df)
    assert abs(f - math.exp(0.5 ** 2 / 2)) < 0.03
    plain = fit.predict(df, "p").agg(F.avg("p")).first()[0]
    smeared = fit.predict(df, "p", smearing=f).agg(F.avg("p")).first()[0]
    assert abs(smeared - float(np.mean(y))) < abs(plain - float(np.mean(y)))


def test_impact_intervals(spark):
    rng = np.random.default_rng(8)
    vals = list(10 + rng.normal(scale=1.0, size=10)) + list(20 + rng.normal(scale=1.0, size=10))
    for per_day in (imp.impact_mean(_daily(spark, vals), ["m"], W), imp.impact_local_level(_daily(spark, vals), ["m"], W)):
        rows = per_day.orderBy("date").collect()
        sds = [r["cumulative_sd"] for r in rows]
        assert all(b > a for a, b in zip(sds, sds[1:]))  # uncertainty of the sum grows with the horizon
        s = imp.impact_summary(per_day).first()
        assert s["abs_effect_cum_lower"] < s["abs_effect_cum"] < s["abs_effect_cum_upper"] and s["z"] > 5


def test_local_level_ratio_mle():
    rng = np.random.default_rng(9)
    walk = np.cumsum(rng.normal(scale=1.0, size=60)) + rng.normal(scale=0.1, size=60)  # level moves a lot
    flat = 5 + rng.normal(scale=1.0, size=60)  # level does not move
    zw = (walk - walk.mean()) / walk.std()
    zf = (flat - flat.mean()) / flat.std()
    best_w = max(imp.RATIO_GRID, key=lambda r: imp.concentrated_loglik(zw, r))
    best_f = max(imp.RATIO_GRID, key=lambda r: imp.concentrated_loglik(zf, r))
    assert best_w >= 1.0 and best_f <= 1e-2
    mean, sd, _ = imp.local_level_forecast(walk, 3, ratio="mle")
    assert abs(mean[0] - walk[-1]) < abs(mean[0] - walk.mean())  # follows the last level


@pytest.mark.slow
def test_hurdle_beats_mean_on_holdout_sf01(spark):
    """SURVEY §7.2 step 8 at sf0.1 (428 hold-out devices; at sf0.01 the 46-row hold-out is too small)."""
    from dataclasses import replace
    from cohortlens.params import TEST_FEATURES, HurdleParams
    from cohortlens.plans import jobs
    from cohortlens.sources.testdata import load_world
    w = load_world(spark, "/root/testdata/sf0.1")
    frame = jobs.revenue_model_frame(w, TEST_FEATURES, HurdleParams())
    train, test = frame.where("split = 'train'"), frame.where("split = 'test'")
    spec = replace(jobs.base_spec(TEST_FEATURES, HurdleParams()), nrounds=25, eta=0.05, hurdle=0.2)
    _model, hold = hd.fit_final(train, test, spec)
    mean = train.agg(F.avg(spec.label)).first()[0]
    base = test.agg(F.sqrt(F.avg((F.col(spec.label) - F.lit(mean)) ** 2))).first()[0]
    assert hold.first()["rmse"] < 0.9 * base


def test_gram_by_fold_matches_direct(spark):
    df, *_ = _linear_data(spark, n=120)
    df = df.withColumn("fold", (F.col("id") % 3).cast("int"))
    cols = ["x1", "x2", "x1_twice", "const"]
    m = lin.moments(df, cols, group="fold")
    for f in range(3):
        want = lin.aliased_columns(df.where(F.col("fold") != f), cols)
        assert lin.aliased_from_triangle(m.without(f), cols, m.means) == want
    specs = {"a": ["x1", "x2", "x1_twice"], "b": ["x1"]}
    per_fold, summary = lin.linear_cv(df, specs, "y", True, 3)
    assert {r["model"] for r in summary.collect()} == {"a", "b"}
    for r in per_fold.collect():  # the same as fitting and scoring the split
        fit = lin.fit_linear(df.where(F.col("fold") != r["fold"]), specs[r["model"]], "y", True)
        err = F.log("y") - F.col("p")
        want = fit.predict(df.where(F.col("fold") == r["fold"]), "p", back_transform=False).agg(F.sqrt(F.avg(err * err))).first()[0]
        assert math.isclose(r["rmse"], want, rel_tol=1e-9)


def test_t_distribution():
    for t, df, p in ((0.0, 5, 1.0), (2.0, 10, 0.07338803), (12.706204736, 1, 0.05), (1.959963985, 10**7, 0.05), (-3.0, 30, 0.005389)):
        assert math.isclose(lin.t_two_sided(t, df), p, rel_tol=2e-4)
    assert lin.t_two_sided(50.0, 100) < 1e-60


def test_nulls_are_an_error_in_a_fit(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 1.0), (3.0, 1.0)], "x double, y double")
    with pytest.raises(ValueError):
        lin.fit_linear(df, ["x"], "y")


def test_m0_assemble_rejects_nulls(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 1.0)], "a double, b double")
    out = seg.assemble(df, ["a", "b"])
    with pytest.raises(Exception):
        out.collect()
    assert seg.assemble(df.fillna(0.0), ["a", "b"]).count() == 2


def _hilbert_like(n=600, seed=7):
    """Columns that agree in all but the last five or six digits, and a response with known coefficients."""
    rng = np.random.default_rng(seed)
    base = rng.normal(size=n)
    x = np.column_stack([base, base + 2e-6 * rng.normal(size=n), base + 3e-6 * rng.normal(size=n), rng.normal(size=n)])
    return x, x @ np.array([1.0, -2.0, 3.0, 0.5]) + 10.0 + 1e-9 * rng.normal(size=n)


def test_ill_conditioned_fit_keeps_its_digits(spark):
    x, y = _hilbert_like()
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], "a double, b double, c double, d double, y double").repartition(7)
    fit = lin.fit_linear(df, ["a", "b", "c", "d"], "y")
    assert fit.dropped == []
    full = np.column_stack([np.ones(len(y)), x])
    want = np.linalg.lstsq(full, y, rcond=None)[0]
    assert np.allclose([fit.intercept, *fit.coef], want, rtol=1e-6)
    # the cross products of the same (centred) columns lose these digits
    centred = np.column_stack([np.ones(len(y)), x - x.mean(axis=0)])
    by_products = np.linalg.solve(centred.T @ centred, centred.T @ y)[1:]
    assert np.max(np.abs(by_products - want[1:])) > 100 * np.max(np.abs(fit.coef - want[1:]))
    resid = y - full @ want
    assert math.isclose(fit.rss, resid @ resid, rel_tol=1e-5)


def test_tolerance_of_collinear_columns(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=300)
    rows = [(float(b), float(b + 1e-9 * e), float(b + 1e-4 * e)) for b, e in zip(base, rng.normal(size=300))]
    df = spark.createDataFrame(rows, "a double, same double, near double")
    assert lin.aliased_columns(df, ["a", "same", "near"]) == ["same"]


def test_triangles_do_not_depend_on_partitions(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 3))
    df = spark.createDataFrame([(i % 3, *map(float, r)) for i, r in enumerate(x)], "_g long, p double, q double, r double")
    whole = {g: np.linalg.qr(np.column_stack([np.ones(sum(np.arange(500) % 3 == g)), x[np.arange(500) % 3 == g]]), mode="r") for g in range(3)}
    for parts in (1, 5, 40):
        got = lin.triangles(df.repartition(parts))
        assert set(got) == {0, 1, 2}
        for g, r in got.items():
            assert np.allclose(r, np.abs(np.sign(np.diag(whole[g])))[:, None] * np.sign(np.diag(whole[g]))[:, None] * whole[g])
    assert lin.triangles(df.where("p > 100")) == {}


def _walk(rng, n, level, noise):
    return np.cumsum(rng.normal(scale=math.sqrt(level), size=n)) + rng.normal(scale=math.sqrt(noise), size=n)


def test_em_reaches_the_greatest_likelihood_and_known_variances():
    rng = np.random.default_rng(3)
    z = _walk(rng, 3000, 0.3, 1.5)
    z[100:140] = np.nan
    level, noise = imp.learn_variances(z)
    assert abs(level - 0.3) < 0.06 and abs(noise - 1.5) < 0.12
    for n in (25, 60):
        z = _walk(rng, n, 0.5, 1.0)
        level, noise = imp.learn_variances(z, rounds=20_000, tol=1e-13)
        best = max(imp.diffuse_loglik(z, a, b) for a in np.geomspace(1e-3, 5, 60) for b in np.geomspace(1e-2, 5, 60))
        assert imp.diffuse_loglik(z, level, noise) >= best - 2e-3


def test_smoother_is_the_conditional_normal():
    """Against the joint normal distribution of all levels and observations, with a very wide first level."""
    z, level, noise = np.array([1.0, np.nan, 4.0, 2.0, np.nan, 3.0]), 0.7, 0.4
    n = len(z)
    cov = 1e4 + level * np.minimum.outer(np.arange(n), np.arange(n))
    seen = ~np.isnan(z)
    gain = cov[:, seen] @ np.linalg.inv(cov[np.ix_(seen, seen)] + noise * np.eye(seen.sum()))
    want, var = gain @ z[seen], cov - gain @ cov[seen]
    m, v, c = imp.smooth(z, level, noise)
    assert np.allclose(m, want, atol=1e-3) and np.allclose(v, np.diag(var), atol=1e-3) and np.allclose(c, np.diag(var, 1), atol=1e-3)


def test_em_band_covers():
    rng = np.random.default_rng(8)
    hits, runs, steps = 0, 120, 10
    for _ in range(runs):
        z = _walk(rng, 100 + steps, 0.05, 1.0)
        mean, _sd, cum = imp.local_level_forecast(z[:100], steps, "em")
        hits += abs(np.sum(z[100:] - mean)) <= 1.96 * cum[-1]
    assert 0.89 <= hits / runs <= 0.99, hits / runs
    for flat in ([5.0] * 10, [1.0, 2.0], [3.0]):
        mean, sd, cum = imp.local_level_forecast(np.array(flat), 3, "em")
        assert np.all(np.isfinite(mean)) and np.all(cum >= 0)


def test_em_in_the_report(spark):
    vals = [10 + (k % 3) for k in range(10)] + [20.0] * 10
    out = imp.impact_local_level(_daily(spark, vals), ["m"], W, ratio="em").orderBy("date").collect()
    mean, _sd, cum = imp.local_level_forecast(np.array(vals[:10]), 10, "em")
    assert len(out) == 10 and math.isclose(out[-1]["cumulative_effect"], 200 - 10 * mean[0], abs_tol=1e-5)
    assert math.isclose(out[-1]["cumulative_sd"], cum[-1], abs_tol=1e-5)
