"""Sparse maps against the wide form on few keys, and 100,000 keys."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.operators import reshape, scaling, segments, sparse, summarise

KEYS = [f"k{i}" for i in range(9)]


@pytest.fixture(scope="module")
def maps(spark):
    rng = np.random.default_rng(4)
    rows = []
    for u in range(300):
        chosen = [k for k in KEYS if rng.random() < (0.9 if k == "k0" else 0.3)]
        rows.append((f"u{u}", {k: float(rng.gamma(1.0 + KEYS.index(k))) for k in chosen} | ({"k1": 0.0} if u % 50 == 0 else {})))
    rows += [("none", {}), ("null", None), ("zero", {"k2": 0.0})]
    return spark.createDataFrame(rows, "s string, m map<string,double>").repartition(4).cache()


def wide(maps):
    return maps.select("s", *[F.coalesce(F.col("m")[k], F.lit(0.0)).alias(k) for k in KEYS])


def test_dictionary(spark, maps):
    d = {r["name"]: r["idx"] for r in sparse.dictionary(sparse.entries(maps, "s", "m")).collect()}
    assert d == {k: i for i, k in enumerate(sorted(KEYS))}
    many = spark.range(1000).select(F.concat(F.lit("n"), F.lpad(F.col("id").cast("string"), 4, "0")).alias("name"))
    assert [r["idx"] for r in sparse.dictionary(many.union(many)).orderBy("name").collect()] == list(range(1000))
    assert sparse.dictionary(many.limit(0)).count() == 0


def test_means_profile_and_scaling_equal_the_wide_form(maps):
    long, w = sparse.entries(maps, "s", "m"), wide(maps)
    n = maps.count()
    got = {r["name"]: r["mean"] for r in sparse.means(long, n).collect()}
    want = w.agg(*[F.avg(k).alias(k) for k in KEYS]).first()
    assert got == pytest.approx(want.asDict())
    labels = w.select("s", (F.crc32("s") % 3).cast("int").alias("cluster"))
    prof = {(r["cluster"], r["name"]): r["mean"] for r in sparse.profile(long, "s", labels).collect()}
    for r in segments.cluster_profile(w.join(labels, "s"), "cluster", KEYS, digits=12).collect():
        assert [prof.get((r["cluster"], k), 0.0) for k in KEYS] == pytest.approx([r[k] for k in KEYS])
    scaled, dropped = scaling.min_max_scale(w, KEYS, keep=["s"])
    assert dropped == []
    want = {(r["s"], k): r[k] for r in scaled.collect() for k in KEYS if r[k]}
    assert {(r["s"], r["name"]): r["value"] for r in sparse.scale_by_largest(long).collect()} == pytest.approx(want)
    with pytest.raises(Exception, match="negative"):
        sparse.scale_by_largest(long.withColumn("value", -F.col("value"))).collect()


def vectors(maps):
    long = sparse.entries(maps, "s", "m")
    d = sparse.dictionary(long)
    return sparse.indexed(long, "s", d), d


def test_vectors_and_kmeans_equal_the_wide_form(maps):
    rows, _ = vectors(maps)
    vec = sparse.vectors(rows, "s", maps, len(KEYS))
    want = {r["s"]: [r[k] for k in sorted(KEYS)] for r in wide(maps).collect()}
    got = {r["s"]: r["features"] for r in vec.collect()}
    assert all(type(v).__name__ == "SparseVector" for v in got.values())
    assert {s: v.toArray().tolist() for s, v in got.items()} == want
    wss, models = sparse.kmeans(vec, "s", [2, 3, 4])
    for r in wss.collect():  # the cost is that of the nearest centres
        centres = np.array(models[r["k"]].clusterCenters())
        cost = sum(min(((np.array(v) - c) ** 2).sum() for c in centres) for v in want.values())
        assert r["wss"] == pytest.approx(cost, rel=0.2)


def test_components_equal_the_wide_form(maps):
    rows, d = vectors(maps)
    n = maps.count()
    scores, contrib = sparse.pca_profile(rows, "s", d, n, k=3, rounds=60)
    x = np.array([[r[k] for k in sorted(KEYS)] for r in wide(maps).orderBy("s").collect()])
    names = sorted(r["s"] for r in maps.collect())
    w, v = np.linalg.eigh(np.cov(x.T))
    v, w = v[:, ::-1], w[::-1]
    table = {(r["component"], r["variable"]): r for r in contrib.collect()}
    for c in range(3):
        assert table[c + 1, "k0"]["explained_variance"] == pytest.approx(w[c] / w.sum(), rel=1e-6)
        assert [table[c + 1, k]["contribution"] for k in sorted(KEYS)] == pytest.approx((100 * v[:, c] ** 2).tolist(), abs=1e-3)
    got = {r["s"]: np.array([r["pc1"], r["pc2"], r["pc3"]]) for r in scores.collect()}
    for s, centred in zip(names, x - x.mean(axis=0)):
        assert np.allclose(np.abs(got[s if s in got else None]), np.abs(centred @ v[:, :3]), atol=1e-3)
    spark_scores, _ = segments.pca_profile(wide(maps).withColumn("vip", F.lit(1)), KEYS, k=1)
    assert {r["s"]: abs(r["pc1"]) for r in spark_scores.collect()}["u5"] == pytest.approx(abs(got["u5"][0]), abs=1e-3)


def test_a_hundred_thousand_keys(spark):
    users = spark.range(5000).select(F.concat(F.lit("u"), "id").alias("s"), "id")
    entry = F.transform(F.sequence(F.lit(0), F.lit(39)), lambda j: F.struct(
        F.concat(F.lit("key"), F.pmod(F.xxhash64("id", j), F.lit(100_000))).alias("name"), (F.pmod(F.xxhash64(j, "id"), F.lit(100)) + 1).cast("double").alias("value")))
    long = users.select("s", F.explode(entry).alias("e")).select("s", "e.name", "e.value")
    group = F.struct(F.concat(F.lit("common"), F.col("id") % 2).alias("name"), F.lit(1000.0).alias("value"))
    long = long.union(users.select("s", group.alias("e")).select("s", "e.name", "e.value"))
    d = sparse.dictionary(long)
    size = d.count()
    assert size > 80_000
    rows = sparse.indexed(long, "s", d)
    vec = sparse.vectors(rows, "s", users, size)
    wss, models = sparse.kmeans(vec, "s", [2])
    labels = models[2].transform(vec).select("s", F.col("prediction").alias("cluster"))
    prof = {(r["cluster"], r["name"]): r["mean"] for r in sparse.profile(long, "s", labels).where("name like 'common%'").collect()}
    assert sorted(prof.values()) == [1000.0, 1000.0] and len({c for c, _ in prof}) == 2
    scores, contrib = sparse.pca_profile(rows, "s", d, 5000, k=1, rounds=4)
    top = contrib.orderBy(F.desc("contribution")).limit(2).collect()
    assert {r["variable"] for r in top} == {"common0", "common1"} and sum(r["contribution"] for r in top) > 99


def test_wide_forms_refuse_too_many_columns(spark):
    df = spark.range(200).select(F.col("id").alias("s"), F.concat(F.lit("c"), "id").alias("c"), F.lit(1.0).alias("v"))
    with pytest.raises(ValueError, match="more than 150"):
        summarise.distinct_values(df, "c", limit=150)
    assert len(summarise.distinct_values(df, "c")) == 200


def test_reshape_clashes(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "a", 2.0), (2, "b", 4.0)], "p int, c string, v double")
    with pytest.raises(Exception, match="more than one"):
        reshape.pivot_long(df, "p", "c", "v").collect()
    levels = spark.createDataFrame([("missing",), (None,), ("x",), ("MISSING_",)], "c string")
    out = reshape.one_hot(levels, "c", summarise.distinct_values(levels, "c"))
    assert len(set(c.lower() for c in out.columns)) == 5
    assert sorted(tuple(r)[1:] for r in out.collect()) == sorted([(1, 0, 0, 0), (0, 1, 0, 0), (0, 0, 1, 0), (0, 0, 0, 1)])


def test_segmentation_job(spark, maps):
    from cohortlens.plans import jobs
    out = jobs.segment_users_sparse(maps.withColumn("b", F.col("m")), "s", {"m": "x_", "b": "y_"}, ks=(2, 3, 4), components=2)
    assert out["dictionary"].count() == 2 * len(KEYS)
    assert out["clusters"].select("s").distinct().count() == maps.count()
    assert {r["component"] for r in out["pca_contributions"].collect()} == {1, 2}
    m = {r["name"]: r["mean"] for r in out["means"].collect()}
    assert all(m[f"x_{k}"] == m[f"y_{k}"] for k in KEYS)


def test_profile_query_reads_stored_maps(spark):
    from cohortlens.plans.queries import QUERIES
    from conftest import SF_SMALL
    plan = QUERIES["sparse_profile"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan and "map_of_spent" not in plan


def test_text_maps_of_many_keys_and_repeats(spark):
    from cohortlens.functions.maps import parse_map
    n = 20_000
    many = ", ".join(f"k{k}={k}" for k in range(n))
    texts = [("a", "{" + many + "}"), ("b", "{" + many + ", " + many.replace("=", "=1") + "}"),
             ("c", "{x=1, y=2, x=, z=3, y=4}"), ("d", "{}"), ("e", None), ("f", "{=1, q, =2}")]
    rows = spark.createDataFrame(texts, "s string, t string").withColumn("m", parse_map("t")).withColumn("k", F.map_keys("m")).collect()
    got = {r["s"]: dict(zip(r["k"], (r["m"][k] for k in r["k"]))) for r in rows}
    assert got["a"] == {f"k{k}": float(k) for k in range(n)}
    assert got["b"] == {f"k{k}": float(f"1{k}") for k in range(n)}
    assert list(got["c"].items()) == [("x", None), ("z", 3.0), ("y", 4.0)]
    assert got["d"] == got["e"] == {} and got["f"] == {"q": None, "": 2.0}
