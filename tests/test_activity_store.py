"""Activity store: re-runs, late rows, corrections, compaction, writers that die; plans without a shuffle of activity."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from cohortlens.operators import features as feat
from cohortlens.params import TEST_FEATURES as P
from cohortlens.sources import activity_store, commits
from cohortlens.sources.testdata import load_world
from conftest import SF_SMALL

D = [dt.date(2024, 1, k) for k in range(1, 9)]


def store(spark, tmp_dir, buckets=8, period="yyyy-MM-dd"):
    return activity_store.ActivityStore(spark, tmp_dir, f"default.act_{uuid.uuid4().hex}", buckets, period).open()


def days(spark, rows):
    return spark.createDataFrame([(s, d, n, None, u, None) for s, d, n, u in rows],
                                 "s string, activity_date date, n long, len decimal(38,6), util double, amt decimal(38,6)")


def held(st, *bounds, **kw):
    got = st.read(*bounds, **kw).groupBy("s", "activity_date").agg(F.sum("n").alias("n"), F.sum("util").alias("u")).collect()
    return {(r["s"], r["activity_date"]): (r["n"], r["u"]) for r in got}


def test_batches_replace_themselves_only(spark, tmp_dir):
    st = store(spark, tmp_dir)
    assert held(st) == {}
    st.put("b1", days(spark, [("x", D[0], 1, 2.0), ("y", D[0], 5, None), (None, D[0], 9, 9.0), ("x", None, 9, 9.0)]))
    st.put("b2", days(spark, [("x", D[1], 3, 1.0), ("x", D[0], 10, 0.5)]))  # the second row is late
    assert held(st) == {("x", D[0]): (11, 2.5), ("y", D[0]): (5, None), ("x", D[1]): (3, 1.0)}
    before = held(st)
    st.put("b2", days(spark, [("x", D[1], 3, 1.0), ("x", D[0], 10, 0.5)]))  # run again
    assert held(st) == before
    st.put("b1", days(spark, [("x", D[0], 2, 2.0), ("z", D[3], 1, None)]))  # corrected: y is gone, z is new
    assert held(st) == {("x", D[0]): (12, 2.5), ("z", D[3]): (1, None), ("x", D[1]): (3, 1.0)}
    assert held(st, D[1], D[2]) == {("x", D[1]): (3, 1.0)}
    assert held(st, version=2) == before and held(st, version=0) == {}
    now = held(st)
    st.compact()
    assert held(st) == now and st.read().count() == 3
    with pytest.raises(ValueError, match="compacted"):
        st.put("b1", days(spark, []))
    st.put("b3", days(spark, [("x", D[0], 1, None)]))
    assert held(st)["x", D[0]] == (13, 2.5)


def test_a_batch_that_dies_is_not_seen(spark, tmp_dir, monkeypatch):
    st = store(spark, tmp_dir)
    st.put("b1", days(spark, [("x", D[0], 1, 2.0)]))
    bad = days(spark, [("x", d, 7, 7.0) for d in D]).withColumn("n", F.when(F.col("activity_date") == F.lit(D[5]), F.raise_error(F.lit("lost"))).otherwise(F.col("n")))
    with pytest.raises(Exception, match="lost"):
        st.put("b1", bad)
    monkeypatch.setattr(commits, "try_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):  # all rows are written, nothing names them
        st.put("b1", days(spark, [("x", D[0], 9, 9.0)]))
    monkeypatch.undo()
    assert held(st) == {("x", D[0]): (1, 2.0)}


def test_another_session_finds_the_store(spark, tmp_dir):
    st = store(spark, tmp_dir)
    st.put("b1", days(spark, [("x", D[0], 1, 2.0)]))
    other = store(spark, tmp_dir)  # a new table name: nothing of it is in the catalog yet
    assert held(other) == {("x", D[0]): (1, 2.0)}
    other.put("b2", days(spark, [("x", D[0], 4, 0.0)]))
    assert held(st.refresh()) == held(other) == {("x", D[0]): (5, 2.0)}


def test_activity_is_not_exchanged(spark, tmp_dir):
    import re
    w = load_world(spark, SF_SMALL)
    st = store(spark, tmp_dir, period="yyyy")
    st.put("all", feat.activity_daily(w, P))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        df = activity_store.features(st, w, P, P.window_start, P.window_end)
        lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
        at = next(i for i, ln in enumerate(lines) if "FileScan parquet" in ln and "act_" in ln)
        depth, up = len(re.match(r"[\s:|+\-*]*", lines[at]).group()), []
        for ln in reversed(lines[:at]):
            d = len(re.match(r"[\s:|+\-*]*", ln).group())
            if d < depth:
                up.append(ln)
                depth = d
        assert any("SortMergeJoin" in ln for ln in up) and any("HashAggregate" in ln for ln in up)
        assert not any("Exchange" in ln for ln in up)
        assert "Bucketed: true" in lines[at] and "SelectedBucketsCount: 8 out of 8" in lines[at]
        assert re.search(r"PartitionFilters: \[[^\]]*load[^\]]*period", lines[at])
        want = sorted(map(repr, feat.training_features(w, P).collect()))
        assert sorted(map(repr, df.collect())) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_min_age_bounds_the_read(spark, tmp_dir):
    w = load_world(spark, SF_SMALL)
    p = P.with_(min_age=0)
    st = store(spark, tmp_dir, period="yyyy")
    st.put("all", feat.activity_daily(w, p))
    got = activity_store.features(st, w, p, P.window_start, P.window_end)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, feat.training_features(w, p).collect()))


def test_buckets_grow_with_the_rows(spark):
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sizes = [activity_store.buckets_for(spark, n) for n in (0, 10**6, 10**8, 10**9)]
    assert sizes[:2] == [8, 8] and sizes[3] == 10 * sizes[2] >= 10 * shuffles
    assert 10**9 / sizes[3] <= activity_store.ROWS_PER_BUCKET
    assert activity_store.buckets_for(spark, 9 * activity_store.ROWS_PER_BUCKET) >= max(9, shuffles)


def test_queries_size_their_store(spark, monkeypatch):
    from cohortlens.plans import queries
    monkeypatch.setattr(activity_store, "ROWS_PER_BUCKET", 1000)
    st = queries._activity_store(spark, "sized", load_world(spark, SF_SMALL))
    assert st.buckets >= 13  # 6,000 lines count twice, 1,500 orders once
    st.put("all", days(spark, [(f"d{k}", D[0], k, None) for k in range(50)]))
    assert sum(r["n"] for r in st.read().collect()) == sum(range(50))


def test_batches_are_cut_from_tables_joined_once(spark, monkeypatch):
    """The five batches of the query read stored tables, not the joins behind them."""
    from cohortlens.plans import queries
    seen, real = [], feat.activity_daily
    monkeypatch.setattr(feat, "activity_daily", lambda tables, *a, **kw: seen.append(tables) or real(tables, *a, **kw))
    queries.incremental_features(spark, SF_SMALL)
    plans = [getattr(t, name)._jdf.queryExecution().optimizedPlan().toString() for t in seen for name in ("sessions", "utility", "revenue")]
    assert len(plans) == 15 and not any("Join" in p or "Aggregate" in p for p in plans)
