"""Plan-shape tests: one scan per activity table for all horizons, the derived date
bound reaches the parquet reader, no Python UDF in the feature plan."""

import os
import re
from types import SimpleNamespace

import pytest

from cohortlens.operators import features as feat
from cohortlens.params import TEST_FEATURES
from cohortlens.sources.testdata import load_world
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    """The five input tables materialised as parquet, as they would be in a warehouse."""
    root = str(tmp_path_factory.mktemp("wh"))
    w = load_world(spark, SF_SMALL)
    out = {}
    for name in ("installs", "touches", "sessions", "utility", "revenue"):
        path = os.path.join(root, name)
        getattr(w, name).write.parquet(path)
        out[name] = spark.read.parquet(path)
    return SimpleNamespace(root=root, **out)


def _plan(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "100000")
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_scan_per_activity_table(warehouse):
    df = feat.training_features(warehouse, TEST_FEATURES)
    plan = _plan(df)
    for name in ("sessions", "utility", "revenue"):
        scans = re.findall(r"FileScan parquet [^\n]*" + re.escape(os.path.join(warehouse.root, name)) + r"\]", plan)
        locs = [m for m in re.findall(r"Location: InMemoryFileIndex\(1 paths\)\[file:([^\]]+)\]", plan)
                if m.rstrip("/").endswith("/" + name)]
        assert len(locs) == 1, (name, len(locs), scans)


def test_date_bound_pushed_to_scan(warehouse):
    plan = _plan(feat.training_features(warehouse, TEST_FEATURES))
    pushed = [ln for ln in plan.splitlines() if "FileScan parquet" in ln and "activity_date" in ln]
    assert pushed and all("LessThanOrEqual(activity_date" in ln for ln in pushed)


def test_no_python_in_feature_plan(warehouse):
    plan = _plan(feat.training_features(warehouse, TEST_FEATURES))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert node not in plan


def test_first_touch_is_aggregate_not_window(warehouse):
    plan = _plan(feat.first_touch(warehouse.touches, TEST_FEATURES, TEST_FEATURES.window_start,
                                  TEST_FEATURES.window_end))
    assert "HashAggregate" in plan or "ObjectHashAggregate" in plan or "SortAggregate" in plan
    assert "Window" not in plan


@pytest.fixture(scope="module")
def partitioned(spark, tmp_path_factory, warehouse):
    """installs partitioned by year/month/day and touches by yy/mm/dd (zero-padded strings)."""
    from pyspark.sql.types import StringType, StructField, StructType

    root = str(tmp_path_factory.mktemp("pwh"))
    warehouse.installs.write.partitionBy("year", "month", "day").parquet(os.path.join(root, "installs"))
    warehouse.touches.write.partitionBy("yy", "mm", "dd").parquet(os.path.join(root, "touches"))

    def read(name, parts):
        base = warehouse.installs if name == "installs" else warehouse.touches
        fields = [f for f in base.schema.fields if f.name not in parts] + [StructField(p, StringType()) for p in parts]
        return spark.read.schema(StructType(fields)).parquet(os.path.join(root, name))

    return SimpleNamespace(installs=read("installs", ("year", "month", "day")),
                           touches=read("touches", ("yy", "mm", "dd")),
                           sessions=warehouse.sessions, utility=warehouse.utility, revenue=warehouse.revenue)


def test_partition_pruning_in_feature_build(partitioned):
    import datetime as dt
    for df in (feat.training_features(partitioned, TEST_FEATURES),
               feat.scoring_features(partitioned, TEST_FEATURES, dt.date(1995, 1, 1))):
        plan = _plan(df)
        scans = [ln for ln in plan.splitlines() if "FileScan parquet" in ln and ("/installs" in ln or "/touches" in ln)]
        assert len(scans) >= 2
        for ln in scans:
            pf = re.search(r"PartitionFilters: \[([^\]]*)\]", ln).group(1)
            assert "concat_ws" in pf, ln  # the date-range predicate prunes partitions


def test_feature_aggregate_reuses_join_partitioning(warehouse):
    """One join of the installs base and the stacked activity; the per-device aggregate above it needs
    no further exchange."""
    plan = feat.training_features(warehouse, TEST_FEATURES)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    join_at = next(i for i, ln in enumerate(lines) if "Join" in ln)  # the topmost join is the main one
    above = "\n".join(lines[:join_at])
    assert "HashAggregate" in above and "Exchange" not in above
    assert plan.count("Union") == 1


def test_scoring_plan_has_no_python(spark):
    """E2 features -> model frame -> hurdle model -> rule: all JVM (tree evaluation and rule expressions)."""
    import datetime as dt
    from cohortlens.operators.hurdle import HurdleRegressor
    from cohortlens.params import HurdleParams
    from cohortlens.plans import jobs
    w = load_world(spark, SF_SMALL)
    mf = feat.model_frame(feat.training_features(w, TEST_FEATURES), TEST_FEATURES)
    spec = jobs.base_spec(TEST_FEATURES, HurdleParams())
    spec.nrounds, spec.max_depth = 2, 2
    model = HurdleRegressor(spec).fit(mf)
    scored = jobs.score_cohort(w, TEST_FEATURES, dt.date(1995, 1, 1), model)
    plan = _plan(scored)
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert node not in plan
    assert scored.columns == ["s", "day_90_day_365"]


def _above(lines, at):
    """The nodes above a line of a plan, nearest first."""
    depth = len(re.match(r"[\s:|+\-*]*", lines[at]).group())
    out = []
    for ln in reversed(lines[:at]):
        d = len(re.match(r"[\s:|+\-*]*", ln).group())
        if d < depth:
            out.append(ln)
            depth = d
    return out


@pytest.mark.parametrize("kind", ["training", "scoring", "sessions", "utility", "spend"])
def test_membership_filter_stands_below_the_partial_aggregate(warehouse, kind):
    import datetime as dt
    p = TEST_FEATURES
    base = feat.installs_in_window(warehouse.installs, p, p.window_start, p.window_end)
    bound = p.window_end + dt.timedelta(days=p.day_from)
    df, names = {
        "training": lambda: (feat.training_features(warehouse, p), ["sessions", "utility", "revenue"]),
        "scoring": lambda: (feat.scoring_features(warehouse, p, dt.date(1995, 1, 1)), ["sessions", "utility", "revenue"]),
        "sessions": lambda: (feat.sessions_by_horizon(base, warehouse.sessions, p, [7], bound), ["sessions"]),
        "utility": lambda: (feat.utility_by_horizon(base, warehouse.utility, p, [7], bound), ["utility"]),
        "spend": lambda: (feat.spend_by_horizons(base, warehouse.revenue, p, [7], bound), ["revenue"]),
    }[kind]()
    lines = _plan(df).splitlines()
    for name in names:
        at = [i for i, ln in enumerate(lines) if "FileScan parquet" in ln and f"/{name}]" in ln]
        assert len(at) == 1
        up = _above(lines, at[0])
        agg = next(i for i, ln in enumerate(up) if "Aggregate" in ln)
        join = next(i for i, ln in enumerate(up) if "BroadcastHashJoin" in ln and "__word" in ln)
        exchange = next(i for i, ln in enumerate(up) if "Exchange" in ln)
        assert join < agg < exchange and "partial_" in up[agg]


def test_only_the_bases_device_days_are_shuffled(warehouse):
    p = TEST_FEATURES
    installs = feat.installs_in_window(warehouse.installs, p, p.window_start, p.window_end)
    devices = {r["s"] for r in installs.select("s").collect()}
    every = feat.activity_daily(warehouse, p, p.window_start, p.window_end).collect()
    pruned = feat.activity_daily(warehouse, p, p.window_start, p.window_end, installs.select("s")).collect()
    assert sorted(map(repr, pruned)) == sorted(repr(r) for r in every if r["s"] in devices)
    assert 0 < len(pruned) < len(every)
