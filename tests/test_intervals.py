"""Dates in intervals against every pair, and the plan: no nested loop, no inequality left."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cohortlens.operators import intervals as iv

EPOCH = dt.date(1970, 1, 1)


@pytest.fixture(scope="module")
def world(spark):
    rng = random.Random(9)
    day = lambda k: EPOCH + dt.timedelta(days=k)
    days = [day(rng.randint(-400, 400)) for _ in range(150)] + [day(20_000), day(-100_000), day(0), dt.date(1, 1, 1), dt.date(9999, 12, 31), None]
    events = [("all", dt.date(1, 1, 1), dt.date(9999, 12, 31)), ("none", day(5), day(4)), ("open", day(3), None), ("shut", None, day(3)), (None, day(-9), day(9))]
    for i in range(300):
        a = rng.randint(-450, 450)
        events.append((f"e{i % 290}", day(a), day(a + rng.choice([0, 1, 2, 3, 7, 30, 365, 40_000]))))
    return (spark.createDataFrame([(d, 5, 1) for d in days], "date date, event_labels int, level int").repartition(3),
            spark.createDataFrame([(*e, 2) for e in events], "name string, start date, end date, block int").repartition(3), days, events)


def inside(d, e):
    return d is not None and e[1] is not None and e[2] is not None and e[1] <= d <= e[2]


def test_pairs(world):
    frame, table, days, events = world
    got = sorted((r["__day"], r["name"] or "", r["start"], r["end"]) for r in iv.events_on_days(frame, "date", table, "start", "end").collect())
    assert got == sorted((d, e[0] or "", e[1], e[2]) for d in set(days) for e in events if inside(d, e))


def test_totals(world):
    frame, table, days, events = world
    got = {r["__day"]: (r["n"], r["s"]) for r in iv.totals_on_days(frame, "date", table, "start", "end", {"n": F.lit(1), "s": F.col("block")}).collect()}
    want = {d: sum(inside(d, e) for e in events) for d in set(days) if d}
    assert got == {d: (n, 2 * n) for d, n in want.items() if n}


def test_labels(world):
    frame, table, days, events = world
    out = iv.label_events_from(frame, "date", table, "name", "start", "end")
    assert out.columns == ["date", "level", "event_labels"]
    want = [(d, ", ".join(e[0] for e in sorted((e for e in events if e[0] and inside(d, e)), key=lambda e: (e[1], e[0]))) or None) for d in days]
    assert sorted(((r["date"], r["event_labels"]) for r in out.collect()), key=repr) == sorted(want, key=repr)


def test_blocks_are_few(world):
    _, table, _, _ = world
    most = iv.interval_blocks(table, "start", "end").groupBy("name", "start", "end").count().agg(F.max("count")).first()[0]
    assert most <= 2 * iv.TOP + 120


def test_plan_has_equi_joins_only(spark, world):
    frame, table, _, _ = world
    for df in (iv.events_on_days(frame, "date", table, "start", "end"), iv.label_events_from(frame, "date", table, "name", "start", "end")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_empty(spark, world):
    frame, table, days, _ = world
    assert iv.events_on_days(frame, "date", table.limit(0), "start", "end").count() == 0
    assert iv.label_events_from(frame, "date", table.limit(0), "name", "start", "end").count() == len(days)
    assert iv.label_events_from(frame.limit(0), "date", table, "name", "start", "end").count() == 0
