"""Sources and sinks (S2 S3 S6-S10, FIXTURES X10)."""

import datetime as dt
import os

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from cohortlens.sources import sinks, tables

ALL = ["day_7_day_30", "day_7_day_60", "day_7_day_90", "day_7_day_120"]


def preds(spark, rows, col):
    return spark.createDataFrame(rows, f"s string, {col} double")


def read_all(spark, path, date):
    schema = StructType([StructField("s", StringType())] + [StructField(c, DoubleType()) for c in ALL])
    return sorted(map(tuple, sinks.read_partition(spark, path, date, schema).select("s", *ALL).collect()))


def test_x10_upsert_full_outer_and_idempotent(spark, tmp_dir):
    path = os.path.join(tmp_dir, "preds")
    d = dt.date(2020, 3, 5)
    other = dt.date(2020, 12, 1)
    sinks.upsert_cohort(spark, path, other, preds(spark, [("z", 9.0)], "day_7_day_30"), "day_7_day_30", ALL,
                        staging=os.path.join(tmp_dir, "st0"))
    # first write for the cohort: only one horizon known, the others are null columns
    sinks.upsert_cohort(spark, path, d, preds(spark, [("a", 1.0), ("b", 2.0)], "day_7_day_30"), "day_7_day_30", ALL,
                        staging=os.path.join(tmp_dir, "st1"))
    assert read_all(spark, path, d) == [("a", 1.0, None, None, None), ("b", 2.0, None, None, None)]
    # second horizon: device c is new, device a missing on the new side (full outer join, Q12)
    new = preds(spark, [("b", 20.0), ("c", 30.0)], "day_7_day_60")
    sinks.upsert_cohort(spark, path, d, new, "day_7_day_60", ALL, staging=os.path.join(tmp_dir, "st2"))
    want = [("a", 1.0, None, None, None), ("b", 2.0, 20.0, None, None), ("c", None, 30.0, None, None)]
    assert read_all(spark, path, d) == want
    sinks.upsert_cohort(spark, path, d, new, "day_7_day_60", ALL, staging=os.path.join(tmp_dir, "st3"))
    assert read_all(spark, path, d) == want  # idempotent
    assert read_all(spark, path, other) == [("z", 9.0, None, None, None)]  # other partition untouched
    # zero-padded partition folders (Q26)
    assert os.path.isdir(os.path.join(path, "year=2020", "month=03", "day=05"))


def test_append_and_is_new_cohort(spark, tmp_dir):
    path = os.path.join(tmp_dir, "app")
    d = dt.date(2021, 1, 9)
    schema = StructType([StructField("s", StringType()), StructField("v", DoubleType())])
    assert sinks.is_new_cohort(sinks.read_partition(spark, path, d, schema))
    sinks.append_partition(spark.createDataFrame([("a", 1.0)], schema), path, d)
    part = sinks.read_partition(spark, path, d, schema)
    assert not sinks.is_new_cohort(part)
    assert part.select("month", "day").first() == ("01", "09")


def test_partition_pruning(spark, tmp_dir):
    path = os.path.join(tmp_dir, "pp")
    schema = StructType([StructField("s", StringType()), StructField("v", DoubleType())])
    for day in (1, 2, 3):
        sinks.append_partition(spark.createDataFrame([(f"d{day}", float(day))], schema), path, dt.date(2020, 1, day))
    part = sinks.read_partition(spark, path, dt.date(2020, 1, 2), schema)
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "isnotnull(day" in plan
    assert [r["s"] for r in part.collect()] == ["d2"]


def test_snapshot_and_parametrised_sql(spark, tmp_dir):
    df = spark.range(10).withColumn("g", F.col("id") % 2)
    snap = tables.snapshot(df, os.path.join(tmp_dir, "snap"))
    assert snap.count() == 10
    snap.createOrReplaceTempView("snap_t")
    got = tables.read_parametrised(spark, "SELECT count(*) AS n FROM snap_t WHERE g = :g AND id >= :lo", g=1, lo=5)
    assert got.first()["n"] == 3
    assert tables.read_by_name(spark, "snap_t").count() == 10


def test_cluster_conf_sizes():
    from cohortlens.session import cluster_conf
    c = cluster_conf(100 * (1 << 40), 8000)
    assert c["spark.sql.shuffle.partitions"] == "100000"
    assert c["spark.sql.adaptive.enabled"] == "true" and "spark.ui.enabled" not in c
    small = cluster_conf(1 << 30, 16)
    assert small["spark.sql.shuffle.partitions"] == "32"


def test_upsert_partitions_many_cohorts(spark, tmp_dir):
    path = os.path.join(tmp_dir, "multi")
    cols = ["day_7_day_30", "day_7_day_60"]
    d1, d2, d3 = dt.date(2020, 1, 1), dt.date(2020, 1, 2), dt.date(2020, 2, 1)
    first = spark.createDataFrame([("a", d1, 1.0), ("b", d2, 2.0), ("z", d3, 9.0)], "s string, cohort_date date, day_7_day_30 double")
    sinks.upsert_partitions(spark, path, first, "cohort_date", ["day_7_day_30"], cols)
    second = spark.createDataFrame([("a", d1, 10.0), ("c", d2, 30.0)], "s string, cohort_date date, day_7_day_60 double")
    sinks.upsert_partitions(spark, path, second, "cohort_date", ["day_7_day_60"], cols)
    schema = StructType([StructField("s", StringType())] + [StructField(c, DoubleType()) for c in cols])
    got = {d: sorted(map(tuple, sinks.read_partition(spark, path, d, schema).select("s", *cols).collect()))
           for d in (d1, d2, d3)}
    assert got[d1] == [("a", 1.0, 10.0)]
    assert got[d2] == [("b", 2.0, None), ("c", None, 30.0)]
    assert got[d3] == [("z", 9.0, None)]  # outside the new date range: untouched


def test_upsert_partitions_leaves_dates_in_between(spark, tmp_dir):
    path, cols = os.path.join(tmp_dir, "gap"), ["day_7_day_30"]
    days = [dt.date(2020, 1, 1), dt.date(2020, 1, 15), dt.date(2020, 1, 31)]
    schema = "s string, cohort_date date, day_7_day_30 double"
    sinks.upsert_partitions(spark, path, spark.createDataFrame([("a", d, 5.0) for d in days], schema), "cohort_date", cols, cols)
    sinks.upsert_partitions(spark, path, spark.createDataFrame([("a", days[0], 6.0), ("b", days[2], 7.0)], schema), "cohort_date", cols, cols)
    stored = StructType([StructField("s", StringType()), StructField(cols[0], DoubleType())])
    got = [sorted(map(tuple, sinks.read_partition(spark, path, d, stored).select("s", *cols).collect())) for d in days]
    assert got == [[("a", 6.0)], [("a", 5.0)], [("a", None), ("b", 7.0)]]


def test_format_and_daily_cohort(spark):
    from cohortlens.functions.format import comma, dollar, fixed
    from cohortlens.params import FeatureParams
    df = spark.createDataFrame([(1234.5,), (-3.0,)], "x double")
    assert [r[0] for r in df.select(dollar("x")).collect()] == ["$1,234.50", "-$3.00"]
    assert [r[0] for r in df.select(comma("x")).collect()] == ["1,234", "-3"]  # half-even, as R formats
    assert [r[0] for r in df.select(fixed("x")).collect()] == ["1234.50", "-3.00"]
    assert FeatureParams(day_from=7).daily_cohort(dt.date(2020, 3, 10)) == dt.date(2020, 3, 2)
