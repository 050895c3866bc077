"""Sinks: date-partitioned prediction tables.

Partition columns are zero-padded strings ``year=YYYY/month=MM/day=DD``; reads declare them as strings
so the padding survives (SURVEY Q26). The upsert never overwrites a path it is reading: the merged
partition is written to a staging folder under the shared checkpoint directory, then swapped in with
dynamic partition overwrite, which replaces only the touched partition. Staging folders are left
under ``<spark.checkpoint.dir>/staging`` for the shared folder's retention policy (Spark has no
public API to delete paths); pass ``staging=`` to choose the location.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..session import ensure_checkpoint_dir

PARTS = ("year", "month", "day")


def partition_values(date: dt.date) -> dict[str, str]:
    return {"year": f"{date:%Y}", "month": f"{date:%m}", "day": f"{date:%d}"}


def _with_parts(df: DataFrame, date: dt.date) -> DataFrame:
    return df.withColumns({k: F.lit(v) for k, v in partition_values(date).items()})


def append_partition(df: DataFrame, path: str, date: dt.date) -> None:
    """Append rows to the ``date`` partition of a parquet table."""
    _with_parts(df, date).write.mode("append").partitionBy(*PARTS).parquet(path)


def read_partition(spark: SparkSession, path: str, date: dt.date, value_schema: StructType) -> DataFrame:
    """One cohort partition (partition equality -> PartitionFilters). A missing table reads as empty."""
    schema = StructType(list(value_schema.fields) + [StructField(p, StringType()) for p in PARTS])
    try:
        df = spark.read.schema(schema).option("basePath", path).parquet(path)
    except AnalysisException as e:  # only a missing path means "no data yet"
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    cond = None
    for k, v in partition_values(date).items():
        c = F.col(k) == v
        cond = c if cond is None else cond & c
    return df.where(cond)


def is_new_cohort(existing: DataFrame) -> bool:
    """Emptiness by ``isEmpty`` (a limit-1 job), not a full count."""
    return existing.isEmpty()


def merge_cohort(existing: DataFrame, new: DataFrame, column: str, all_columns: Sequence[str],
                 key: str = "s") -> DataFrame:
    """Replace ``column`` of ``existing`` by the values in ``new``; devices present on either side
    are kept (full outer join on the key, SURVEY Q12); declared columns missing from ``existing`` are
    null. One shuffle on the key."""
    dtype = new.schema[column].dataType
    old = existing.drop(column)
    for c in all_columns:
        if c != column and c not in old.columns:
            old = old.withColumn(c, F.lit(None).cast(dtype))
    return old.join(new.select(key, column), key, "full_outer").select(key, *all_columns)


def upsert_cohort(spark: SparkSession, path: str, date: dt.date, new: DataFrame, column: str,
                  all_columns: Sequence[str], key: str = "s", staging: str | None = None) -> DataFrame:
    """S8 + J5: refresh one prediction column of a cohort partition.

    Existing rows keep their other columns; devices new on either side are kept (full outer join,
    SURVEY Q12); declared columns absent so far are null. Returns the merged partition as written."""
    dtype = new.schema[column].dataType
    value_schema = StructType([StructField(key, StringType())] + [StructField(c, dtype) for c in all_columns])
    existing = read_partition(spark, path, date, value_schema).select(key, *all_columns)
    if is_new_cohort(existing):
        merged = new.select(key, *[F.col(c) if c == column else F.lit(None).cast(dtype).alias(c) for c in all_columns])
    else:
        merged = merge_cohort(existing, new, column, all_columns, key)
    stage = staging or f"{ensure_checkpoint_dir(spark).rstrip('/')}/staging/{uuid.uuid4().hex}"
    merged.write.mode("overwrite").parquet(stage)
    staged = spark.read.parquet(stage)
    (_with_parts(staged, date).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*PARTS).parquet(path))
    return staged


def upsert_partitions(spark: SparkSession, path: str, new: DataFrame, date_col: str, columns: Sequence[str],
                      all_columns: Sequence[str], key: str = "s", staging: str | None = None) -> DataFrame:
    """S8 for many cohorts at once (E5): ``new`` holds (key, date_col, *columns) for any number of cohort dates.

    ``new`` is staged first, so it is evaluated once. Only the partitions of dates that it holds are read, merged on
    (key, date) with a full outer join, staged, and swapped in with one dynamic partition overwrite; all other
    partitions, also those of dates in between, are neither read nor written."""
    dtype = new.schema[columns[0]].dataType
    root = staging or f"{ensure_checkpoint_dir(spark).rstrip('/')}/staging/{uuid.uuid4().hex}"
    new.select(key, date_col, *columns).write.mode("overwrite").parquet(f"{root}/new")
    fresh = spark.read.parquet(f"{root}/new")
    dates = [r[0] for r in fresh.select(date_col).distinct().collect()]  # cohort days: one date per partition written
    if not dates:
        return fresh.select(key, date_col, *[F.col(c) if c in columns else F.lit(None).cast(dtype).alias(c) for c in all_columns])
    value_schema = StructType([StructField(key, StringType())] + [StructField(c, dtype) for c in all_columns])
    schema = StructType(list(value_schema.fields) + [StructField(p, StringType()) for p in PARTS])
    stored_date = F.concat_ws("-", *[F.col(p) for p in PARTS])
    keep = [c for c in all_columns if c not in columns]
    try:
        existing = (spark.read.schema(schema).option("basePath", path).parquet(path)
                    .where(stored_date.isin([d.isoformat() for d in dates]))
                    .select(key, F.to_date(stored_date).alias(date_col), *keep))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        existing = spark.createDataFrame([], StructType([StructField(key, StringType()), StructField(date_col, new.schema[date_col].dataType)]
                                                        + [StructField(c, dtype) for c in keep]))
    merged = existing.join(fresh, [key, date_col], "full_outer").select(key, date_col, *all_columns)
    merged.write.mode("overwrite").parquet(f"{root}/merged")
    staged = spark.read.parquet(f"{root}/merged")
    d = F.col(date_col)
    (staged.withColumns({"year": F.date_format(d, "yyyy"), "month": F.date_format(d, "MM"), "day": F.date_format(d, "dd")})
     .drop(date_col).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*PARTS).parquet(path))
    return staged
