"""Versioned tables of cohort predictions: an upsert of any number of dates that readers see whole or not at
all, and that can be read again as of any version.

A version is an entry of the commit log (``commits``) that names one folder for each date. An upsert writes the merged
dates under a folder of its own and commits the mapping in which these dates point there and all others where they pointed
before; nothing is replaced, moved or deleted, so readers of older versions go on undisturbed and a job that dies leaves
the table as it was. Of two writers the later one merges again if the earlier one changed a date of its own, and only
commits again if it did not. The mapping has one entry per date, so it is small.

Old folders are kept for reading older versions; ``unreferenced`` lists those that no version names (of jobs that died).
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from . import commits

DATA = "data"
_SPLIT = "folder_date"


def dates_of(spark: SparkSession, root: str, version: int | None = None) -> dict[str, str]:
    """ISO date -> folder of a version (the latest by default; none committed: no dates)."""
    have = commits.versions(spark, root)
    if version is None:
        return commits.read_entry(spark, root, have[-1])["dates"] if have else {}
    if version == 0:
        return {}
    if version not in have:
        raise FileNotFoundError(f"{root} has no version {version}")
    return commits.read_entry(spark, root, version)["dates"]


def _read(spark: SparkSession, root: str, dates: dict[str, str], schema: StructType) -> DataFrame:
    if not dates:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root.rstrip('/')}/{f}" for _, f in sorted(dates.items())])


def read_snapshot(spark: SparkSession, root: str, schema: StructType, version: int | None = None,
                  dates: Iterable[dt.date] | None = None) -> DataFrame:
    """The rows of a version, of the given dates only if ``dates`` is set (only their folders are listed)."""
    known = dates_of(spark, root, version)
    if dates is not None:
        wanted = {d.isoformat() for d in dates}
        known = {d: f for d, f in known.items() if d in wanted}
    return _read(spark, root, known, schema)


def table_schema(new: DataFrame, date_col: str, columns: Sequence[str], all_columns: Sequence[str], key: str) -> StructType:
    kind = new.schema[columns[0]].dataType
    return StructType([StructField(key, new.schema[key].dataType), StructField(date_col, new.schema[date_col].dataType),
                       *[StructField(c, kind) for c in all_columns]])


def upsert_snapshot(spark: SparkSession, root: str, new: DataFrame, date_col: str, columns: Sequence[str],
                    all_columns: Sequence[str], key: str = "s") -> int:
    """Refresh ``columns`` of the dates in ``new`` (key, date_col, *columns) and publish them as one new version, which is
    returned (without rows: the version before). Rows on either side are kept (full outer join on key and date), other
    columns keep their values, columns never written are null. Rows with a null date are an error."""
    run = f"{DATA}/{uuid.uuid4().hex}"
    base = root.rstrip("/")
    new.select(key, date_col, *columns).write.parquet(f"{base}/{run}/new")  # evaluated once, also if merged again
    fresh = spark.read.parquet(f"{base}/{run}/new")
    days = [r[0] for r in fresh.select(date_col).distinct().collect()]  # one date per cohort
    if None in days:
        raise ValueError(f"{date_col} is null in rows to be published")
    if not days:
        have = commits.versions(spark, root)
        return have[-1] if have else 0
    touched = sorted(d.isoformat() for d in days)
    schema = table_schema(new, date_col, columns, all_columns, key)
    merged: dict = {"from": None, "folder": None}

    def entry(version: int, before: dict | None) -> dict:
        dates = before["dates"] if before else {}
        mine = {d: dates[d] for d in touched if d in dates}
        if merged["folder"] is None or merged["from"] != mine:
            folder = f"{run}/merged-{version}-{uuid.uuid4().hex[:8]}"
            old = _read(spark, root, mine, schema).drop(*columns)
            rows = old.join(fresh, [key, date_col], "full_outer").select(key, date_col, *all_columns)
            (rows.withColumn(_SPLIT, F.date_format(date_col, "yyyy-MM-dd")).write.partitionBy(_SPLIT).parquet(f"{base}/{folder}"))
            merged.update({"from": mine, "folder": folder})
        return {"dates": dates | {d: f"{merged['folder']}/{_SPLIT}={d}" for d in touched}, "touched": touched,
                "columns": list(columns)}

    return commits.commit_next(spark, root, entry)[0]


def unreferenced(spark: SparkSession, root: str) -> list[str]:
    """Folders under ``data`` that no version names: left by writers that died, or merged again. To be deleted by the owner
    of the table once no writer is at work."""
    named = {"/".join(f.split("/")[:2]) for v in commits.versions(spark, root) for f in commits.read_entry(spark, root, v)["dates"].values()}
    fs, data = commits._path(spark, root, DATA)
    if not fs.exists(data):
        return []
    return sorted(x for x in (f"{DATA}/{s.getPath().getName()}" for s in fs.listStatus(data)) if x not in named)
