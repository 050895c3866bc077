"""Device-day activity kept up day by day: batches of new, late and corrected rows are added without
rebuilding what is there, and feature builds read it without shuffling it.

The stored rows are the device-day sums that every feature build needs (``features.activity_daily``): sums of sums, so a
device's day may lie in several batches. A batch (usually what arrived on one day) holds rows of any activity dates. Its
sums are written under a load id of its own and become visible when the commit log (``commits``) says that the batch is
that load; running a batch again, with the same or corrected rows, names another load, and the old one is no longer read.
So a re-run changes nothing, a correction replaces exactly the rows of its batch, and a job that dies leaves the store as
it was. No earlier file is read or rewritten to add a batch. ``compact`` turns the batches so far into one.

The table is partitioned by period of the activity date (days by default) and load, and bucketed and sorted by device:
date bounds and loads prune partitions, and the join with the installs base and the sums per device find the activity
already dealt out by device, so only the (much smaller) base moves. ``buckets`` should be no less than
``spark.sql.shuffle.partitions``: with fewer, Spark deals both sides out again.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import features as feat
from ..operators.membership import keep_members, member_words
from ..params import FeatureParams
from . import commits

MONEY = "decimal(38,6)"
COLUMNS = {"s": "string", "activity_date": "date", "n": "bigint", "len": MONEY, "util": "double", "amt": MONEY}


ROWS_PER_BUCKET = 2_000_000  # about 400 MB while a task sorts them


def buckets_for(spark: SparkSession, rows: int, fewest: int = 8) -> int:
    """Buckets for a store whose largest batch has about ``rows`` device-days: a task writes and joins one bucket, so what
    it holds must not grow with the store. More than ``fewest`` are no less than the shuffle partitions (see above)."""
    need = -(-rows // ROWS_PER_BUCKET)
    return fewest if need <= fewest else max(need, int(spark.conf.get("spark.sql.shuffle.partitions")))


@dataclass(frozen=True)
class ActivityStore:
    """A store at ``root``, registered in the catalog as ``table`` (created where it is missing)."""

    spark: SparkSession
    root: str
    table: str
    buckets: int
    period: str = "yyyy-MM-dd"

    def open(self) -> "ActivityStore":
        if self.spark.catalog.tableExists(self.table):
            return self
        columns = ", ".join(f"{c} {t}" for c, t in COLUMNS.items())
        location = f"{self.root.rstrip('/')}/rows"
        self.spark.sql(f"CREATE TABLE {self.table} ({columns}, period string, load string) USING parquet "
                       f"PARTITIONED BY (period, load) CLUSTERED BY (s) SORTED BY (s) INTO {self.buckets} BUCKETS LOCATION '{location}'")
        return self.refresh() if commits.versions(self.spark, self.root) else self

    def refresh(self) -> "ActivityStore":
        """Let the session's catalog find partitions that other sessions wrote."""
        self.spark.catalog.recoverPartitions(self.table)
        return self

    def _entry(self, version: int | None = None) -> dict:
        have = commits.versions(self.spark, self.root)
        if not have or version == 0:
            return {"loads": {}, "closed": []}
        return commits.read_entry(self.spark, self.root, have[-1] if version is None else version)

    def _write(self, days: DataFrame) -> str:
        load = uuid.uuid4().hex
        rows = days.select(*[F.col(c).cast(t).alias(c) for c, t in COLUMNS.items()],
                           F.date_format("activity_date", self.period).alias("period"), F.lit(load).alias("load"))
        # one task per bucket, so one file per bucket and period
        rows.repartition(self.buckets, "s").sortWithinPartitions("period", "s").write.insertInto(self.table)
        return load

    def put(self, batch: str, days: DataFrame) -> int:
        """Write the device-days of a batch, in place of what the batch held before; returns the new version. Rows
        without a device or date belong to no feature and are left out."""
        if batch in self._entry()["closed"]:
            raise ValueError(f"batch {batch} has been compacted and can't be replaced")
        load = self._write(days.where("s IS NOT NULL AND activity_date IS NOT NULL"))

        def entry(_version: int, before: dict | None) -> dict:
            before = before or {"loads": {}, "closed": []}
            if batch in before["closed"]:
                raise ValueError(f"batch {batch} has been compacted and can't be replaced")
            return {"loads": before["loads"] | {batch: load}, "closed": before["closed"]}

        return commits.commit_next(self.spark, self.root, entry)[0]

    def read(self, start: dt.date | None = None, end: dt.date | None = None, version: int | None = None) -> DataFrame:
        """The device-days between two dates (inclusive), as of a version; a device's day may be in several rows."""
        loads = sorted(self._entry(version)["loads"].values())
        rows = self.spark.table(self.table).where(F.col("load").isin(loads) if loads else F.lit(False))
        for bound, keep in ((start, lambda c, v: c >= v), (end, lambda c, v: c <= v)):
            if bound is not None:
                rows = rows.where(keep(F.col("activity_date"), F.lit(bound))
                                  & keep(F.col("period"), F.date_format(F.lit(bound), self.period)))
        return rows.select(*COLUMNS)

    def compact(self) -> int:
        """Turn all batches into one load with one row per device and day; these batches can't be replaced any more."""
        old = self._entry()
        if not old["loads"]:
            return 0
        sums = [F.sum(c).cast(COLUMNS[c]).alias(c) for c in ("n", "len", "util", "amt")]
        load = self._write(self.read().groupBy("s", "activity_date").agg(*sums))
        name = f"compacted-{load}"

        def entry(_version: int, before: dict | None) -> dict:
            if any(before["loads"].get(b) != v for b, v in old["loads"].items()):
                raise RuntimeError("a batch was replaced while it was compacted")
            rest = {b: v for b, v in before["loads"].items() if b not in old["loads"]}
            return {"loads": rest | {name: load}, "closed": sorted({*before["closed"], *old["loads"]})}

        return commits.commit_next(self.spark, self.root, entry)[0]


def features(store: ActivityStore, tables, p: FeatureParams, start: dt.date, end: dt.date, per_cohort: bool = False) -> DataFrame:
    """E1 / E2 / E5 from the store: rows of installs in ``[start, end]`` as ``features.build_features`` (or, per cohort,
    ``features.cohort_features``) gives them, without reading any raw activity."""
    installs = feat.installs_in_window(tables.installs, p, start, end)
    base = (feat.cohort_base(tables, p, start, end) if per_cohort
            else feat.installs_base(installs, feat.first_touch(tables.touches, p, start, end)))
    earliest = None if p.min_age is None else start + dt.timedelta(days=p.min_age)
    days = store.read(earliest, end + dt.timedelta(days=max(p.day_from, p.day_to)))
    return feat.features_of(base, keep_members(days, "s", member_words(installs, "s")), p)
