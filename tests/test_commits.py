"""Commit log, versioned cohort tables and the registry: writers that race, writers that die, readers of any version."""

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from cohortlens.sources import commits, registry, snapshots

D = [dt.date(2024, 1, k) for k in range(1, 6)]
COLS = ["a", "b"]


def rows(spark, values, column="a"):
    return spark.createDataFrame([(s, d, float(v)) for s, d, v in values], f"s string, cohort_date date, {column} double")


def schema(spark):
    return snapshots.table_schema(rows(spark, []), "cohort_date", ["a"], COLS, "s")


def read(spark, root, **kw):
    return sorted(tuple(r) for r in snapshots.read_snapshot(spark, root, schema(spark), **kw).collect())


def upsert(spark, root, values, column="a"):
    return snapshots.upsert_snapshot(spark, root, rows(spark, values, column), "cohort_date", [column], COLS)


def test_one_winner_per_version(spark, tmp_dir):
    assert commits.versions(spark, tmp_dir) == []
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda k: commits.try_commit(spark, tmp_dir, 1, {"k": k}), range(8)))
    assert sum(won) == 1 and commits.versions(spark, tmp_dir) == [1]
    assert commits.read_entry(spark, tmp_dir, 1) == {"k": won.index(True)}


def test_racing_writers_all_commit(spark, tmp_dir):
    with ThreadPoolExecutor(6) as pool:
        got = list(pool.map(lambda k: commits.commit_next(spark, tmp_dir, lambda v, before: {"sum": (before or {"sum": 0})["sum"] + k})[0], range(1, 7)))
    assert sorted(got) == [1, 2, 3, 4, 5, 6]
    assert commits.read_entry(spark, tmp_dir, 6) == {"sum": 21}  # each saw what the one before left


def test_upsert_versions(spark, tmp_dir):
    assert read(spark, tmp_dir) == []
    assert upsert(spark, tmp_dir, [("x", D[0], 1), ("y", D[0], 2), ("x", D[1], 3)]) == 1
    assert upsert(spark, tmp_dir, [("y", D[0], 9), ("z", D[0], 8)], "b") == 2
    first = [("x", D[0], 1.0, None), ("x", D[1], 3.0, None), ("y", D[0], 2.0, None)]
    assert read(spark, tmp_dir, version=1) == first and read(spark, tmp_dir, version=0) == []
    assert sorted(read(spark, tmp_dir), key=repr) == sorted([("x", D[0], 1.0, None), ("x", D[1], 3.0, None), ("y", D[0], 2.0, 9.0), ("z", D[0], None, 8.0)], key=repr)
    assert read(spark, tmp_dir, dates=[D[1], D[4]]) == [("x", D[1], 3.0, None)]
    assert upsert(spark, tmp_dir, []) == 2
    with pytest.raises(FileNotFoundError):
        read(spark, tmp_dir, version=7)
    with pytest.raises(ValueError, match="null"):
        upsert(spark, tmp_dir, [("x", None, 1)])
    again = upsert(spark, tmp_dir, [("y", D[0], 9), ("z", D[0], 8)], "b")  # run once more: the same rows
    assert again == 3 and sorted(read(spark, tmp_dir), key=repr) == sorted(read(spark, tmp_dir, version=2), key=repr)


def test_a_writer_that_dies_leaves_the_old_version(spark, tmp_dir, monkeypatch):
    upsert(spark, tmp_dir, [("x", d, 1) for d in D])
    before = read(spark, tmp_dir)
    broken = rows(spark, [("x", d, 2) for d in D]).withColumn("a", F.when(F.col("cohort_date") == F.lit(D[3]), F.raise_error(F.lit("lost"))).otherwise(F.col("a")))
    with pytest.raises(Exception, match="lost"):  # between dates
        snapshots.upsert_snapshot(spark, tmp_dir, broken, "cohort_date", ["a"], COLS)
    monkeypatch.setattr(commits, "try_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):  # after all dates were written
        upsert(spark, tmp_dir, [("x", d, 3) for d in D])
    monkeypatch.undo()
    assert read(spark, tmp_dir) == before and commits.versions(spark, tmp_dir) == [1]
    assert len(snapshots.unreferenced(spark, tmp_dir)) == 2
    assert upsert(spark, tmp_dir, [("x", D[0], 4)]) == 2


@pytest.mark.parametrize("same_date", [True, False])
def test_a_faster_writer_is_not_lost(spark, tmp_dir, monkeypatch, same_date):
    upsert(spark, tmp_dir, [("x", D[0], 1)])
    real, calls = commits.try_commit, []

    def slow(sp, root, version, entry):
        if not calls:
            calls.append(version)
            monkeypatch.setattr(commits, "try_commit", real)
            upsert(spark, tmp_dir, [("y", D[0] if same_date else D[1], 5)], "b")
        return real(sp, root, version, entry)

    monkeypatch.setattr(commits, "try_commit", slow)
    assert upsert(spark, tmp_dir, [("x", D[0], 2)]) == 3
    assert sorted(read(spark, tmp_dir), key=repr) == sorted([("x", D[0], 2.0, None), ("y", D[0] if same_date else D[1], None, 5.0)], key=repr)


class Stub:
    """Stands for a model: only ``save`` is used."""

    def __init__(self, spark, fail=False):
        self.spark, self.fail = spark, fail

    def save(self, path):
        self.spark.range(1).write.parquet(path + "/part")
        if self.fail:
            raise RuntimeError("lost")


def test_registry_two_writers_and_half_a_model(spark, tmp_dir):
    with ThreadPoolExecutor(4) as pool:
        paths = list(pool.map(lambda _: registry.save_model(spark, Stub(spark), tmp_dir, "g", 7, 30), range(4)))
    listed = registry.list_models(spark, tmp_dir).orderBy("version").collect()
    assert [r["version"] for r in listed] == [1, 2, 3, 4] and {r["path"] for r in listed} == set(paths)
    with pytest.raises(RuntimeError, match="lost"):
        registry.save_model(spark, Stub(spark, fail=True), tmp_dir, "g", 7, 30)
    assert registry.latest_model_path(spark, tmp_dir, "g", 7, 30) == listed[-1]["path"]
    assert registry.model_path(spark, tmp_dir, "g", 7, 30, version=2) == listed[1]["path"]
    for missing in ({"version": 9}, {}):
        with pytest.raises(FileNotFoundError):
            registry.model_path(spark, tmp_dir, "g", 7, 30 if missing else 60, **missing)
    assert registry.list_models(spark, tmp_dir, "other").count() == 0
