"""Model registry: models in folders of their own, listed by the commit log of each (game, horizon).

``save_model`` writes the model under a folder that no reader looks into and then commits an entry with its path: of two
writers that save at once each gets a version of its own, and one that dies half-way leaves no version. Versions count
from 1; ``load_latest_model`` takes the highest (metadata, not file timestamps), so it works on any file system Spark can
read whose rename is atomic (see ``commits``).
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.hurdle import HurdleModel
from . import commits

INDEX_SCHEMA = "game string, day_from int, day_to int, version long, path string, created_at timestamp, metrics string"


def _folder(root: str, game: str, day_from: int, day_to: int) -> str:
    return f"{root.rstrip('/')}/{game}/day_{day_from}_to_day_{day_to}"


def save_model(spark: SparkSession, model: HurdleModel, root: str, game: str, day_from: int, day_to: int,
               metrics: str = "") -> str:
    folder = _folder(root, game, day_from, day_to)
    path = f"{folder}/models/{uuid.uuid4().hex}"
    model.save(path)
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)

    def entry(version: int, _before: dict | None) -> dict:
        return {"game": game, "day_from": day_from, "day_to": day_to, "version": version, "path": path,
                "created_at": now.isoformat(), "metrics": metrics}

    commits.commit_next(spark, folder, entry)
    return path


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = commits._path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def list_models(spark: SparkSession, root: str, game: str | None = None) -> DataFrame:
    """One row per committed model (a few for each game and horizon)."""
    rows = []
    for g in [game] if game is not None else _names(spark, root):
        for horizon in _names(spark, f"{root.rstrip('/')}/{g}"):
            folder = f"{root.rstrip('/')}/{g}/{horizon}"
            for v in commits.versions(spark, folder):
                e = commits.read_entry(spark, folder, v)
                rows.append((e["game"], e["day_from"], e["day_to"], v, e["path"], dt.datetime.fromisoformat(e["created_at"]), e["metrics"]))
    return spark.createDataFrame(rows, INDEX_SCHEMA)


def model_path(spark: SparkSession, root: str, game: str, day_from: int, day_to: int, version: int | None = None) -> str:
    """The path of a version for (game, day_from, day_to), the highest by default."""
    folder = _folder(root, game, day_from, day_to)
    have = commits.versions(spark, folder)
    if not have or (version is not None and version not in have):
        raise FileNotFoundError(f"no model {'' if version is None else f'version {version} '}for {game} day {day_from} -> {day_to} under {root}")
    return commits.read_entry(spark, folder, have[-1] if version is None else version)["path"]


def latest_model_path(spark: SparkSession, root: str, game: str, day_from: int, day_to: int) -> str:
    """The path of the highest version for (game, day_from, day_to)."""
    return model_path(spark, root, game, day_from, day_to)


def load_latest_model(spark: SparkSession, root: str, game: str, day_from: int, day_to: int) -> HurdleModel:
    return HurdleModel.load(latest_model_path(spark, root, game, day_from, day_to))
