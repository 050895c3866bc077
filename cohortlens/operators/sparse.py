"""Maps with any number of keys as sparse rows: a dictionary table of the keys and one row per entry or
one sparse vector per user, in place of one column per key.

Nothing here collects keys: the dictionary is a table, entries meet it by a join, means and profiles are aggregates, and
principal components come from subspace iteration on the entries. A missing key counts as 0 everywhere, as in the wide
form. What reaches the driver is k x k numbers for k components; Spark's k-means holds k centres of one number per key.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..session import cut_lineage
from . import segments


def entries(df: DataFrame, key: str, map_col: str) -> DataFrame:
    """(key, name, value) of a ``map<string,double>`` column; null values and zeros are left out, as they equal a missing
    key. ``key`` is unique in ``df``."""
    long = df.select(key, F.explode(map_col).alias("name", "value"))
    return long.where(F.col("value").isNotNull() & (F.col("value") != 0))


def dictionary(long: DataFrame) -> DataFrame:
    """(name, idx): the distinct names numbered from 0 in their order, without a task that sees them all: names are dealt
    by range and sorted, and each range's numbers begin where the ranges before it end."""
    names = long.select("name").where("name IS NOT NULL").distinct().repartitionByRange("name").sortWithinPartitions("name")
    marked = cut_lineage(names.withColumn("__m", F.monotonically_increasing_id()))  # range in the upper bits, place below
    part, place = F.shiftright("__m", 33), F.col("__m").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = marked.groupBy(part.alias("__p")).agg(F.count("*").alias("__n"))  # one row per range
    starts = sizes.select("__p", (F.sum("__n").over(Window.orderBy("__p")) - F.col("__n")).alias("__start"))
    return marked.join(F.broadcast(starts), part == F.col("__p")).select("name", (F.col("__start") + place).alias("idx"))


def indexed(long: DataFrame, key: str, names: DataFrame) -> DataFrame:
    """(key, idx, value) of the entries whose name the dictionary has."""
    return long.join(names, "name").select(key, "idx", F.col("value").cast("double").alias("value"))


def scale_by_largest(long: DataFrame, names_col: str = "name") -> DataFrame:
    """Min-max scaling of non-negative entries: as a missing key is 0, a value is divided by the key's greatest. Negative
    values are an error."""
    checked = F.when(F.col("value") < 0, F.raise_error(F.lit("negative values can't be scaled sparsely"))).otherwise(F.col("value"))
    most = long.groupBy(names_col).agg(F.max(checked).alias("__most"))
    return long.join(most, names_col).withColumn("value", F.col("value") / F.col("__most")).drop("__most")


def vectors(rows: DataFrame, key: str, users: DataFrame, size: int, out: str = "features") -> DataFrame:
    """One sparse vector of length ``size`` per user of ``users`` (key), also for users without entries. Entries of one user
    and index are added. Built in the JVM, from the vector type's own representation."""
    summed = rows.groupBy(key, "idx").agg(F.sum("value").alias("value"))
    lists = summed.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col("idx").cast("int").alias("idx"), "value"))).alias("__e"))
    e = F.coalesce(F.col("__e"), F.array().cast("array<struct<idx:int,value:double>>"))
    parts = F.struct(F.lit(0).alias("type"), F.lit(size).alias("size"), F.transform(e, lambda x: x["idx"]).alias("indices"),
                     F.transform(e, lambda x: x["value"]).alias("values"))
    read = F.from_json(F.to_json(F.struct(parts.alias("v"))), StructType([StructField("v", VectorUDT())]))
    return users.select(key).join(lists, key, "left").select(key, read["v"].alias(out))


def means(long: DataFrame, n_users: int) -> DataFrame:
    """A9 on many keys: (name, mean) over all users, missing keys as 0."""
    return long.groupBy("name").agg((F.sum("value") / F.lit(n_users)).alias("mean"))


def profile(long: DataFrame, key: str, labels: DataFrame, label: str = "cluster") -> DataFrame:
    """A10 on many keys: (label, name, mean) over the users of each label; names that no user of a label has are left
    out (their mean is 0)."""
    sizes = labels.groupBy(label).agg(F.count("*").alias("__n"))
    sums = long.join(labels.select(key, label), key).groupBy(label, "name").agg(F.sum("value").alias("__s"))
    return sums.join(sizes, label).select(label, "name", (F.col("__s") / F.col("__n")).alias("mean"))


def _columns(prefix: str, k: int) -> list[str]:
    return [f"{prefix}{c}" for c in range(k)]


def _rotate(frame: DataFrame, ids: Sequence[str], cols: Sequence[str], m: np.ndarray, prefix: str) -> DataFrame:
    """Columns times a k x k matrix."""
    def mix(c: int) -> Column:
        return sum((F.col(name) * F.lit(float(m[i, c])) for i, name in enumerate(cols)), F.lit(0.0))
    return frame.select(*ids, *[mix(c).alias(f"{prefix}{c}") for c in range(m.shape[1])])


def _gram(frame: DataFrame, cols: Sequence[str]) -> np.ndarray:
    k = len(cols)
    row = frame.agg(*[F.sum(F.col(cols[i]) * F.col(cols[j])) for i in range(k) for j in range(i, k)]).first()
    g, at = np.zeros((k, k)), 0
    for i in range(k):
        for j in range(i, k):
            g[i, j] = g[j, i] = row[at] or 0.0
            at += 1
    return g


def _orthonormal(frame: DataFrame, ids: Sequence[str], cols: Sequence[str], prefix: str) -> DataFrame:
    """The same space with orthonormal columns, by the eigenvectors of their k x k products."""
    w, v = np.linalg.eigh(_gram(frame, cols))
    return _rotate(frame, ids, cols, v / np.sqrt(np.maximum(w, 1e-300)), prefix)


def principal_components(rows: DataFrame, key: str, n_users: int, k: int = 4, rounds: int = 15, spare: int = 4) -> tuple[DataFrame, DataFrame]:
    """M2 on many keys: (scores: key, pc1..pck of users with entries, and one row with a null key that holds for each user
    without; loadings: idx, pc1..pck).

    Subspace iteration with ``k + spare`` directions: scores are sums over a user's entries, centred by the mean user, and
    new directions are sums over an index's entries; both are joins and aggregates with map-side sums. Signs are such that
    a component's largest loading is positive."""
    scores, loadings, _ = _components(rows, key, n_users, k, rounds, spare)
    return scores, loadings


def _components(rows: DataFrame, key: str, n_users: int, k: int, rounds: int, spare: int):
    rows = cut_lineage(rows.groupBy(key, "idx").agg(F.sum("value").alias("value")))
    centre = cut_lineage(rows.groupBy("idx").agg((F.sum("value") / F.lit(n_users)).alias("__mean"), F.sum(F.col("value") * F.col("value")).alias("__sq")))
    size = centre.count()
    wide = min(k + spare, size)
    q = _columns("q", wide)
    start = centre.select("idx", "__mean", *[(F.pmod(F.xxhash64("idx", F.lit(c)), F.lit(2_000_003)) / 1_000_001.5 - 1.0).alias(q[c]) for c in range(wide)])
    directions = cut_lineage(_orthonormal(start, ["idx", "__mean"], q, "q"))
    for turn in range(rounds + 1):
        shift = directions.agg(*[F.sum(F.col("__mean") * F.col(c)).alias(c) for c in q]).first()
        y = (rows.join(directions, "idx").groupBy(key)
             .agg(*[(F.sum(F.col("value") * F.col(c)) - F.lit(float(shift[c] or 0.0))).alias(f"y{i}") for i, c in enumerate(q)]))
        y = cut_lineage(y)
        rest = n_users - y.count()  # users without entries stand at minus the shift
        if turn == rounds:
            break
        z = rows.join(y, key).groupBy("idx").agg(*[F.sum(F.col("value") * F.col(f"y{i}")).alias(q[i]) for i in range(wide)])
        # the rows of the centred matrix are entries less the mean user; scores of all users add up to 0, so the
        # mean's part vanishes
        directions = cut_lineage(_orthonormal(z.join(centre.select("idx", "__mean"), "idx"), ["idx", "__mean"], q, "q"))
    ys = _columns("y", wide)
    at = np.array([float(shift[c] or 0.0) for c in q])
    w, v = np.linalg.eigh(_gram(y, ys) + rest * np.outer(at, at))
    top = v[:, np.argsort(-w)[:k]]
    loadings = cut_lineage(_rotate(directions, ["idx"], q, top, "pc"))
    found = top.shape[1]
    signs = loadings.agg(*[F.max_by(F.signum(f"pc{c}"), F.abs(f"pc{c}")) for c in range(found)]).first()
    sign = np.array([s or 1.0 for s in signs])
    names = [f"pc{c + 1}" for c in range(found)]
    loadings = _rotate(loadings, ["idx"], _columns("pc", found), np.diag(sign), "pc").toDF("idx", *names)
    scores = _rotate(y, [key], ys, top * sign, "pc").toDF(key, *names)
    none = (-at @ top) * sign
    if rest:
        spark = rows.sparkSession
        scores = scores.unionByName(spark.createDataFrame([(None, *map(float, none))], scores.schema))
    total = centre.agg(F.sum(F.col("__sq") - F.lit(float(n_users)) * F.col("__mean") * F.col("__mean"))).first()[0]
    ratios = [float(x / total) if total else 0.0 for x in np.sort(w)[::-1][:k]]
    return scores, loadings, ratios


def pca_profile(rows: DataFrame, key: str, names: DataFrame, n_users: int, k: int = 4, rounds: int = 15) -> tuple[DataFrame, DataFrame]:
    """Scores, and contributions (component, variable, contribution in percent, explained variance ratio) as
    ``segments.pca_profile`` gives them for the wide form."""
    scores, loadings, ratios = _components(rows, key, n_users, k, rounds, 4)
    long = loadings.unpivot(["idx"], [c for c in loadings.columns if c != "idx"], "pc", "loading")
    component = F.substring("pc", 3, 9).cast("int")
    ratio = F.element_at(F.array(*[F.lit(r) for r in ratios]), component)
    return scores, long.join(names, "idx").select(component.alias("component"), F.col("name").alias("variable"),
                                                  (100.0 * F.col("loading") * F.col("loading")).alias("contribution"),
                                                  ratio.alias("explained_variance"))


def kmeans(features: DataFrame, key: str, ks: Sequence[int], max_iter: int = 10, seed: int = 123) -> tuple[DataFrame, dict[int, KMeansModel]]:
    """M3 on sparse vectors: (k, wss) rows and the models."""
    return segments.kmeans_of(features, "features", ks, max_iter, seed)
