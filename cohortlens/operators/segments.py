"""User-base segmentation: PCA profile, k-means sweep, cluster assignment and profile
(SURVEY M2-M4, A10). Spark ML on all rows (no down-sampling); features are assembled and cached once."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import round_half_up


def cluster_profile(df: DataFrame, label: str, cols: Sequence[str], digits: int = 2) -> DataFrame:
    """A10 + J7: size and rounded means per cluster in a single aggregate (no count/mean join)."""
    return df.groupBy(label).agg(
        F.count(F.lit(1)).alias("n"),
        *[round_half_up(F.avg(c), digits).alias(c) for c in cols])


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    """M0: dense vector of declared columns; invalid values raise."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="error").transform(df)


def pca_profile(df: DataFrame, cols: Sequence[str], k: int = 4, key: str = "s", color: str | None = "vip"):
    """M2: principal components of the (scaled) columns on all rows.

    Returns (scores DataFrame: key, color, pc1..pck; contributions DataFrame: component, variable,
    contribution in percent = 100 x loading^2, explained variance ratio). The data are centred first
    (``StandardScaler(withMean=True, withStd=False)``) because Spark's PCA transform does not centre."""
    x = assemble(df, cols, "_x")
    centred = StandardScaler(inputCol="_x", outputCol="_xc", withMean=True, withStd=False).fit(x).transform(x)
    model = PCA(k=k, inputCol="_xc", outputCol="_pc").fit(centred)
    keep = [key] + ([color] if color else [])
    scores = model.transform(centred).select(*keep, *[vector_to_array("_pc")[i].alias(f"pc{i + 1}") for i in range(k)])
    pcs = model.pc.toArray()  # p x k loadings (a p x k matrix on the driver; p = number of columns)
    var = model.explainedVariance.toArray()
    rows = [(j + 1, c, float(100.0 * pcs[i, j] ** 2), float(var[j])) for j in range(k) for i, c in enumerate(cols)]
    contrib = df.sparkSession.createDataFrame(rows, "component int, variable string, contribution double, explained_variance double")
    return scores, contrib


def kmeans_sweep(df: DataFrame, cols: Sequence[str], ks: Sequence[int] = tuple(range(3, 13)), max_iter: int = 10,
                 seed: int = 123, parallelism: int | None = None) -> tuple[DataFrame, dict[int, KMeansModel]]:
    """M3: within-cluster sum of squares for each k. One distributed fit per k on the persisted feature
    vectors; the fits are independent, so they are submitted concurrently (the reference ran them
    serially for lack of memory). Returns (k, wss) rows and the fitted models."""
    return kmeans_of(assemble(df, cols), "features", ks, max_iter, seed, parallelism)


def kmeans_of(df: DataFrame, features: str, ks: Sequence[int], max_iter: int = 10, seed: int = 123,
              parallelism: int | None = None) -> tuple[DataFrame, dict[int, KMeansModel]]:
    """``kmeans_sweep`` of a vector column, dense or sparse."""
    x = df.select(features).persist(StorageLevel.MEMORY_AND_DISK)

    def fit(k):
        m = KMeans(k=k, maxIter=max_iter, seed=seed, featuresCol=features).fit(x)
        return k, m

    try:
        workers = parallelism or min(len(ks), 16)  # one fit per k at once by default
        with ThreadPoolExecutor(max_workers=max(1, workers)) as pool:
            models = dict(pool.map(fit, ks))
    finally:
        x.unpersist()
    rows = [(k, float(models[k].summary.trainingCost)) for k in ks]
    return df.sparkSession.createDataFrame(rows, "k int, wss double"), models


def elbow(wss_rows: Sequence[tuple[int, float]]) -> int:
    """Elbow of a decreasing WSS curve: the k with the largest second difference."""
    pts = sorted(wss_rows)
    if len(pts) < 3:
        return pts[0][0]
    best, best_k = -float("inf"), pts[1][0]
    for (k0, w0), (k1, w1), (k2, w2) in zip(pts, pts[1:], pts[2:]):
        d2 = (w0 - w1) - (w1 - w2)
        if d2 > best:
            best, best_k = d2, k1
    return best_k


def assign_clusters(df: DataFrame, cols: Sequence[str], model: KMeansModel, label: str = "cluster") -> DataFrame:
    """M4: cluster label per row; the row keeps its key (no positional glue, SURVEY Q25)."""
    out = model.transform(assemble(df, cols, model.getFeaturesCol()))
    return out.drop(model.getFeaturesCol()).withColumnRenamed(model.getPredictionCol(), label)
