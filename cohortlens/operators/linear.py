"""Linear models of long-term value.

All fits come from triangular QR factors: one pass for the means of every column and response, one in which each task
reduces its centred rows to a p x p triangle (``tall-skinny QR``), kept per fold where folds are asked for; triangles are
then stacked and factored again, sixteen at a time, until one is left. p x p numbers per fold reach the driver, never
rows. Coefficients, standard errors, R2, AIC, variance inflation and the held-out error of every fold and specification
are solved from the same triangles, so any number of specifications costs two passes. The triangle has the condition of
the data, where cross products have its square: columns that agree in all but the last eight digits still give
coefficients. Aliased (collinear) columns are removed in input order with the tolerance of R's ``lm``.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Triangles that are stacked into one in each step of the reduction.
FAN_IN = 16
#: A column of which earlier ones leave less than this share of its length is aliased.
TOLERANCE = 1e-7


def _response(label: str, log_label: bool) -> Column:
    return F.log(F.col(label)) if log_label else F.col(label).cast("double")


def triangle_of(parts: Iterable[np.ndarray], k: int) -> np.ndarray:
    """The k x k triangular factor of stacked matrices; its diagonal is not negative."""
    rows = [np.zeros((k, k)), *parts]
    r = np.linalg.qr(np.vstack(rows), mode="r")
    return r * np.where(np.diag(r) < 0, -1.0, 1.0)[:, None]


@dataclass
class Moments:
    """Triangular factors of [1, centred columns] in total and per group, and the columns' means. ``r.T @ r`` are the
    cross products."""

    names: list[str]
    means: np.ndarray
    total: np.ndarray
    groups: dict

    def index(self, names: Sequence[str]) -> list[int]:
        return [self.names.index(c) + 1 for c in names]

    def without(self, group) -> np.ndarray:
        """The factor of all rows but those of a group: of the other groups' stacked triangles."""
        return triangle_of([r for g, r in self.groups.items() if g != group], len(self.names) + 1)


_TRIANGLE = "_g long, part long, r array<double>"


def _emit(triangles: dict, part: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {"_g": list(triangles), "part": [part] * len(triangles), "r": [r.ravel().tolist() for r in triangles.values()]},
        schema=pa.schema([("_g", pa.int64()), ("part", pa.int64()), ("r", pa.list_(pa.float64()))]))


def _factor_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One triangle per group for all rows of a task; holds a batch and the triangles."""
    triangles: dict = {}
    for batch in batches:
        group = batch.column("_g").to_numpy(zero_copy_only=False)
        x = np.column_stack([np.ones(batch.num_rows)] + [c.to_numpy(zero_copy_only=False) for n, c in zip(batch.schema.names, batch.columns) if n != "_g"])
        for g in np.unique(group):
            have = [triangles[g]] if g in triangles else []
            triangles[g] = triangle_of([*have, x[group == g]], x.shape[1])
    if triangles:
        yield _emit(triangles, TaskContext.get().partitionId())


def _merge_task(table: pa.Table) -> pa.Table:
    """The triangles of a few tasks as one."""
    k = math.isqrt(len(table.column("r")[0]))
    r = triangle_of([np.array(x).reshape(k, k) for x in table.column("r").to_pylist()], k)
    return pa.Table.from_batches([_emit({table.column("_g")[0].as_py(): r}, table.column("part")[0].as_py() // FAN_IN)])


def triangles(rows: DataFrame) -> dict:
    """Group -> triangular factor of [1, columns] of ``rows`` (``_g`` long, then double columns without nulls)."""
    parts = cut_lineage(rows.mapInArrow(_factor_task, _TRIANGLE))
    while (parts.agg(F.max("part")).first()[0] or 0) > 0:
        parts = cut_lineage(parts.groupBy("_g", F.expr(f"part div {FAN_IN}")).applyInArrow(_merge_task, _TRIANGLE))
    out = {}
    for row in parts.collect():  # one per group
        k = math.isqrt(len(row["r"]))
        out[row["_g"]] = np.array(row["r"]).reshape(k, k)
    return out


def moments(df: DataFrame, features: Sequence[str], responses: Mapping[str, tuple[str, bool]] | None = None,
            group: str | None = None) -> Moments:
    """Factors of ``features`` and of ``responses`` (name -> (label, log)); nulls are an error, as in a model fit. ``group``
    names an integer column of a few values."""
    responses = dict(responses or {})
    names = list(dict.fromkeys(features)) + list(responses)
    key = F.col(group).cast("long").alias("_g") if group else F.lit(0).cast("long").alias("_g")
    x = df.select(key, *[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(names[:len(names) - len(responses)])],
                  *[_response(*r).alias(f"_{i}") for i, r in enumerate(responses.values(), len(names) - len(responses))])
    k = len(names)
    first = x.agg(F.count(F.lit(1)).alias("n"), *[F.avg(f"_{i}").alias(f"m{i}") for i in range(k)],
                  *[F.count(f"_{i}").alias(f"c{i}") for i in range(k)]).first()
    missing = [c for i, c in enumerate(names) if first[f"c{i}"] < first["n"]]
    if missing:
        raise ValueError(f"null values in {missing}; fill or filter them before a fit")
    means = np.array([first[f"m{i}"] or 0.0 for i in range(k)])
    groups = triangles(x.select("_g", *[(F.col(f"_{i}") - F.lit(float(means[i]))).alias(f"_{i}") for i in range(k)]))
    return Moments(names, means, triangle_of(groups.values(), k + 1), groups)


def t_two_sided(t: float, df: int) -> float:
    """Two-sided p-value of Student's t: the regularised incomplete beta function at df / (df + t^2), by its continued
    fraction."""
    if df <= 0 or math.isnan(t):
        return float("nan")
    a, b, x = df / 2, 0.5, df / (df + t * t)
    if x >= 1.0:
        return 1.0

    def fraction(a: float, b: float, x: float) -> float:
        c, d = 1.0, 1.0 / (1.0 - (a + b) * x / (a + 1))
        h = d
        for m in range(1, 500):
            for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
                d, c = 1.0 / (1.0 + num * d), 1.0 + num / c
                h *= c * d
            if abs(c * d - 1.0) < 1e-15:
                break
        return h
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) if x > 0 else 0.0
    return front * fraction(a, b, x) / a if x < (a + 1) / (a + b + 2) else 1.0 - front * fraction(b, a, 1 - x) / b


def aliased_from_triangle(r: np.ndarray, cols: Sequence[str], means: Sequence[float] | None = None,
                          tol: float = TOLERANCE) -> list[str]:
    """Aliased columns from the factor of [1, cols]: those of which the intercept and the columns kept before leave less
    than ``tol`` of what the intercept alone leaves. A column whose spread is within rounding of its mean (``means``, if
    the columns were centred) is constant, so collinear with the intercept."""
    n = abs(r[0, 0])  # square root of the number of rows
    basis: list[np.ndarray] = []
    dropped: list[str] = []
    for j, name in enumerate(cols, 1):
        mean = r[0, j] / n if n else 0.0
        c = np.array(r[1:, j])  # what the intercept leaves
        size = float(np.linalg.norm(c))
        scale = max(abs(mean), abs(means[j - 1]) if means is not None else 0.0)
        rest = c
        for _ in range(2):  # the second time takes away what rounding left
            for q in basis:
                rest = rest - (q @ rest) * q
        left = float(np.linalg.norm(rest))
        if size <= 1e-13 * scale * n or left <= tol * size:
            dropped.append(name)
        else:
            basis.append(rest / left)
    return dropped


def aliased_columns(df: DataFrame, cols: Sequence[str], tol: float = TOLERANCE) -> list[str]:
    """Columns that are linear combinations of the intercept and earlier columns (input order)."""
    m = moments(df, cols)
    return aliased_from_triangle(m.total, cols, m.means, tol)


@dataclass
class LinearFit:
    """Least-squares fit with intercept, solved from a triangular factor."""

    label: str
    log_label: bool
    features: list[str]
    dropped: list[str]
    coef: np.ndarray
    intercept: float
    std_errors: np.ndarray
    n: int
    rss: float
    tss: float

    @property
    def response(self) -> str:
        return f"log({self.label})" if self.log_label else self.label

    def summary_row(self, name: str) -> tuple:
        p = len(self.features)
        r2 = 1.0 - self.rss / self.tss if self.tss else float("nan")
        adj = 1.0 - (1.0 - r2) * (self.n - 1) / (self.n - p - 1) if self.n - p - 1 > 0 else float("nan")
        aic = self.n * (math.log(2 * math.pi * self.rss / self.n) + 1) + 2 * (p + 2) if self.rss > 0 else float("-inf")
        return (name, self.response, float(r2), float(adj), float(aic), self.n, p)

    def coefficients(self, spark, marker: str = "Distr") -> DataFrame:
        """Term, estimate, std_error, statistic, p_value and the transformed estimate:
        ``(exp(b) - 1) * 100`` (percent change), or ``exp(b) - 1`` for share terms containing
        ``marker``; intercept excluded, share terms last (U2)."""
        rows = []
        for i, term in enumerate(self.features):
            b, se = float(self.coef[i]), float(self.std_errors[i])
            t = b / se if se else float("nan")
            tr = math.exp(b) - 1 if marker in term else (math.exp(b) - 1) * 100
            rows.append((term, b, tr, se, t, t_two_sided(t, self.n - len(self.features) - 1), int(marker in term)))
        df = spark.createDataFrame(rows, "term string, estimate double, transformed_estimate double, std_error double, "
                                         "statistic double, p_value double, is_share int")
        return df.orderBy("is_share", "term").drop("is_share")

    def predict(self, df: DataFrame, name: str = "prediction", back_transform: bool = True, smearing: float = 1.0) -> DataFrame:
        """Predictions; for log-response models ``exp(pred)`` (times the smearing factor)."""
        pred = F.lit(float(self.intercept))
        for c, b in zip(self.features, self.coef, strict=True):
            pred = pred + F.lit(float(b)) * F.col(c).cast("double")
        return df.withColumn(name, F.exp(pred) * smearing if (self.log_label and back_transform) else pred)

    def smearing_factor(self, df: DataFrame) -> float:
        """Duan's smearing estimate ``mean(exp(residual))`` for log models (option, SURVEY Q24)."""
        scored = self.predict(df, "_p", back_transform=False)
        y = F.log(F.col(self.label)) if self.log_label else F.col(self.label)
        return float(scored.agg(F.avg(F.exp(y - F.col("_p")))).first()[0])

    def effect_size(self, column: str, frm: float = 0.0, to: float = 1.0, transform: bool = True,
                    derived: bool = False, squares: Mapping[str, str] | None = None,
                    interactions: Mapping[str, tuple[str, str]] | None = None,
                    at: Mapping[str, float] | None = None) -> dict:
        """Change of the response when ``column`` moves from ``frm`` to ``to``, others fixed.

        Default (as the analysis did, SURVEY Q18): derived squared / product columns are separate
        regressors, so the effect is that single coefficient times the step. ``derived=True`` also moves
        the derived columns: ``b_sq (to^2 - frm^2)`` for ``squares[column]`` and ``b_xz z (to - frm)`` for
        each interaction with another column ``z``, evaluated at ``at[z]`` (e.g. ``typical_values``).
        ``transform`` gives the percent change for log models."""
        coef = dict(zip(self.features, map(float, self.coef)))
        slope = coef.get(column, 0.0) * (to - frm)
        if derived:
            sq = (squares or {}).get(column)
            if sq:
                slope += coef.get(sq, 0.0) * (to * to - frm * frm)
            for name, (a, b) in (interactions or {}).items():
                if column in (a, b):
                    other = b if a == column else a
                    slope += coef.get(name, 0.0) * float((at or {}).get(other, 0.0)) * (to - frm)
        out = {"variable": column, "from": float(frm), "to": float(to), "slope": slope, "pct_change": None}
        if transform and self.log_label:
            out["pct_change"] = (math.exp(slope) - 1) * 100
        return out


def typical_values(df: DataFrame, cols: Sequence[str], accuracy: int = 10_000) -> dict[str, float]:
    """Approximate medians of several columns in one aggregate (for ``effect_size(derived=True)``)."""
    r = df.agg(*[F.percentile_approx(F.col(c).cast("double"), 0.5, accuracy).alias(c) for c in cols]).first()
    return {c: float(r[c]) for c in cols}


def solve(m: Moments, features: Sequence[str], response: str, label: str, log_label: bool, r: np.ndarray | None = None,
          drop_aliased: bool = True) -> LinearFit:
    """The fit of ``response`` on ``features`` from the factor ``r`` (default: of all rows)."""
    r = m.total if r is None else r
    at = m.index(features)
    known = [m.means[i - 1] for i in at]
    dropped = aliased_from_triangle(triangle_of([r[:, [0, *at]]], len(at) + 1), list(features), known) if drop_aliased else []
    feats = [c for c in features if c not in dropped]
    idx, y = [0, *m.index(feats)], m.index([response])[0]
    p = len(idx)
    t = triangle_of([r[:, [*idx, y]]], p + 1)  # columns, then the response: its last entry is the length of the residuals
    unit = np.maximum(np.linalg.norm(t[:, :p], axis=0), 1e-300)
    inverse = np.linalg.inv(t[:p, :p] / unit)
    b = (inverse @ t[:p, p]) / unit
    n = int(round(r[0, 0] ** 2))
    rss = float(t[p, p] ** 2)
    left = n - p
    se = np.linalg.norm(inverse, axis=1) / unit * math.sqrt(rss / left if left > 0 else float("nan"))
    mean = m.means[[i - 1 for i in idx[1:]]]
    return LinearFit(label, log_label, feats, dropped, b[1:], float(b[0] - b[1:] @ mean + m.means[y - 1]), se[1:], n, rss,
                     float(triangle_of([r[:, [0, y]]], 2)[1, 1] ** 2))


def fit_linear(df: DataFrame, features: Sequence[str], label: str, log_label: bool = False,
               drop_aliased: bool = True) -> LinearFit:
    """Least squares with intercept; aliased columns dropped first (input order)."""
    m = moments(df, features, {"_response": (label, log_label)})
    return solve(m, features, "_response", label, log_label, drop_aliased=drop_aliased)


def fit_many(df: DataFrame, specs: Mapping[str, tuple]) -> dict[str, LinearFit]:
    """Several fits from the same two passes: ``specs`` maps a name to ``(features, label, log_label)``."""
    union = [c for features, _, _ in specs.values() for c in features]
    responses = {f"_{label}_{log}": (label, log) for _, label, log in specs.values()}
    m = moments(df, union, responses)
    return {name: solve(m, features, f"_{label}_{log}", label, log) for name, (features, label, log) in specs.items()}


def compare_fits(spark, fits: Mapping[str, LinearFit]) -> DataFrame:
    """M11 comparison table (model, response, r2, adj_r2, aic, n, p). AIC of log and raw responses
    are not comparable; the ``response`` column says which is which (SURVEY Q17)."""
    rows = [f.summary_row(name) for name, f in fits.items()]
    return spark.createDataFrame(rows, "model string, response string, r2 double, adj_r2 double, aic double, n int, p int")


def vif(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Variance inflation factors = diagonal of the inverse correlation matrix (p x p on the driver), from the inverse
    of the triangle of the columns scaled to unit length."""
    r = moments(df, features).total
    c = triangle_of([r[1:, 1:]], len(features))
    inv = np.linalg.pinv(c / np.maximum(np.linalg.norm(c, axis=0), 1e-300))
    return df.sparkSession.createDataFrame([(f, float(inv[i] @ inv[i])) for i, f in enumerate(features)], "variable string, vif double")


def linear_cv(df: DataFrame, specs: Mapping[str, Sequence[str]], label: str, log_label: bool = True, k: int = 10,
              fold_col: str = "fold") -> tuple[DataFrame, DataFrame]:
    """K-fold RMSE of every specification (hash folds in ``fold_col``), all from the triangles per fold: a training
    split's is that of the other folds' triangles, and the held-out error is the length of the fold's triangle times
    (coefficients, -1). Returns (per-fold rows: model, fold, rmse; summary: model, rmse = mean over folds)."""
    m = moments(df, [c for cols in specs.values() for c in cols], {"_response": (label, log_label)}, fold_col)
    y, rows = m.index(["_response"])[0], []
    for f in range(k):
        held = m.groups.get(f)
        rest = m.without(f) if held is not None else None
        for name, cols in specs.items():
            if held is None:
                rows.append((name, f, float("nan")))
                continue
            fit = solve(m, list(cols), "_response", label, log_label, rest)
            idx = [0, *m.index(fit.features)]
            centred = fit.intercept + fit.coef @ m.means[[i - 1 for i in idx[1:]]] - m.means[y - 1]
            miss = held[:, idx] @ np.concatenate([[centred], fit.coef]) - held[:, y]
            rows.append((name, f, math.sqrt(float(miss @ miss)) / abs(float(held[0, 0]))))
    per_fold = df.sparkSession.createDataFrame(rows, "model string, fold int, rmse double")
    return per_fold, per_fold.groupBy("model").agg(F.avg("rmse").alias("rmse"))
