"""Two-part ("hurdle") revenue model: P(spender) x amount, with the reference's decision rule
(SURVEY M0 M5-M8 M18 O2 A14 A15).

The rule is a column expression, so scoring stays in the JVM after the two Spark ML models have added
their outputs. Fitting uses Spark ML gradient-boosted trees (distributed); cross-validation submits
independent fits from a small thread pool (as ``CrossValidator(parallelism=...)`` does) on one checkpointed,
assembled frame, and only metric rows come back to the driver.
"""

from __future__ import annotations

import json
import os
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import round_half_up
from ..session import cut_lineage


# ---- decision rules (M5, SURVEY Q9 Q29) ---------------------------------------------------------

def hurdle_prediction(observed: Column, p: Column, amount: Column, hurdle: float) -> Column:
    """Observed early spend -> amount; else p > hurdle -> amount; else p x amount."""
    return F.when(observed > 0, amount).when(p > hurdle, amount).otherwise(p * amount)


def product_prediction(observed: Column, p: Column, amount: Column) -> Column:
    """Observed early spend -> amount; else p x amount."""
    return F.when(observed > 0, amount).otherwise(p * amount)


def threshold_prediction(p: Column, amount: Column) -> Column:
    """p < 0.5 -> 0; negative amounts floored at 0."""
    return F.when(p < 0.5, F.lit(0.0)).when(amount < 0, F.lit(0.0)).otherwise(amount)


RULES = ("hurdle", "product", "threshold")


# ---- metrics (A14 A15 O2 R5) --------------------------------------------------------------------

def error_metrics(df: DataFrame, actual: str, predicted: str, keys: Sequence[str], digits: int | None = 6) -> DataFrame:
    """RMSE and MAE per group."""
    err = F.col(actual) - F.col(predicted)
    rmse = F.sqrt(F.avg(err * err))
    mae = F.avg(F.abs(err))
    if digits is not None:
        rmse, mae = round_half_up(rmse, digits), round_half_up(mae, digits)
    return df.groupBy(*keys).agg(rmse.alias("rmse"), mae.alias("mae"), F.count(F.lit(1)).alias("n"))


def summarise_settings(per_fold: DataFrame, digits: int = 6) -> DataFrame:
    """A15 + R5: mean RMSE over folds per (model setting, hurdle); names like
    ``nrounds=25_eta=0.05|hurdle_10_pct`` are separated into typed columns."""
    parts = F.split("setting", r"\|")
    model_name, hurdle_name = F.get(parts, 0), F.get(parts, 1)
    mparts = F.split(model_name, "_")
    s = per_fold.select(
        F.get(F.split(F.get(mparts, 0), "="), 1).cast("int").alias("nrounds"),
        F.get(F.split(F.get(mparts, 1), "="), 1).cast("double").alias("eta"),
        F.get(F.split(hurdle_name, "_"), 1).cast("double").alias("hurdle_pct"),
        "rmse")
    out = s.groupBy("nrounds", "eta", "hurdle_pct").agg(round_half_up(F.avg("rmse"), digits).alias("rmse"))
    return out.orderBy("rmse", "nrounds", "eta", "hurdle_pct")  # O1, on the small per-setting table


def best_setting(summary: DataFrame) -> DataFrame:
    """O2: the lowest RMSE; ties resolved by (nrounds, eta, hurdle_pct) so exactly one row remains.
    The input is the small per-setting summary."""
    return summary.orderBy("rmse", "nrounds", "eta", "hurdle_pct").limit(1)


# ---- estimator (M0 M5 M7 M8 M18) ----------------------------------------------------------------

@dataclass
class HurdleSpec:
    classifier_features: list[str]
    regressor_features: list[str]
    label: str
    observed: str
    spender: str = "spender"
    nrounds: int = 50
    eta: float = 0.1
    max_depth: int = 6
    hurdle: float = 0.2
    seed: int = 42
    spenders_only: bool = False
    meta: dict = field(default_factory=dict)


def assembled(df: DataFrame, spec: HurdleSpec) -> DataFrame:
    """``df`` with the input vectors of both parts and the classifier's label, unless it has them already."""
    if "_clf_x" in df.columns:
        return df
    x = VectorAssembler(inputCols=spec.classifier_features, outputCol="_clf_x", handleInvalid="error").transform(df)
    x = VectorAssembler(inputCols=spec.regressor_features, outputCol="_reg_x", handleInvalid="error").transform(x)
    return x.withColumn("_spender_label", F.col(spec.spender).cast("double")) if spec.spender in df.columns else x


class HurdleModel(Model):
    """Fitted two-part model (a ``pyspark.ml`` Model: usable as a Pipeline stage)."""

    def __init__(self, spec: HurdleSpec, classifier: GBTClassificationModel, regressor: GBTRegressionModel):
        super().__init__()
        self.spec, self.classifier, self.regressor = spec, classifier, regressor

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.predict_with(dataset)

    def raw(self, df: DataFrame) -> DataFrame:
        """Adds ``p_spender`` and ``amount`` (temporary vector columns are dropped)."""
        x = assembled(df, self.spec).drop("_spender_label")
        x = self.classifier.transform(x)
        x = x.withColumn("p_spender", vector_to_array(F.col("_clf_prob"))[1])
        x = self.regressor.transform(x)
        return x.drop("_clf_x", "_reg_x", "_clf_prob", "_clf_raw", "_clf_pred").withColumnRenamed("_amount", "amount")

    def predict_with(self, df: DataFrame, rule: str = "hurdle", hurdle: float | None = None,
                     name: str = "prediction") -> DataFrame:
        """Adds ``p_spender``, ``amount`` and the prediction of ``rule`` (hurdle / product / threshold)."""
        x = self.raw(df)
        o, p, a = F.col(self.spec.observed), F.col("p_spender"), F.col("amount")
        if rule == "hurdle":
            pred = hurdle_prediction(o, p, a, self.spec.hurdle if hurdle is None else hurdle)
        elif rule == "product":
            pred = product_prediction(o, p, a)
        else:
            pred = threshold_prediction(p, a)
        return x.withColumn(name, pred)

    def prefix_scores(self, df: DataFrame, sizes) -> DataFrame:
        """``p_spender_<n>`` and ``amount_<n>`` from the first ``n`` trees of both ensembles, for every n in
        ``sizes``. With no subsampling a boosted ensemble is built tree by tree, so its first n trees are
        exactly the model fitted with n rounds: one fit with max(n) rounds serves the whole nrounds grid.
        Uses the public ``trees`` / ``treeWeights`` of the fitted models (JVM tree evaluation, no Python)."""
        x = assembled(df, self.spec)
        top = max(sizes)
        for tag, model, fcol in (("c", self.classifier, "_clf_x"), ("r", self.regressor, "_reg_x")):
            for i, tree in enumerate(model.trees[:top]):
                x = tree.setFeaturesCol(fcol).setPredictionCol(f"_{tag}{i}").transform(x)
        cw, rw = self.classifier.treeWeights, self.regressor.treeWeights
        new = {}
        for n in sizes:
            margin = sum((F.col(f"_c{i}") * float(cw[i]) for i in range(1, n)), F.col("_c0") * float(cw[0]))
            # logistic loss of the boosted classifier: P(y=1) = 1 / (1 + exp(-2 margin))
            new[f"p_spender_{n}"] = 1.0 / (1.0 + F.exp(-2.0 * margin))
            new[f"amount_{n}"] = sum((F.col(f"_r{i}") * float(rw[i]) for i in range(1, n)), F.col("_r0") * float(rw[0]))
        x = x.withColumns(new)
        return x.drop("_clf_x", "_reg_x", *[f"_{t}{i}" for t in "cr" for i in range(top)])

    def feature_importance(self, spark) -> DataFrame:
        """Importance of every input of both trees, long form (model, feature, importance)."""
        rows = [("classifier", f, float(v)) for f, v in zip(self.spec.classifier_features, self.classifier.featureImportances.toArray())]
        rows += [("regressor", f, float(v)) for f, v in zip(self.spec.regressor_features, self.regressor.featureImportances.toArray())]
        return spark.createDataFrame(rows, "model string, feature string, importance double")

    # Model directory = two Spark ML models + JSON metadata
    def save(self, path: str) -> None:
        self.classifier.write().overwrite().save(os.path.join(path, "classifier"))
        self.regressor.write().overwrite().save(os.path.join(path, "regressor"))
        from pyspark.sql import SparkSession
        ss = SparkSession.getActiveSession()
        meta = json.dumps(asdict(self.spec))
        ss.createDataFrame([(meta,)], "spec string").coalesce(1).write.mode("overwrite").json(os.path.join(path, "spec"))

    @classmethod
    def load(cls, path: str) -> "HurdleModel":
        from pyspark.sql import SparkSession
        ss = SparkSession.getActiveSession()
        meta = json.loads(ss.read.json(os.path.join(path, "spec")).first()["spec"])
        return cls(HurdleSpec(**meta), GBTClassificationModel.load(os.path.join(path, "classifier")),
                   GBTRegressionModel.load(os.path.join(path, "regressor")))


class HurdleRegressor(Estimator):
    """Estimator (``pyspark.ml``): a GBT classifier of ``spender`` and a GBT regressor of ``label``."""

    def __init__(self, spec: HurdleSpec):
        super().__init__()
        self.spec = spec

    def _fit(self, df: DataFrame) -> HurdleModel:
        s = self.spec
        x = assembled(df, s)
        clf = GBTClassifier(featuresCol="_clf_x", labelCol="_spender_label", maxIter=s.nrounds, stepSize=s.eta,
                            maxDepth=s.max_depth, seed=s.seed, predictionCol="_clf_pred", maxMemoryInMB=1024, checkpointInterval=10)
        clf.setProbabilityCol("_clf_prob").setRawPredictionCol("_clf_raw")
        reg = GBTRegressor(featuresCol="_reg_x", labelCol=s.label, maxIter=s.nrounds, stepSize=s.eta,
                           maxDepth=s.max_depth, seed=s.seed, predictionCol="_amount", maxMemoryInMB=1024, checkpointInterval=10)
        reg_data = x.where(F.col(s.spender)) if s.spenders_only else x
        # the two parts are independent: fit them concurrently
        with ThreadPoolExecutor(max_workers=2) as pool:
            c, r = pool.submit(clf.fit, x), pool.submit(reg.fit, reg_data)
            return HurdleModel(s, c.result(), r.result())


def hurdle_cv(train: DataFrame, base: HurdleSpec, folds: int, nrounds: Sequence[int], etas: Sequence[float],
              hurdles: Sequence[float], fold_col: str = "fold", parallelism: int = 4) -> DataFrame:
    """M6: one fit per (fold, eta) with max(nrounds) rounds; every nrounds value is evaluated from the
    tree prefixes of that fit and every hurdle from the same two models (5 x 2 fit pairs instead of
    5 x 3 x 2). Fits run concurrently on one checkpointed frame. Returns per-fold metric rows
    (fold, setting, rmse) as a small DataFrame."""
    spark = train.sparkSession
    # vectors are built once for all fits; a checkpoint, not a cache, as every one of a fit's jobs carries its input's lineage
    data = cut_lineage(assembled(train, base))
    sizes = sorted(set(nrounds))
    tasks = [(k, eta) for k in range(folds) for eta in etas]

    def run(task):
        k, eta = task
        spec = HurdleSpec(**{**asdict(base), "nrounds": max(sizes), "eta": eta})
        model = HurdleRegressor(spec).fit(data.where(F.col(fold_col) != k))
        scored = model.prefix_scores(data.where(F.col(fold_col) == k), sizes)
        o = F.col(spec.observed)
        aggs, names = [], []
        for n in sizes:
            for h in hurdles:
                pred = hurdle_prediction(o, F.col(f"p_spender_{n}"), F.col(f"amount_{n}"), h)
                err = F.col(spec.label) - pred
                name = f"nrounds={n}_eta={eta}|hurdle_{h * 100:.10g}_pct"
                aggs.append(F.sqrt(F.avg(err * err)).alias(f"m{len(names)}"))
                names.append(name)
        r = scored.agg(*aggs).first()
        return [(k, name, float(r[f"m{i}"])) for i, name in enumerate(names)]

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        rows = [row for chunk in pool.map(run, tasks) for row in chunk]
    return spark.createDataFrame(rows, "fold int, setting string, rmse double")


def fit_final(train: DataFrame, test: DataFrame, spec: HurdleSpec) -> tuple[HurdleModel, DataFrame]:
    """M7: fit on all training rows, hold-out RMSE / MAE with the same rule as CV and scoring (Q9)."""
    model = HurdleRegressor(spec).fit(train)
    scored = model.transform(test)
    metrics = error_metrics(scored, spec.label, "prediction", [], digits=None)
    return model, metrics
