"""Tree models on the feature table, with Spark ML."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from larder.config import ForecastRules
from larder.operators.baselines import seasonal_naive
from larder.operators.evaluation import METRICS, forecast_metrics
from larder.operators.features import model_features
from larder.operators.folds import cv_folds
from larder.plans.lineage import pin

NAIVE = "SeasonalNaive"
_KEYS = ("stock_code", "date", "quantity", "day_of_week")


def estimator(name: str, seed: int = 42):
    """A model by name.

    All boosters are Spark ML's gradient-boosted trees. ``DeepBoosting`` and
    ``SampledBoosting`` differ from the plain one in depth, leaf size and
    feature sampling.
    """
    common = {"labelCol": "target", "featuresCol": "inputs", "seed": seed}
    if name == "RandomForest":
        return RandomForestRegressor(numTrees=20, maxDepth=6, minInstancesPerNode=5, **common)
    boosting = {"maxIter": 20, "stepSize": 0.05, "subsamplingRate": 0.8} | common
    if name == "GradientBoosting":
        return GBTRegressor(maxDepth=4, **boosting)
    if name == "DeepBoosting":
        return GBTRegressor(
            maxDepth=5, minInstancesPerNode=20, featureSubsetStrategy="0.8", **boosting
        )
    if name == "SampledBoosting":
        return GBTRegressor(maxDepth=4, featureSubsetStrategy="0.8", **boosting)
    raise ValueError(f"unknown model {name!r}")


def feature_names(rules: ForecastRules) -> list[str]:
    return list(rules.features or model_features())


def model_input(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Aligned inputs: missing features become 0, the target is not negative."""
    present = set(df.columns)
    inputs = [
        F.coalesce(F.col(n).cast("double"), F.lit(0.0)).alias(n) if n in present
        else F.lit(0.0).alias(n)
        for n in names
    ]
    kept = [c for c in _KEYS if c in present and c not in names]
    target = F.greatest(F.col("quantity"), F.lit(0.0)) if "quantity" in present else F.lit(0.0)
    return df.select(*kept, *inputs, target.alias("target"))


def _assembler(names: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(names), outputCol="inputs", handleInvalid="keep")


def fit_model(train: DataFrame, name: str, rules: ForecastRules = ForecastRules()) -> PipelineModel:
    names = feature_names(rules)
    stages = [_assembler(names), estimator(name, rules.seed)]
    return Pipeline(stages=stages).fit(model_input(train, names))


def predict(df: DataFrame, model: PipelineModel) -> DataFrame:
    """``stock_code, date, predicted_quantity``, never negative."""
    names = model.stages[0].getInputCols()
    scored = model.transform(model_input(df, names))
    return scored.select(
        "stock_code", "date",
        F.greatest(F.col("prediction"), F.lit(0.0)).alias("predicted_quantity"),
    )


def _fit_all(train: DataFrame, rules: ForecastRules) -> dict[str, Model]:
    """Fit the models on assembled rows side by side, so their many short jobs fill the cluster.

    A fit that fails raises: a comparison that lacks a model would name a wrong best one.
    """

    def fit(name: str) -> Model:
        return estimator(name, rules.seed).fit(train)

    with ThreadPoolExecutor(max_workers=max(1, len(rules.models))) as pool:
        run = inheritable_thread_target(train.sparkSession)(fit)
        return dict(zip(rules.models, pool.map(run, rules.models)))


def cross_validate(
    features: DataFrame, rules: ForecastRules = ForecastRules()
) -> DataFrame:
    """Metrics per model and fold, the seasonal naive forecast included.

    The driver loops over folds and models; each fit and each prediction is a
    Spark job over the whole fold. Inputs are assembled once and a fold's
    predictions are written once. Only the fold dates (one row per fold) are
    brought to the driver, and become plain date filters. A model that fails
    fails the comparison; leave it out of ``rules.models`` to go on without it.
    """
    needed = list(dict.fromkeys([*_KEYS, *feature_names(rules)]))
    names = feature_names(rules)
    kept = [*_KEYS, "target", "inputs"]
    assembled = _assembler(names).transform(
        model_input(features.select(*[c for c in needed if c in features.columns]), names)
    )
    table = pin(assembled.select(*[c for c in kept if c in assembled.columns]))
    folds = cv_folds(table, rules.folds, rules.horizon, rules.min_train_days).collect()
    # One row per model and fold.
    metrics = [
        forecast_metrics(pin(fold_predictions(table, fold, rules)), ["model", "fold"])
        for fold in sorted(folds, key=lambda f: f["fold"])
    ]
    columns = (*METRICS, "MdAPE")
    schema = "model string, fold int, " + ", ".join(f"{m} double" for m in columns)
    rows = [tuple(row[c] for c in ("model", "fold", *columns)) for m in metrics for row in m.collect()]
    return features.sparkSession.createDataFrame(rows, schema)


def fold_predictions(table: DataFrame, fold: Row, rules: ForecastRules) -> DataFrame:
    """``model, fold, stock_code, date, actual, predicted`` of every model for one fold.

    ``table`` has assembled ``inputs``, so no model assembles them again.
    """
    train = table.where(F.col("date") <= F.lit(fold["train_end"]))
    test = table.where(F.col("date").between(fold["test_start"], fold["test_end"]))
    keys, actual = ("stock_code", "date"), F.col("target").alias("actual")
    naive = seasonal_naive(train, test)
    outcome = {NAIVE: naive.select(*keys, F.greatest("quantity", F.lit(0.0)).alias("actual"), "predicted")}
    for name, model in _fit_all(train, rules).items():
        predicted = F.greatest(F.col("prediction"), F.lit(0.0)).alias("predicted")
        outcome[name] = model.transform(test).select(*keys, actual, predicted)
    keyed = [
        rows.withColumns({"model": F.lit(name), "fold": F.lit(fold["fold"]).cast("int")})
        for name, rows in outcome.items()
    ]
    return reduce(DataFrame.unionByName, keyed)


def feature_importance(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """Importance by feature, largest first; as many rows as model inputs."""
    names, values = model.stages[0].getInputCols(), model.stages[-1].featureImportances
    rows = [(name, float(values[i])) for i, name in enumerate(names)]
    table = spark.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature")


def save_model(spark: SparkSession, model: PipelineModel | None, name: str, folder: str) -> None:
    """Store a model and point to it as the best one. The naive forecast has none."""
    if model is not None:
        model.write().overwrite().save(f"{folder}/model_{name}")
    pointer = spark.createDataFrame([(name,)], "model string")
    pointer.write.mode("overwrite").parquet(f"{folder}/best_model")


def best_model_name(spark: SparkSession, folder: str) -> str:
    return spark.read.parquet(f"{folder}/best_model").first()["model"]


def load_best_model(spark: SparkSession, folder: str) -> tuple[str, PipelineModel | None]:
    name = best_model_name(spark, folder)
    if name == NAIVE:
        return name, None
    return name, PipelineModel.load(f"{folder}/model_{name}")
