"""Estimator choice, fitting and hyper-parameter search with MLlib, for one large table; fleets train in ``trees`` and ``linear``."""

from __future__ import annotations

import itertools
import random
import time
from collections.abc import Sequence
from typing import Any

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliospark import config
from heliospark.models.linear import ridge_estimator
from heliospark.operators.splits import fold_sides, time_series_folds
from heliospark.sources.intermediate import materialize

PREDICTION = "prediction"


def estimator(kind: str, df: DataFrame, params: dict[str, Any] | None = None, target: str = "generation_kwh"):
    """The configured estimator of a kind, with parameters overriding its defaults."""
    params = {k: v for k, v in (params or {}).items() if k != "minInstancesToSplit"}  # unknown to MLlib
    if kind == "ridge":
        return ridge_estimator(df, params.get("alpha", config.RIDGE_ALPHA), target)
    if kind == "forest":
        return RandomForestRegressor(labelCol=target, seed=config.SEED, **{**config.FOREST, **params})
    if kind == "boosting":
        return GBTRegressor(labelCol=target, seed=config.SEED, **{**config.BOOSTING, **params})
    if kind == "subsampled_boosting":
        return GBTRegressor(labelCol=target, seed=config.SEED, **{**config.SUBSAMPLED_BOOSTING, **params})
    raise ValueError(f"unknown model kind: {kind}")


def fit(df: DataFrame, kind: str, features: Sequence[str], params: dict[str, Any] | None = None,
        target: str = "generation_kwh") -> PipelineModel:
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    return Pipeline(stages=[assembler, estimator(kind, df, params, target)]).fit(df)


def timed_fit(df: DataFrame, kind: str, features: Sequence[str], params: dict[str, Any] | None = None,
              target: str = "generation_kwh") -> tuple[PipelineModel, float]:
    start = time.perf_counter()
    model = fit(df, kind, features, params, target)
    return model, time.perf_counter() - start


def predict(model: PipelineModel, df: DataFrame, output: str = PREDICTION) -> DataFrame:
    scored = model.transform(df).drop("features")
    return scored if output == PREDICTION else scored.withColumnRenamed(PREDICTION, output)


def grid_points(grid: dict[str, list], n_iter: int | None = None, seed: int = config.SEED) -> list[dict[str, Any]]:
    """All combinations of a grid, or a seeded sample of them."""
    names = list(grid)
    points = [dict(zip(names, values)) for values in itertools.product(*grid.values())]
    if n_iter is None or n_iter >= len(points):
        return points
    return random.Random(seed).sample(points, n_iter)


def tune(df: DataFrame, kind: str, features: Sequence[str], grid: dict[str, list], n_iter: int | None = None,
         splits: int = config.CV_SPLITS, target: str = "generation_kwh") -> tuple[PipelineModel, dict[str, Any], list[tuple]]:
    """Pick the grid point with the lowest mean absolute error over expanding folds and refit on all rows.

    Folds are computed once and written; each fit and each evaluation is a distributed job over them.
    """
    columns = ["plant_id", "generation_date", target, *features]
    folded = materialize(time_series_folds(df.select(*columns), splits), "folds")
    judge = RegressionEvaluator(labelCol=target, predictionCol=PREDICTION, metricName="mae")
    trials = []
    for params in grid_points(grid, n_iter):
        errors = []
        for fold in range(1, splits + 1):
            train, test = fold_sides(folded, fold)
            errors.append(judge.evaluate(fit(train, kind, features, params, target).transform(test)))
        trials.append((params, sum(errors) / splits))
    best = min(trials, key=lambda trial: trial[1])[0]
    return fit(folded, kind, features, best, target), best, trials


def importances(model: PipelineModel, features: Sequence[str], spark, top: int | None = None) -> DataFrame:
    """Feature importances of a tree model, strongest first, all or the ``top`` ones."""
    weights = model.stages[-1].featureImportances.toArray().tolist()
    table = spark.createDataFrame(list(zip(features, weights)), "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature").limit(top or len(features))
