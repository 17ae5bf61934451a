"""Training all plants: split, impute, fit, evaluate, rank; one failing plant does not stop the rest.

``train_fleet_tables`` trains every plant and kind in a fixed number of jobs and keeps models as tables. ``train_fleet`` fits
MLlib pipelines plant by plant, for a few plants whose rows are too many for one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliospark import config
from heliospark.models.ensembles import predict, timed_fit, tune
from heliospark.models.linear import fit_fleet_ridge
from heliospark.models.trees import fit_fleet_trees, ridge_models, score_models
from heliospark.models.evaluation import rank_models, regression_metrics
from heliospark.operators.features import impute_features
from heliospark.operators.splits import split_train_test
from heliospark.sources.intermediate import materialize

ALL_MODELS = ("ridge", "forest", "boosting", "subsampled_boosting")


@dataclass
class FleetRun:
    metrics: DataFrame | None = None
    models: dict[tuple[int, str], PipelineModel] = field(default_factory=dict)
    params: dict[tuple[int, str], dict] = field(default_factory=dict)
    failures: dict[int, str] = field(default_factory=dict)


def training_rows(features: DataFrame, fleet: DataFrame, columns: Sequence[str], min_test: int = config.MIN_TEST_SAMPLES,
                  split_date=None) -> DataFrame:
    """Feature rows marked train or test, with holes filled inside each side."""
    split = split_train_test(features, fleet, split_date, min_test)
    return impute_features(split, columns, keys=("plant_id", "split"))


def train_fleet(features: DataFrame, fleet: DataFrame, columns: Sequence[str], kinds: Sequence[str] = ALL_MODELS,
                params: dict[str, dict] | None = None, grids: dict[str, dict] | None = None,
                n_iter: int = config.BOUNDED_SEARCH_ITERATIONS, reliable_only: bool = False,
                min_test: int = config.MIN_TEST_SAMPLES, split_date=None) -> FleetRun:
    """Fit the requested kinds per plant and evaluate them on the plant's test side.

    The training rows are written once, laid out by plant, so each MLlib fit reads only its plant.
    With ``grids`` each kind is tuned first. The driver loops over plants: for fleets of thousands use
    ``fit_fleet_ridge``, which fits all plants in one job. A plant that fails is left out whole, with
    the kinds fitted before the failure.
    """
    run = FleetRun()
    chosen = fleet.where("reliable") if reliable_only else fleet
    needed = ["plant_id", "generation_date", "generation_kwh", *columns]
    rows = training_rows(features.select(*needed), fleet, columns, min_test, split_date)
    rows = materialize(rows, "training-rows", ["plant_id"])
    scored = []
    for (plant_id,) in chosen.select("plant_id").collect():
        mine = rows.where(F.col("plant_id") == plant_id)
        train = mine.where(F.col("split") == "train")
        models, used, parts = {}, {}, []
        try:
            for kind in kinds:
                given = (params or {}).get(kind)
                if grids and kind in grids:
                    iterations = None if kind == "ridge" else n_iter
                    _, given, _ = tune(train, kind, columns, grids[kind], iterations)
                model, seconds = timed_fit(train, kind, columns, given)
                models[plant_id, kind] = model
                used[plant_id, kind] = given or {}
                parts.append(predict(model, mine).select(
                    "plant_id", "split", "generation_kwh", "prediction",
                    F.lit(config.MODEL_LABELS[kind]).alias("model"), F.lit(seconds).alias("training_time")))
        except Exception as error:  # noqa: BLE001 - one plant must not stop the fleet
            run.failures[plant_id] = str(error)
            continue
        run.models |= models
        run.params |= used
        scored += parts
    if scored:
        all_rows = reduce(DataFrame.unionByName, scored)
        run.metrics = materialize(
            regression_metrics(all_rows, ("plant_id", "model", "split", "training_time")), "model-metrics")
    return run


@dataclass
class FleetTables:
    """A trained fleet: ``models`` (one plant, kind and block a row) and ``metrics`` by plant, model and split."""
    models: DataFrame
    metrics: DataFrame
    features: list[str]

    @property
    def failures(self) -> DataFrame:
        return self.models.where("error IS NOT NULL").select("plant_id", "kind", "error")

    @property
    def comparison(self) -> DataFrame:
        return self.metrics.where("split = 'test'").drop("split")


def _label(kind: str):
    return F.coalesce(*(F.when(F.col(kind) == k, F.lit(v)) for k, v in config.MODEL_LABELS.items()))


def train_fleet_tables(features: DataFrame, fleet: DataFrame, columns: Sequence[str], kinds: Sequence[str] = ALL_MODELS,
                       params: dict[str, dict] | None = None, reliable_only: bool = False,
                       min_test: int = config.MIN_TEST_SAMPLES, split_date=None) -> FleetTables:
    """Fit the requested kinds for every plant on its train side and measure both sides.

    Training rows, models and metrics are written tables; nothing of a plant reaches the driver. A kind that fails for a
    plant is left out there, with its error in ``models``.
    """
    columns, params = list(columns), params or {}
    needed = ["plant_id", "generation_date", "generation_kwh", *columns]
    rows = training_rows(features.select(*needed), fleet, columns, min_test, split_date)
    if reliable_only:
        rows = rows.join(fleet.where("reliable").select("plant_id"), "plant_id", "left_semi")
    rows = materialize(rows, "training-rows")
    train, parts = rows.where("split = 'train'"), []
    if "ridge" in kinds:
        parts.append(ridge_models(fit_fleet_ridge(train, columns, params.get("ridge", {}).get("alpha", config.RIDGE_ALPHA))))
    if trees := {kind: params.get(kind) for kind in kinds if kind != "ridge"}:
        parts.append(fit_fleet_trees(train, columns, trees))
    models = materialize(reduce(DataFrame.unionByName, parts), "fleet-models")
    scored = score_models(rows, models, columns).where("kind IS NOT NULL")
    metrics = regression_metrics(scored, ("plant_id", "kind", "split")).withColumn("model", _label("kind")).drop("kind")
    seconds = models.groupBy("plant_id", _label("kind").alias("model")).agg(F.sum("seconds").alias("training_time"))
    return FleetTables(models, materialize(metrics.join(seconds, ["plant_id", "model"], "left"), "model-metrics"), columns)


def best_of_fleet(run: FleetTables) -> DataFrame:
    """The models of each plant's best kind by test R2."""
    best = rank_models(run.comparison).where("rank = 1").select("plant_id", "model")
    return run.models.withColumn("model", _label("kind")).join(best, ["plant_id", "model"], "left_semi").drop("model")


def best_models(run: FleetRun) -> dict[int, PipelineModel]:
    """Each plant's best model by test R2; one row per plant reaches the driver, which holds the models anyway."""
    kinds = {label: kind for kind, label in config.MODEL_LABELS.items()}
    best = rank_models(comparison(run)).where("rank = 1").select("plant_id", "model").collect()
    return {row.plant_id: run.models[row.plant_id, kinds[row.model]] for row in best}


def comparison(run: FleetRun) -> DataFrame:
    """Test metrics of a run, ready for ranking and the registry."""
    return run.metrics.where(F.col("split") == "test").drop("split")


def ridge_comparison(scored: DataFrame, label: str = config.MODEL_LABELS["ridge"]) -> DataFrame:
    """Test metrics of single-pass ridge predictions over a split frame."""
    metrics = regression_metrics(scored.where(F.col("split") == "test"), ("plant_id",), prediction="ml_predicted_kwh")
    return metrics.withColumn("model", F.lit(label))
