"""Scored history and forecasts."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliospark import config
from heliospark.functions.numbers import non_negative
from heliospark.models.ensembles import predict
from heliospark.models.linear import score_fleet_ridge
from heliospark.models.trees import score_models
from heliospark.operators.features import add_solar, build_features, impute_features, merge_weather
from heliospark.operators.outlook import forecast_features
from heliospark.plans.training import WEATHER_INPUTS
from heliospark.sources.tables import missing_columns


def scoring_frame(hourly: DataFrame, weather: DataFrame, fleet: DataFrame, columns: list[str]) -> DataFrame:
    """Feature rows of the history with holes filled; weak days stay in."""
    features = build_features(
        merge_weather(hourly, weather.select(*[c for c in WEATHER_INPUTS if c in weather.columns])), fleet)
    absent = missing_columns(features, columns)
    if absent:
        raise ValueError(f"features missing: {absent}")
    return impute_features(features, columns)


def score_history(hourly: DataFrame, weather: DataFrame, fleet: DataFrame, coefficients: DataFrame | None = None,
                  columns: list[str] | None = None, model: PipelineModel | None = None,
                  models: dict[int, PipelineModel] | None = None, fleet_models: DataFrame | None = None) -> DataFrame:
    """History with non-negative predictions, from one ``model``, one of ``models`` per plant, fleet coefficients, or a model table of one kind per plant.

    Plants with a model get their daylight hours that have a target. A plant without one keeps every hour, with the
    actual value standing in for the prediction; feature columns are NULL there, the clear-sky yield is not.
    """
    columns = columns or config.ALL_FEATURES
    if model is not None:
        rows = scoring_frame(hourly, weather, fleet, columns)
        return predict(model, rows, "ml_predicted_kwh").withColumn("ml_predicted_kwh", non_negative("ml_predicted_kwh"))
    if models:
        mine = F.col("plant_id").isin(list(models))
        rows = scoring_frame(hourly.where(mine), weather, fleet, columns)
        scored = _by_plant(models, rows, "ml_predicted_kwh")
        others = hourly.where(F.coalesce(~mine, F.lit(True)))
    elif fleet_models is not None:
        known = fleet_models.where("error IS NULL").select("plant_id").distinct()
        rows = scoring_frame(hourly.join(known, "plant_id", "left_semi"), weather, fleet, columns)
        scored = score_models(rows, fleet_models, columns, "ml_predicted_kwh").drop("kind").withColumn("ml_predicted_kwh", non_negative("ml_predicted_kwh"))
        others = hourly.join(known, "plant_id", "left_anti")
    elif coefficients is not None:
        known = coefficients.select("plant_id")
        rows = scoring_frame(hourly.join(known, "plant_id", "left_semi"), weather, fleet, columns)
        scored = score_fleet_ridge(rows, coefficients, columns).withColumn(
            "ml_predicted_kwh", F.coalesce("ml_predicted_kwh", "generation_kwh"))
        others = hourly.join(known, "plant_id", "left_anti")
    else:
        return _without_model(hourly, fleet)
    return scored.unionByName(_without_model(others, fleet), allowMissingColumns=True)


def _without_model(hourly: DataFrame, fleet: DataFrame) -> DataFrame:
    return add_solar(hourly, fleet).withColumn("ml_predicted_kwh", F.col("generation_kwh"))


def _by_plant(models: dict[int, PipelineModel], rows: DataFrame, output: str) -> DataFrame:
    """Every plant's rows through its own model."""
    parts = [predict(model, rows.where(F.col("plant_id") == plant), output) for plant, model in models.items()]
    return reduce(DataFrame.unionByName, parts).withColumn(output, non_negative(output))


def forecast(weather: DataFrame, history: DataFrame | None, fleet: DataFrame, columns: list[str],
             coefficients: DataFrame | None = None, model: PipelineModel | None = None,
             models: dict[int, PipelineModel] | None = None, fleet_models: DataFrame | None = None) -> DataFrame:
    """Hourly daylight predictions per plant from a 3-hourly outlook keyed by plant; NULL for a plant without a model."""
    rows = forecast_features(weather, history, fleet)
    if fleet_models is not None:
        scored = score_models(rows, fleet_models, columns, "predicted_kwh").drop("kind")
        return scored.withColumn("predicted_kwh", non_negative("predicted_kwh"))
    if models:
        others = rows.where(F.coalesce(~F.col("plant_id").isin(list(models)), F.lit(True)))
        return _by_plant(models, rows, "predicted_kwh").unionByName(
            others.withColumn("predicted_kwh", F.lit(None).cast("double")))
    if model is not None:
        return predict(model, rows, "predicted_kwh").withColumn("predicted_kwh", non_negative("predicted_kwh"))
    return score_fleet_ridge(rows, coefficients, columns, "predicted_kwh")
