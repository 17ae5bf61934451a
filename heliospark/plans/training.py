"""Hourly targets, weather and agreement to trained and ranked models."""

from __future__ import annotations

from pyspark.sql import DataFrame

from heliospark import config
from heliospark.models.fleet import ALL_MODELS, FleetRun, train_fleet
from heliospark.operators.daily import filter_source_agreement
from heliospark.operators.features import build_features, merge_weather

WEATHER_INPUTS = ["generation_date", "temp", "visibility", "rain_1h", "clouds_all"]


def training_frame(hourly: DataFrame, weather: DataFrame, agreement: DataFrame | None, fleet: DataFrame) -> DataFrame:
    """Features for training: weak days are removed before lags and means are taken."""
    merged = merge_weather(hourly, weather.select(*[c for c in WEATHER_INPUTS if c in weather.columns]))
    if agreement is not None:
        merged = filter_source_agreement(merged, agreement, fleet)
    return build_features(merged, fleet)


def train(hourly: DataFrame, weather: DataFrame, agreement: DataFrame | None, fleet: DataFrame,
          kinds: tuple[str, ...] = ALL_MODELS, bounded_tuning: bool = False, **options) -> FleetRun:
    features = training_frame(hourly, weather, agreement, fleet)
    grids = config.BOUNDED_GRIDS if bounded_tuning else None
    return train_fleet(features, fleet, config.ALL_FEATURES, kinds, grids=grids, **options)
