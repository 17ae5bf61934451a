"""Flattening of 5-day/3-hour forecast payloads stored as JSON text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliospark.functions.times import from_epoch_seconds

PAYLOAD_SCHEMA = (
    "list array<struct<dt: bigint,"
    " main: struct<temp: double, feels_like: double, pressure: double, humidity: double>,"
    " clouds: struct<all: double>,"
    " wind: struct<speed: double, deg: double>,"
    " weather: array<struct<main: string, description: string>>,"
    " visibility: double,"
    " rain: struct<`1h`: double>>>"
)


def flatten_forecast(df: DataFrame, payload_col: str = "payload") -> DataFrame:
    """One row per forecast step. Timestamps stay in UTC, as delivered."""
    item = F.col("_item")
    steps = df.withColumn("_payload", F.from_json(payload_col, PAYLOAD_SCHEMA)).withColumn(
        "_item", F.explode("_payload.list"))
    flat = {
        "timestamp": from_epoch_seconds(item["dt"]),
        "temp": item["main"]["temp"],
        "feels_like": item["main"]["feels_like"],
        "pressure": item["main"]["pressure"],
        "humidity": item["main"]["humidity"],
        "clouds_all": item["clouds"]["all"],
        "wind_speed": item["wind"]["speed"],
        "wind_deg": F.coalesce(item["wind"]["deg"], F.lit(0.0)),
        "weather_main": F.try_element_at(item["weather"], F.lit(1))["main"],
        "weather_description": F.try_element_at(item["weather"], F.lit(1))["description"],
        "visibility": F.coalesce(item["visibility"], F.lit(10000.0)),
        "rain_1h": F.coalesce(item["rain"]["1h"], F.lit(0.0)),
    }
    others = [c for c in df.columns if c != payload_col]
    return steps.select(*others, *[expr.alias(name) for name, expr in flat.items()])
