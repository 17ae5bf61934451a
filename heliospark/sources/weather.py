"""Weather history: hourly cleaning and the forecast-shaped view with defaults."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliospark import config
from heliospark.functions.numbers import numeric
from heliospark.functions.times import utc_to_local


def _typed(df: DataFrame, tz: str) -> DataFrame:
    present = [c for c in config.WEATHER_COLUMNS if c in df.columns]
    return df.select(utc_to_local(df, "dt_iso", tz).alias("generation_date"),
                     *[numeric(c).alias(c) for c in present])


def clean_weather(df: DataFrame, tz: str = config.TIMEZONE) -> DataFrame:
    """One row per local timestamp with the mean of each numeric column; missing rain counts as 0."""
    typed = _typed(df, tz).where(F.col("generation_date").isNotNull())
    if "rain_1h" in typed.columns:
        typed = typed.withColumn("rain_1h", F.coalesce("rain_1h", F.lit(0.0)))
    values = [c for c in typed.columns if c != "generation_date"]
    return typed.groupBy("generation_date").agg(*[F.avg(c).alias(c) for c in values])


def weather_outlook(df: DataFrame, tz: str = config.TIMEZONE) -> DataFrame:
    """History rows in forecast shape: optional columns get their defaults where absent or null."""
    typed = _typed(df, tz).withColumnRenamed("generation_date", "timestamp")
    temp = F.col("temp") if "temp" in typed.columns else F.lit(25.0)
    defaults = {"feels_like": temp, "wind_deg": F.lit(0.0), "visibility": F.lit(10000.0), "rain_1h": F.lit(0.0)}
    filled = typed.withColumns({
        name: F.coalesce(F.col(name), default) if name in typed.columns else default
        for name, default in defaults.items()
    })
    ordered = [c for c in config.OUTLOOK_REQUIRED + list(defaults) if c in filled.columns]
    return filled.where(F.col("timestamp").isNotNull()).select("timestamp", *ordered)
