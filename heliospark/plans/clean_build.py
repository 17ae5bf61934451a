"""Raw tables to the six clean tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from heliospark import config
from heliospark.operators.cleaning import clean_generation, clean_plants
from heliospark.operators.completeness import quality_summary
from heliospark.operators.daily import METER_COLUMNS, align_daily_sources, daily_agreement, daily_log_rows, daily_meter
from heliospark.operators.hourly import hourly_targets
from heliospark.sources.tables import with_required_columns
from heliospark.sources.weather import clean_weather


def daily_sources(raw: dict[str, DataFrame], fleet: DataFrame) -> tuple[list[DataFrame], list[str]]:
    """Long daily rows of the sources that are present and complete enough to use."""
    logs = {
        config.FIVE_MIN: ("generation_5min", 1000.0, 0),
        config.HOURLY_INVERTER: ("generation_hourly", 1000.0, 0),
        # Daily rows are stamped just after midnight of the following day.
        config.DAILY_INVERTER: ("generation_daily", 1.0, -1),
    }
    meters = {config.HOURLY_METER: "meter_hourly", config.BILLING_METER: "meter_billing"}
    parts, names = [], []
    for source, (table, divisor, shift) in logs.items():
        df = with_required_columns(raw.get(table), ["plant_id", "generation_date", "generation_amount"])
        if df is not None:
            parts.append(daily_log_rows(df, fleet, source, divisor, shift))
            names.append(source)
    for source, table in meters.items():
        df = with_required_columns(raw.get(table), METER_COLUMNS)
        if df is not None:
            parts.append(daily_meter(df, fleet, source))
            names.append(source)
    return parts, names


def aligned_sources(raw: dict[str, DataFrame], fleet: DataFrame) -> DataFrame:
    parts, names = daily_sources(raw, fleet)
    return align_daily_sources(parts, names)


def build_clean_dataset(raw: dict[str, DataFrame], fleet: DataFrame,
                        expected: int = config.EXPECTED_RECORDS_PER_HOUR) -> dict[str, DataFrame]:
    """All clean tables, lazily; write them with ``write_clean``."""
    generation = clean_generation(raw["generation_5min"], fleet)
    hourly = hourly_targets(generation, fleet, expected)
    agreement = daily_agreement(aligned_sources(raw, fleet), fleet)
    return {
        "plants_clean": clean_plants(raw["plants"], fleet),
        "generation_5min_clean": generation,
        "hourly_model_targets": hourly,
        "daily_source_agreement": agreement,
        "weather_hourly_clean": clean_weather(raw["weather"]),
        "data_quality_summary": quality_summary(hourly, agreement, fleet),
    }
