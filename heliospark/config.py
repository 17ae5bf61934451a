"""Fixed values the results depend on, and the fleet dimension built from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# --- Fixed values: site ------------------------------------------------------
LATITUDE = 24.022350694140282
LONGITUDE = 90.29576719011767
TIMEZONE = "Asia/Dhaka"
PERFORMANCE_RATIO = 0.82

# --- Fixed values: fleet -----------------------------------------------------
# plant_id, plant_name, plant_capacity (kWp), split_date, max_ratio_difference, reliable
FLEET = [
    (900001, "Plant A", 269.28, "2025-06-01", 1.00, True),
    (900002, "Plant B", 522.72, "2025-06-01", 1.00, True),
    (900003, "Plant C", 227.04, "2025-06-01", 1.00, True),
    (900004, "Plant D", 525.36, "2025-06-01", 0.20, True),
    (900005, "Plant E", 285.12, "2025-04-01", 1.00, False),
]
DEFAULT_ADDRESS = "Solar Region"
NAME_ALIASES = {
    "Demo Plant A": "Plant A",
    "Demo Plant B": "Plant B",
    "Demo Plant C": "Plant C",
    "Demo Plant D": "Plant D",
    "Demo Plant E": "Plant E",
    "Demo Plant E (Low Quality)": "Plant E",
}

# --- Fixed values: target and training rules ---------------------------------
EXPECTED_RECORDS_PER_HOUR = 12
EXPECTED_RECORDS_PER_DAY = 288
MIN_HOURLY_COMPLETENESS_PCT = 80
MIN_SUN_ELEVATION = 5.0
MAX_RATIO_DIFFERENCE = 1.00
MIN_DAILY_KWH_FOR_AGREEMENT = 1.0
RATIO_BASELINE_FLOOR_KWH = 0.01
MATCH_TOLERANCE_KWH = 0.01
TEST_MONTHS = 3
TRAIN_RATIO = 0.80
MIN_TEST_SAMPLES = 500
CV_SPLITS = 3
MIN_AVAILABILITY_PCT = 60.0
MIN_TEST_R2 = 0.0
MAX_TEST_WAPE_PCT = 70.0

FIVE_MIN, HOURLY_INVERTER, DAILY_INVERTER = "five_min_kwh", "hourly_inverter_kwh", "daily_inverter_kwh"
HOURLY_METER, BILLING_METER = "hourly_meter_kwh", "billing_meter_kwh"
DAILY_SOURCES = [FIVE_MIN, HOURLY_INVERTER, DAILY_INVERTER, HOURLY_METER, BILLING_METER]
REFERENCE_SOURCES = DAILY_SOURCES[1:]
SOURCE_LABELS = {
    FIVE_MIN: "5-minute inverter",
    HOURLY_INVERTER: "Hourly inverter",
    DAILY_INVERTER: "Daily inverter",
    HOURLY_METER: "Hourly meter",
    BILLING_METER: "Billing meter",
}
CONTROL_LABELS = {
    DAILY_INVERTER: "Daily inverter control",
    HOURLY_METER: "Hourly meter control",
    BILLING_METER: "Billing meter control",
}

# --- Fixed values: features --------------------------------------------------
FEATURE_GROUPS = {
    "solar_position": ["elevation", "azimuth", "ghi"],
    "temporal_cyclical": ["hour_sin", "hour_cos", "day_sin", "day_cos"],
    "temporal_linear": ["hour", "month", "day_of_week", "day_of_year"],
    "weather_basic": ["temp", "temp_squared", "clouds_all", "visibility", "rain_1h", "has_rain"],
    "weather_derived": ["cloud_impact", "effective_irradiance", "elevation_x_cloud"],
    "historical": ["production_lag_24h", "production_lag_168h", "production_7d_mean", "temp_7d_mean"],
}
ALL_FEATURES = [name for group in FEATURE_GROUPS.values() for name in group]
NON_FEATURES = [
    "generation_date", "generation_kwh", "generation_kwh_raw", "clearsky_expected_kwh",
    "records_collected", "expected_records", "data_completeness_pct", "data_available",
    "plant_id", "plant_name", "missing_records", "target_source", "target_quality_flag",
]
WEATHER_COLUMNS = [
    "temp", "visibility", "rain_1h", "clouds_all", "pressure",
    "humidity", "wind_speed", "feels_like", "wind_deg",
]
OUTLOOK_REQUIRED = ["temp", "pressure", "humidity", "clouds_all", "wind_speed"]

# --- Fixed values: model settings and search grids ---------------------------
RIDGE_ALPHA = 100.0
SEED = 42
FOREST = {"numTrees": 200, "maxDepth": 20, "minInstancesPerNode": 5}
BOOSTING = {"maxIter": 200, "maxDepth": 7, "stepSize": 0.1}
SUBSAMPLED_BOOSTING = {**BOOSTING, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8"}
MODEL_LABELS = {
    "ridge": "Ridge Regression",
    "forest": "Random Forest",
    "boosting": "Gradient Boosting",
    "subsampled_boosting": "Subsampled Gradient Boosting",
}
# Trees that the fleet trainer grows itself: leaf values are shrunk by penalty, boosted trees draw rows and features per tree.
FLEET_TREES = {
    "forest": {"numTrees": 200, "maxDepth": 20, "minInstancesToSplit": 10, "minInstancesPerNode": 5, "penalty": 0.0},
    "boosting": {"maxIter": 200, "maxDepth": 7, "stepSize": 0.1, "minInstancesToSplit": 10, "minInstancesPerNode": 1, "penalty": 0.0, "subsamplingRate": 1.0},
    "subsampled_boosting": {"maxIter": 200, "maxDepth": 7, "stepSize": 0.1, "minInstancesToSplit": 2, "minInstancesPerNode": 1, "penalty": 1.0,
                            "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8"},
}
RIDGE_GRID = {"alpha": [0.1, 1.0, 10.0, 100.0, 1000.0, 10000.0]}
# MLlib stops at depth 30 and has no minInstancesToSplit; the fleet trainer takes all of these.
WIDE_GRIDS = {
    "ridge": RIDGE_GRID,
    "forest": {
        "numTrees": [100, 200, 300, 400, 500],
        "maxDepth": [15, 20, 25, 30, 35, 40, 45, 50],
        "minInstancesToSplit": [5, 10, 15, 20, 25, 30, 35, 40, 45, 50],
        "minInstancesPerNode": [2, 5, 10, 15, 20, 25, 30, 35, 40, 45, 50],
    },
    "boosting": {
        "maxIter": [100, 200, 300, 400, 500],
        "maxDepth": [5, 7, 9, 11, 13, 15, 17, 19, 21, 23, 25],
        "stepSize": [0.05, 0.1, 0.2],
        "minInstancesToSplit": [10, 20, 30, 40, 50, 60, 70, 80, 90, 100],
        "minInstancesPerNode": [1, 2, 3, 4, 5, 6, 7, 8, 9, 10],
    },
    "subsampled_boosting": {
        "maxIter": [100, 200, 300, 400, 500],
        "maxDepth": [5, 7, 9, 11, 13, 15, 17, 19, 21, 23, 25],
        "stepSize": [0.05, 0.1, 0.2],
        "subsamplingRate": [0.8, 1.0, 0.9, 0.95, 1.0],
        "featureSubsetStrategy": ["0.8", "1.0", "0.9", "0.95", "1.0"],
    },
}
BOUNDED_GRIDS = {
    "ridge": RIDGE_GRID,
    "forest": {
        "numTrees": [100, 200, 300], "maxDepth": [15, 20, 30],
        "minInstancesToSplit": [5, 10, 20], "minInstancesPerNode": [2, 5, 10],
    },
    "boosting": {
        "maxIter": [100, 200, 300], "maxDepth": [3, 5, 7], "stepSize": [0.05, 0.1],
        "minInstancesToSplit": [10, 20], "minInstancesPerNode": [1, 3, 5],
    },
    "subsampled_boosting": {
        "maxIter": [100, 200, 300], "maxDepth": [3, 5, 7], "stepSize": [0.05, 0.1],
        "subsamplingRate": [0.8, 1.0], "featureSubsetStrategy": ["0.8", "1.0"],
    },
}
WIDE_SEARCH_ITERATIONS = 20
BOUNDED_SEARCH_ITERATIONS = 8

SEASON_ORDER = ["Winter / Dry", "Pre-monsoon", "Monsoon", "Post-monsoon"]
SEASON_MONTHS = {
    "Winter / Dry": [12, 1, 2],
    "Pre-monsoon": [3, 4, 5],
    "Monsoon": [6, 7, 8, 9],
    "Post-monsoon": [10, 11],
}


def inline_table(spark: SparkSession, columns: list[str], rows: list[tuple]) -> DataFrame:
    """A small literal table with exact size statistics, so joins to it can be planned as broadcasts."""
    def literal(value):
        if isinstance(value, bool):
            return str(value).lower()
        if isinstance(value, float):
            return f"{value!r}D"
        if isinstance(value, int):
            return f"{value}L"
        return "'" + str(value).replace("'", "\\'") + "'"

    values = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(columns)})")


def fleet(spark: SparkSession) -> DataFrame:
    """The configured fleet; any table with these columns can take its place."""
    rows = [(*row, position) for position, row in enumerate(FLEET)]
    columns = ["plant_id", "plant_name", "plant_capacity", "split_date",
               "max_ratio_difference", "reliable", "ordinal"]
    table = inline_table(spark, columns, rows)
    return table.withColumn("split_date", table.split_date.cast("date")).withColumn(
        "ordinal", table.ordinal.cast("int"))
