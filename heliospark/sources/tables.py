"""Table scans with declared schemas, optional sources and prefer-materialised reads."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

SCHEMAS = {
    "plants": "plant_id long, plant_name string, plant_address string, plant_type string, "
              "plant_capacity double, system_type string, inverter_provider string, status string",
    "generation_log": "plant_id long, generation_date string, generation_amount string",
    "meter_log": "plant_id long, meter_id string, meter_reading string, date string",
    "weather": "dt_iso string, temp string, visibility string, rain_1h string, clouds_all string, "
               "pressure string, humidity string, wind_speed string, feels_like string, wind_deg string",
}


def read_table(spark: SparkSession, path: str | Sequence[str], schema: str | None = None,
               columns: Sequence[str] | None = None, fmt: str | None = None) -> DataFrame:
    """Scan Parquet or header CSV. With several candidate paths the first that exists is read.

    The format follows the file name unless ``fmt`` says ``csv`` or ``parquet``.

    Columns given here are the only ones read. CSV needs a declared schema: nothing is inferred.
    """
    candidates = [path] if isinstance(path, str) else list(path)
    for candidate in candidates:
        df = _open(spark, candidate, schema, fmt)
        if df is not None:
            return df.select(*columns) if columns else df
    raise FileNotFoundError(f"none of these tables exists: {candidates}")


def optional_table(spark: SparkSession, path: str | Sequence[str], schema: str | None = None,
                   required: Sequence[str] = (), fmt: str | None = None) -> DataFrame | None:
    """The table, or None when it is missing or lacks a required column."""
    try:
        df = read_table(spark, path, schema, fmt=fmt)
    except FileNotFoundError:
        return None
    return with_required_columns(df, required)


def with_required_columns(df: DataFrame | None, required: Sequence[str]) -> DataFrame | None:
    if df is None or missing_columns(df, required):
        return None
    return df


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    present = set(df.columns)
    return [name for name in required if name not in present]


def read_or_build(spark: SparkSession, clean_path: str, build: Callable[[], DataFrame],
                  schema: str | None = None, fmt: str | None = None) -> DataFrame:
    """Read the materialised table when there is one, otherwise build it from raw."""
    df = _open(spark, clean_path, schema, fmt)
    return build() if df is None else df


def _open(spark: SparkSession, path: str, schema: str | None, fmt: str | None) -> DataFrame | None:
    try:
        if fmt == "csv" or (fmt is None and path.rstrip("/").endswith(".csv")):
            if schema is None:
                raise ValueError("a CSV scan needs a declared schema")
            # CSV columns bind by position, so the declared schema is matched to the file's header.
            header = spark.read.csv(path, header=True).columns
            declared = dict(field.strip().split(" ", 1) for field in schema.split(","))
            bound = ", ".join(f"`{name}` {declared.get(name, 'string')}" for name in header)
            df = spark.read.schema(bound).csv(path, header=True)
            return df.select(*[name for name in header if name in declared])
        reader = spark.read.schema(schema) if schema else spark.read
        return reader.parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return None
        raise
