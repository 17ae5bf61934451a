"""Writers: the clean dataset, trained models and the metrics registry."""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CLEAN_TABLES = ["plants_clean", "generation_5min_clean", "hourly_model_targets",
                "daily_source_agreement", "weather_hourly_clean", "data_quality_summary"]
_MANIFEST = "sequence long, version string, tables array<string>"
_MONTHLY = {"generation_5min_clean", "hourly_model_targets"}


def write_clean(outputs: dict[str, DataFrame], directory: str, fmt: str = "parquet") -> None:
    """Materialise the named clean tables under ``directory``.

    The two time-series tables are laid out by plant; rows of one plant and month meet in one task,
    so a directory gets one file per month and no task holds more than a month of one plant.
    """
    for name, df in outputs.items():
        if name in _MONTHLY:
            df = df.repartition("plant_id", F.date_format("generation_date", "yyyy-MM"))
            writer = df.sortWithinPartitions("plant_id", "generation_date").write.partitionBy("plant_id")
        else:
            writer = df.write
        writer = writer.mode("overwrite")
        if fmt == "csv":
            writer.option("header", True).csv(f"{directory}/{name}")
        else:
            writer.parquet(f"{directory}/{name}")


def read_clean(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}")


def write_version(outputs: dict[str, DataFrame], directory: str) -> str:
    """Write one build of the clean tables into a folder of its own, then announce it in the manifest.

    Readers follow the manifest, whose row is committed last and at once: they see all tables of one build, and after a
    build that broke off those of the build before. Returns the version's name.
    """
    spark = next(iter(outputs.values())).sparkSession
    version = uuid.uuid4().hex
    write_clean(outputs, f"{directory}/versions/{version}")
    entry = [(_latest(spark, directory)[0] + 1, version, sorted(outputs))]
    spark.createDataFrame(entry, _MANIFEST).coalesce(1).write.mode("append").parquet(f"{directory}/manifest")
    return version


def read_version(spark: SparkSession, directory: str, name: str) -> DataFrame | None:
    """A table of the newest complete build; None if there is no build or it lacks the table."""
    _, version, tables = _latest(spark, directory)
    return read_clean(spark, f"{directory}/versions/{version}", name) if name in tables else None


def _latest(spark: SparkSession, directory: str) -> tuple[int, str, list[str]]:
    from heliospark.sources.tables import read_or_build
    manifest = read_or_build(spark, f"{directory}/manifest", lambda: spark.createDataFrame([], _MANIFEST), _MANIFEST)
    newest = manifest.orderBy(F.desc("sequence"), F.desc("version")).first()
    return tuple(newest) if newest else (0, "", [])


def save_run(models: dict[tuple[int, str], PipelineModel], metrics: DataFrame, directory: str,
             plants: DataFrame | None = None, features: list[str] | None = None) -> None:
    """Save fitted models by plant and kind, the comparison registry and what is needed to score with them again.

    The registry is laid out by plant; a later run replaces the plants it holds and leaves the others.
    """
    for (plant, kind), model in models.items():
        model.write().overwrite().save(_model_path(directory, plant, kind))
    metrics.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("plant_id").parquet(
        f"{directory}/model_comparison")
    if plants is not None:
        plants.write.mode("overwrite").parquet(f"{directory}/plant_info")
    if features is not None:
        spark = metrics.sparkSession
        spark.createDataFrame(list(enumerate(features)), "position int, feature string").write.mode(
            "overwrite").parquet(f"{directory}/feature_columns")


def save_fleet(models: DataFrame, metrics: DataFrame, directory: str, plants: DataFrame | None = None, features: list[str] | None = None) -> None:
    """Save a fleet's model table, laid out by plant like the registry, and what ``save_run`` keeps; a later run replaces the plants it holds."""
    models.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("plant_id").parquet(f"{directory}/fleet_models")
    save_run({}, metrics, directory, plants, features)


def load_fleet(spark: SparkSession, directory: str) -> DataFrame:
    from heliospark.models.trees import MODEL_SCHEMA
    return spark.read.schema(MODEL_SCHEMA).parquet(f"{directory}/fleet_models")


def load_model(directory: str, plant: int, kind: str) -> PipelineModel:
    return PipelineModel.load(_model_path(directory, plant, kind))


def load_registry(spark: SparkSession, directory: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/model_comparison").withColumn("plant_id", F.col("plant_id").cast("long"))


def load_features(spark: SparkSession, directory: str) -> list[str]:
    """The saved feature list, a handful of names, in model order."""
    rows = spark.read.parquet(f"{directory}/feature_columns").orderBy("position").collect()
    return [row.feature for row in rows]


def _model_path(directory: str, plant: int, kind: str) -> str:
    return f"{directory}/models/plant_id={plant}/kind={kind}"
