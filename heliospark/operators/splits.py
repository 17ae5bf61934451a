"""Chronological train/test split and expanding folds."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heliospark import config


def split_train_test(df: DataFrame, fleet: DataFrame | None = None, split_date: dt.date | None = None,
                     min_test: int = config.MIN_TEST_SAMPLES, train_ratio: float = config.TRAIN_RATIO,
                     test_months: int = config.TEST_MONTHS) -> DataFrame:
    """Mark each row ``train`` or ``test`` per plant.

    The cut is the given date, else the plant's configured date, else three months before its latest
    row. A plant with too few test rows is cut at the row four fifths into its timeline.
    """
    latest = F.max("generation_date").over(Window.partitionBy("plant_id"))
    relative = F.add_months(F.col("_latest").cast("date"), -test_months).cast("timestamp_ntz") + (
        F.col("_latest") - F.col("_latest").cast("date").cast("timestamp_ntz"))
    out = df.withColumn("_latest", latest)
    if split_date is not None:
        cut = F.lit(split_date).cast("date").cast("timestamp_ntz")
    elif fleet is not None:
        out = out.join(fleet.select("plant_id", "split_date"), "plant_id", "left")
        cut = F.coalesce(F.col("split_date").cast("timestamp_ntz"), relative)
    else:
        cut = relative
    out = out.withColumn("_cut", cut)
    plant = Window.partitionBy("plant_id")
    n_test = F.count_if(F.col("generation_date") >= F.col("_cut")).over(plant)
    out = out.withColumns({
        "_n": F.count(F.lit(1)).over(plant), "_n_test": n_test,
        "_rn": F.row_number().over(plant.orderBy("generation_date")),
    })
    position = F.floor(F.col("_n") * train_ratio) + 1
    fallback = F.min(F.when(F.col("_rn") == position, F.col("generation_date"))).over(plant)
    out = out.withColumn("_by_position", fallback).withColumn(
        "_cut", F.when(F.col("_n_test") < min_test, F.col("_by_position")).otherwise(F.col("_cut")))
    side = F.when(F.col("generation_date") < F.col("_cut"), "train").otherwise("test")
    return out.withColumn("split", side).select(*df.columns, "split")


def time_series_folds(df: DataFrame, splits: int = config.CV_SPLITS) -> DataFrame:
    """Number each row with the fold that tests it; 0 for rows that are only ever trained on.

    With n rows, each fold tests n // (splits + 1) rows and trains on everything before them.
    """
    plant = Window.partitionBy("plant_id")
    rn = F.row_number().over(plant.orderBy("generation_date"))
    n = F.count(F.lit(1)).over(plant)
    size = F.floor(F.col("_n") / (splits + 1))
    behind = F.col("_n") - F.col("_rn")
    fold = F.when(size > 0, F.greatest(F.lit(splits) - F.floor(behind / F.greatest(size, F.lit(1))), F.lit(0)))
    return df.withColumns({"_rn": rn, "_n": n}).withColumn("fold", F.coalesce(fold, F.lit(0)).cast("int")).drop("_rn", "_n")


def fold_sides(df: DataFrame, fold: int) -> tuple[DataFrame, DataFrame]:
    """Train and test rows of one fold of a frame numbered by ``time_series_folds``."""
    return df.where(F.col("fold") < fold), df.where(F.col("fold") == fold)
