"""Metrics, ranking and comparison of models, and residual anomalies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heliospark.functions import labels
from heliospark.functions.numbers import ratio
from heliospark.sources.intermediate import materialize


def regression_metrics(df: DataFrame, keys: Sequence[str] = ("plant_id", "model", "split"),
                       target: str = "generation_kwh", prediction: str = "prediction") -> DataFrame:
    """MAE, RMSE, R² and WAPE in one aggregate; NULL where a denominator is zero."""
    y = F.col(target)
    error = y - F.col(prediction)
    sums = df.groupBy(*keys).agg(
        F.count(error).alias("n"), F.avg(F.abs(error)).alias("mae"), F.avg(error * error).alias("mse"),
        F.var_pop(F.when(error.isNotNull(), y)).alias("spread"),
        F.sum(F.abs(error)).alias("abs_error"), F.sum(F.when(error.isNotNull(), F.abs(y))).alias("abs_total"))
    return sums.select(
        *keys, "n", "mae", F.sqrt("mse").alias("rmse"),
        (1 - ratio(F.col("mse"), F.col("spread"))).alias("r2"),
        (ratio(F.col("abs_error"), F.col("abs_total")) * 100).alias("wape"))


def rank_models(metrics: DataFrame) -> DataFrame:
    """Models of each plant by test R², best first."""
    order = Window.partitionBy("plant_id").orderBy(F.desc_nulls_last("r2"), "model")
    return metrics.withColumn("rank", F.row_number().over(order))


def best_models(metrics: DataFrame) -> DataFrame:
    return rank_models(metrics).where(F.col("rank") == 1).drop("rank")


def fleet_model_summary(plants: DataFrame, metrics: DataFrame) -> DataFrame:
    """Best model per plant with a reliability verdict; plants without a model are Unknown."""
    best = best_models(metrics)
    carried = [c for c in ("mae", "rmse", "r2", "wape", "training_time") if c in best.columns]
    out = plants.select("plant_id", "plant_name").join(best.select("plant_id", "model", *carried), "plant_id", "left")
    return out.withColumns({
        "best_model": F.coalesce("model", F.lit("n/a")),
        "reliability": labels.reliability(F.col("r2"), F.col("wape")),
    }).drop("model")


def compare_runs(before: DataFrame, after: DataFrame) -> DataFrame:
    """Best model per plant before and after a run; plants only in the earlier run are left out."""
    def side(df: DataFrame, name: str) -> DataFrame:
        return best_models(df).select(
            "plant_id", F.col("model").alias(f"{name}_best_model"),
            *[F.col(c).alias(f"{name}_{c}") for c in ("r2", "wape", "mae")])

    joined = side(before, "before").join(side(after, "after"), "plant_id", "right")
    return joined.withColumns({
        "r2_delta": F.col("after_r2") - F.col("before_r2"),
        "wape_delta": F.col("after_wape") - F.col("before_wape"),
    })


def residual_anomalies(df: DataFrame, k: float = 2.0, target: str = "generation_kwh",
                       prediction: str = "ml_predicted_kwh") -> DataFrame:
    """Rows whose residual lies more than k deviations below zero.

    The deviation is a grouped aggregate joined back, so a large plant is never gathered in a window. It is written
    first: its size, a row per plant, is known, and rows are not exchanged unless there are very many plants.
    """
    with_residual = df.withColumn("residual", F.col(target) - F.col(prediction))
    limits = with_residual.groupBy("plant_id").agg((F.stddev_samp("residual") * k).alias("threshold"))
    limits = materialize(limits, "residual-limits")
    return with_residual.join(limits, "plant_id").where(F.col("residual") < -F.col("threshold"))


def hyperparameters(trials: list[tuple], spark) -> DataFrame:
    """Search trials as a table, best first."""
    rows = [(str(dict(sorted(params.items()))), float(mae)) for params, mae in trials]
    return spark.createDataFrame(rows, "params string, mae double").orderBy("mae", "params")
