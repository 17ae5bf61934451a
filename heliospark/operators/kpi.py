"""Production KPIs, rankings, calendars and statistics over scored hourly frames.

All are grouped aggregates; where a per-plant maximum or date rank is needed it is computed on the
daily or per-plant summary, never by a window over the raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heliospark import config
from heliospark.functions import labels, times
from heliospark.functions.numbers import guarded_corr, performance_ratio, ratio, sum_or_zero
from heliospark.operators.hourly import densify
from heliospark.sources.intermediate import materialize

ACTUAL, PREDICTED, CLEARSKY = "generation_kwh", "ml_predicted_kwh", "clearsky_expected_kwh"


def _day() -> Column:
    return F.col("generation_date").cast("date").alias("date")


def daily_metrics(df: DataFrame, alert_threshold_pct: float = 10.0) -> DataFrame:
    """KPIs per plant-day; columns the frame lacks count as 0."""
    has = set(df.columns)
    total = lambda c: sum_or_zero(c) if c in has else F.lit(0.0)
    daily = df.groupBy("plant_id", _day()).agg(
        total(ACTUAL).alias("actual_total"), total(PREDICTED).alias("predicted_total"),
        total(CLEARSKY).alias("clearsky_total"), F.max(ACTUAL).alias("actual_peak"),
        (F.max(PREDICTED) if PREDICTED in has else F.lit(0.0)).alias("predicted_peak"),
        F.count(F.lit(1)).alias("num_hours"))
    return daily.withColumn(
        "performance_ratio", performance_ratio(F.col("actual_total"), F.col("predicted_total"))).withColumn(
        "has_anomaly", F.col("performance_ratio") < 100 - alert_threshold_pct)


def capacity_factor(df: DataFrame, plants: DataFrame) -> DataFrame:
    """Energy over capacity times rows, in percent; rows without a value still count as hours."""
    totals = df.groupBy("plant_id").agg(sum_or_zero(ACTUAL).alias("total_kwh"), F.count(F.lit(1)).alias("hours"))
    possible = F.col("plant_capacity") * F.col("hours")
    return totals.join(plants.select("plant_id", "plant_capacity"), "plant_id").select(
        "plant_id", "total_kwh", "hours",
        F.when(possible > 0, F.col("total_kwh") / possible * 100).otherwise(F.lit(0.0)).alias("capacity_factor"))


def monthly_metrics(df: DataFrame, plants: DataFrame) -> DataFrame:
    """Monthly totals; the capacity factor divides by hours that have a value."""
    aggs = [sum_or_zero(ACTUAL).alias("total_kwh"), F.avg(ACTUAL).alias("avg_hourly_kwh"),
            F.max(ACTUAL).alias("peak_hour_kwh"), F.count(ACTUAL).alias("num_hours")]
    if PREDICTED in df.columns:
        aggs.append(sum_or_zero(PREDICTED).alias("predicted_kwh"))
    monthly = df.groupBy("plant_id", times.month_start("generation_date").alias("month")).agg(*aggs)
    out = monthly.join(plants.select("plant_id", "plant_capacity"), "plant_id").withColumn(
        "capacity_factor", ratio(F.col("total_kwh"), F.col("plant_capacity") * F.col("num_hours")) * 100)
    if PREDICTED in df.columns:
        out = out.withColumn("performance_ratio", ratio(F.col("total_kwh"), F.col("predicted_kwh")) * 100)
    return out.drop("plant_capacity")


def underperforming_days(df: DataFrame, threshold_pct: float = 80.0) -> DataFrame:
    daily = df.groupBy("plant_id", _day()).agg(
        sum_or_zero(ACTUAL).alias("actual_kwh"), sum_or_zero(PREDICTED).alias("predicted_kwh"))
    return daily.withColumn(
        "performance_ratio", ratio(F.col("actual_kwh"), F.col("predicted_kwh")) * 100).where(
        F.col("performance_ratio") < threshold_pct).withColumn(
        "gap_kwh", F.col("predicted_kwh") - F.col("actual_kwh"))


def anomaly_days(df: DataFrame, alert_threshold_pct: float = 10.0, recent_dates: int = 90) -> DataFrame:
    """Anomalous days among each plant's latest distinct dates, newest first."""
    daily = daily_metrics(df, alert_threshold_pct)
    newest = Window.partitionBy("plant_id").orderBy(F.desc("date"))
    deficit = F.col("predicted_total") - F.col("actual_total")
    recent = daily.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") <= recent_dates)
    return recent.where("has_anomaly").select(
        "plant_id", "date", F.col("actual_total").alias("actual_kwh"), F.col("predicted_total").alias("predicted_kwh"),
        "performance_ratio", deficit.alias("deficit_kwh"),
        F.when(F.col("actual_total") == 0, "Missing Data")
        .otherwise(F.format_string("%.1f kWh deficit", deficit)).alias("status"))


def anomaly_review(df: DataFrame, alert_threshold_pct: float = 10.0, recent_dates: int = 90) -> DataFrame:
    """Number of anomalous days, their mean ratio, and the deficit of days that have data."""
    found = anomaly_days(df, alert_threshold_pct, recent_dates)
    return found.groupBy("plant_id").agg(
        F.count(F.lit(1)).alias("underperformance_days"), F.avg("performance_ratio").alias("avg_performance"),
        sum_or_zero(F.when(F.col("actual_kwh") > 0, F.col("deficit_kwh"))).alias("total_deficit_kwh"))


def seasonal(df: DataFrame) -> DataFrame:
    """Sum, mean and deviation per climate season; every season is listed for every plant."""
    names = config.SEASON_ORDER
    by_season = df.groupBy("plant_id", labels.season(F.month("generation_date")).alias("season")).agg(
        F.coalesce(F.sum(ACTUAL), F.lit(0.0)).alias("total_kwh"), F.avg(ACTUAL).alias("mean_kwh"),
        F.stddev_samp(ACTUAL).alias("std_kwh"))
    measures = ("total_kwh", "mean_kwh", "std_kwh")
    entry = F.when(F.col("season").isNotNull(), F.struct("season", F.struct(*measures)))
    plants = by_season.groupBy("plant_id").agg(F.map_from_entries(F.collect_list(entry)).alias("found"))  # four entries at most
    listed = plants.select("plant_id", "found", F.posexplode(F.array(*[F.lit(n) for n in names])).alias("season_order", "season"))
    found = F.try_element_at("found", F.col("season"))
    return listed.select("plant_id", "season", "season_order", *[found[m].alias(m) for m in measures])


def production_totals(df: DataFrame) -> DataFrame:
    """Total MWh and mean of daily sums per plant."""
    daily = df.groupBy("plant_id", _day()).agg(sum_or_zero(ACTUAL).alias("kwh"))
    return daily.groupBy("plant_id").agg((F.sum("kwh") / 1000).alias("total_mwh"), F.avg("kwh").alias("daily_avg_kwh"))


def feature_correlations(df: DataFrame, columns: Sequence[str], target: str = ACTUAL) -> DataFrame:
    """Pearson correlation of each column with the target, per plant, in one aggregate pass."""
    wide = df.groupBy("plant_id").agg(*[guarded_corr(target, F.col(c).cast("double")).alias(c) for c in columns])
    return _long(wide, columns, "correlation")


def top_correlations(df: DataFrame, columns: Sequence[str], n: int = 10, target: str = ACTUAL) -> DataFrame:
    """The strongest correlations per plant by magnitude."""
    long = feature_correlations(df, columns, target).where(F.col("correlation").isNotNull())
    return top_by_magnitude(long, "correlation", "importance", n)


def top_by_magnitude(df: DataFrame, column: str, alias: str, n: int) -> DataFrame:
    scored = df.withColumn(alias, F.abs(column))
    best = Window.partitionBy("plant_id").orderBy(F.desc(alias), "feature")
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n)


def feature_stats(df: DataFrame, columns: Sequence[str], limit: int | None = None) -> DataFrame:
    """Mean, deviation, minimum and maximum per feature, in one aggregate pass; ``limit`` keeps the first columns."""
    columns = list(columns)[:limit]
    stats = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    wide = df.groupBy("plant_id").agg(*[
        F.struct(*[f(F.col(c).cast("double")).alias(n) for n, f in stats.items()]).alias(c) for c in columns])
    return _long(wide, columns, "s").select("plant_id", "feature", "s.*")


def _long(wide: DataFrame, columns: Sequence[str], value: str) -> DataFrame:
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    return wide.selectExpr("plant_id", f"stack({len(columns)}, {pairs}) AS (feature, {value})")


def peak_hour(df: DataFrame) -> DataFrame:
    """When the latest day peaked, per plant; the first hour wins a tie."""
    earliest_best = F.struct(F.col(ACTUAL), -times.epoch_seconds("generation_date"))
    daily = df.groupBy("plant_id", _day()).agg(
        F.max_by("generation_date", F.when(F.col(ACTUAL).isNotNull(), earliest_best)).alias("peak_time"),
        F.max(ACTUAL).alias("peak_kwh"))
    return daily.groupBy("plant_id").agg(
        F.max("date").alias("date"), F.max_by("peak_time", "date").alias("peak_time"),
        F.max_by("peak_kwh", "date").alias("peak_kwh"))


def model_vs_clearsky(df: DataFrame) -> DataFrame:
    """Means of actual, predicted and clear-sky production, and the error of each mean."""
    means = df.where(F.col(PREDICTED).isNotNull()).groupBy("plant_id").agg(
        F.avg(ACTUAL).alias("actual_mean"), F.avg(PREDICTED).alias("predicted_mean"),
        F.avg(CLEARSKY).alias("clearsky_mean"))
    error = lambda c: ratio(F.abs(F.col(c) - F.col("actual_mean")), F.col("actual_mean")) * 100
    return means.withColumns({"predicted_error_pct": error("predicted_mean"),
                              "clearsky_error_pct": error("clearsky_mean")}).withColumn(
        "times_more_accurate", ratio(F.col("clearsky_error_pct"), F.col("predicted_error_pct")))


def top_days(df: DataFrame, n: int = 5, lowest: bool = False) -> DataFrame:
    """Best days per plant, or the weakest days that produced anything."""
    daily = df.groupBy("plant_id", _day()).agg(sum_or_zero(ACTUAL).alias("production_kwh"))
    if lowest:
        daily = daily.where(F.col("production_kwh") > 0)
    order = F.asc("production_kwh") if lowest else F.desc("production_kwh")
    ranked = daily.withColumn("rank", F.row_number().over(Window.partitionBy("plant_id").orderBy(order, "date")))
    return ranked.where(F.col("rank") <= n)


def since_last(df: DataFrame, n_days: int, ts: str = "generation_date") -> DataFrame:
    """Rows within ``n_days`` of each plant's latest timestamp.

    One row per plant is written first: its size is known, so rows stay where they are unless there are very many plants.
    """
    latest = materialize(df.groupBy("plant_id").agg(F.max(ts).alias("_latest")), "latest")
    return df.join(latest, "plant_id").where(F.col(ts) >= F.col("_latest") - times.days(n_days)).drop("_latest")


def tail_rows(df: DataFrame, n: int, ts: str = "generation_date") -> DataFrame:
    """The last n hourly rows per plant."""
    newest = Window.partitionBy("plant_id").orderBy(F.desc(ts))
    return df.withColumn("_rn", F.row_number().over(newest)).where(F.col("_rn") <= n).drop("_rn")


def latest_usable_day(df: DataFrame) -> DataFrame:
    """Hourly rows of the latest day that produced something, else of the latest day."""
    daily = df.groupBy("plant_id", _day()).agg(F.sum(ACTUAL).alias("kwh"))
    chosen = daily.groupBy("plant_id").agg(
        F.coalesce(F.max(F.when(F.col("kwh") > 0, F.col("date"))), F.max("date")).alias("date"))
    chosen = materialize(chosen, "usable-days")  # of known size: hours are not exchanged for a few days
    return df.withColumn("date", _day()).join(chosen, ["plant_id", "date"], "left_semi")


def years(df: DataFrame) -> DataFrame:
    return df.select(F.year("generation_date").alias("year")).distinct().orderBy(F.desc("year"))


def production_calendar(df: DataFrame, plants: DataFrame, year: int, as_of: Column) -> DataFrame:
    """Every day of the year up to ``as_of`` per plant, days without data at 0."""
    day = F.col("generation_date").cast("date")
    daily = df.where(F.year("generation_date") == year).groupBy("plant_id", day.alias("date")).agg(
        F.sum(ACTUAL).alias("production"))
    end = F.least(F.lit(f"{year}-12-31").cast("date"), as_of.cast("date"))
    grid = densify(plants, daily, "plant_id", F.lit(f"{year}-01-01").cast("date"), end,
                   F.expr("INTERVAL 1 DAY"), ts="date")
    parts = {k: v for k, v in times.calendar_parts("date").items() if k in ("year", "month", "day")}
    return grid.withColumn("production", F.coalesce("production", F.lit(0.0))).withColumns(parts)


def forecast_totals(forecast: DataFrame) -> DataFrame:
    """Total, daily mean and peak of a forecast per plant."""
    return forecast.groupBy("plant_id").agg(
        F.sum("predicted_kwh").alias("total_kwh"),
        F.count_distinct(F.col("generation_date").cast("date")).alias("num_days"),
        F.max("predicted_kwh").alias("peak_kwh"),
    ).withColumn("daily_avg_kwh", ratio(F.col("total_kwh"), F.col("num_days")))


def forecast_timeline(forecast: DataFrame, history: DataFrame, context_days: int = 5) -> DataFrame:
    """Daily forecast next to history: the same days in a replay, else the days before it."""
    ahead = forecast.groupBy("plant_id", _day()).agg(sum_or_zero("predicted_kwh").alias("forecast_kwh"))
    past = history.groupBy("plant_id", _day()).agg(
        sum_or_zero(ACTUAL).alias("actual_kwh"), sum_or_zero(PREDICTED).alias("predicted_kwh"))
    ends = ahead.groupBy("plant_id").agg(F.max("date").alias("f_end")).join(
        past.groupBy("plant_id").agg(F.max("date").alias("h_end")), "plant_id").select(
        "plant_id", (F.col("f_end") <= F.col("h_end")).alias("replay"))
    newest = Window.partitionBy("plant_id").orderBy(F.desc("date"))
    shown = past.withColumn("_rank", F.row_number().over(newest)).join(ends, "plant_id").join(
        ahead.select("plant_id", "date", F.lit(True).alias("_hit")), ["plant_id", "date"], "left").where(
        F.when(F.col("replay"), F.coalesce("_hit", F.lit(False))).otherwise(F.col("_rank") <= context_days))
    prediction = F.when(~F.col("replay"), F.col("predicted_kwh"))
    kept = shown.select("plant_id", "date", F.lit("history").alias("series"), "actual_kwh",
                        prediction.alias("prediction_kwh"), "replay")
    drawn = ahead.join(ends, "plant_id").select(
        "plant_id", "date", F.lit("forecast").alias("series"), F.lit(None).cast("double").alias("actual_kwh"),
        F.col("forecast_kwh").alias("prediction_kwh"), "replay")
    return kept.unionByName(drawn)
