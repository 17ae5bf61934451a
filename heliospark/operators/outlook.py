"""Weather outlooks, forecast features and the tables around a forecast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heliospark import config
from heliospark.functions import times
from heliospark.functions.numbers import sum_or_zero
from heliospark.operators.features import (add_solar, add_temporal, add_weather_features, filter_daytime,
                                           interpolate_linear)
from heliospark.operators.hourly import fill_gaps
from heliospark.sources.intermediate import materialize

OUTLOOK_STEPS = 40
MIN_SCENARIO_STEPS = 8
# Lags used when a plant has no history.
DEFAULT_LAGS = {"production_lag_24h": 50.0, "production_lag_168h": 50.0, "production_7d_mean": 40.0}


def weather_3h(weather: DataFrame, start: Column | None = None, end: Column | None = None) -> DataFrame:
    """Mean per 3-hour bucket within the bounds; buckets lacking a required value are dropped."""
    ts = F.col("timestamp")
    rows = weather
    if start is not None:
        rows = rows.where(ts >= start)
    if end is not None:
        rows = rows.where(ts <= end)
    values = [c for c in weather.columns if c != "timestamp"]
    buckets = rows.groupBy(times.floor_bucket("timestamp", 180).alias("bucket")).agg(
        *[F.avg(c).alias(c) for c in values])
    return buckets.withColumnRenamed("bucket", "timestamp").dropna(subset=config.OUTLOOK_REQUIRED)


def weather_scenario(weather: DataFrame, start: Column) -> DataFrame:
    """The first five days of usable buckets from ``start`` on."""
    return weather_3h(weather, start=start).orderBy("timestamp").limit(OUTLOOK_STEPS)


def weather_replay(weather: DataFrame, end: Column) -> DataFrame:
    """The last five days of usable buckets up to ``end``."""
    return weather_3h(weather, end=end).orderBy(F.desc("timestamp")).limit(OUTLOOK_STEPS)


def outlook_weather(weather: DataFrame, history: DataFrame, as_of: Column) -> DataFrame:
    """Scenario from the day after the last production, or a replay when too few buckets follow.

    The choice is part of the plan: the last production is a scalar subquery, and the two candidate
    sets hold at most forty rows each.
    """
    last = history.agg(F.max("generation_date").alias("last")).scalar()
    start = F.date_add(last.cast("date"), 1).cast("timestamp_ntz")
    both = weather_scenario(weather, start).withColumn("is_replay", F.lit(False)).unionByName(
        weather_replay(weather, as_of).withColumn("is_replay", F.lit(True)))
    side = Window.partitionBy(F.lit(1))
    steps = F.count_if(~F.col("is_replay")).over(side)
    return both.withColumn("_steps", steps).where(
        F.when(F.col("_steps") >= MIN_SCENARIO_STEPS, ~F.col("is_replay")).otherwise(F.col("is_replay"))).drop("_steps")


def outlook_for_plants(weather: DataFrame, history: DataFrame, as_of: Column) -> DataFrame:
    """Each plant's outlook: its scenario from the day after its own last production, or the replay when too few buckets follow.

    ``weather`` is the shared site's. Usable buckets are numbered along the calendar, within months and then over months, a
    start looks its place up in its own month, and the forty numbers that follow are joined by equality: no plant
    is compared with the whole timeline. Plants with the same last day share the work. Returns ``plant_id``,
    ``generation_date``, the weather columns and ``is_replay``.
    """
    month = F.trunc(F.col("timestamp"), "month")
    usable = weather_3h(weather).withColumn("_month", month)
    in_month = F.row_number().over(Window.partitionBy("_month").orderBy("timestamp"))
    usable = usable.withColumn("_place", in_month)
    months = usable.groupBy("_month").agg(F.count("*").alias("_n"))
    earlier = F.coalesce(F.sum("_n").over(Window.orderBy("_month").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row a month
    months = materialize(months.withColumn("_before", earlier), "outlook-months")
    numbered = materialize(usable.join(months, "_month").withColumn("_number", F.col("_before") + F.col("_place")), "outlook-buckets")

    last = history.groupBy("plant_id").agg(F.max("generation_date").alias("_last"))
    plants = materialize(last.select("plant_id", F.date_add(F.col("_last").cast("date"), 1).cast("timestamp_ntz").alias("_start")), "outlook-plants")
    starts = plants.select("_start").where("_start IS NOT NULL").distinct().withColumn("_month", F.trunc("_start", "month"))
    behind = (starts.join(numbered.select("_month", "timestamp"), "_month", "left").groupBy("_start", "_month")
              .agg(F.count_if(F.col("timestamp") < F.col("_start")).alias("_inside")))
    first = behind.join(months, "_month", "left").select("_start", "_month", "_inside", "_before")
    # a start beyond or between the months of the weather stands after all months before its own
    gap = first.where("_before IS NULL").join(months.select(F.col("_month").alias("_m"), "_n"), F.col("_m") < F.col("_month"), "left")
    gap = gap.groupBy("_start").agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_from"))
    placed = first.where("_before IS NOT NULL").select("_start", (F.col("_before") + F.col("_inside")).alias("_from")).unionByName(gap)
    wanted = placed.select("_start", F.explode(F.sequence(F.col("_from") + 1, F.col("_from") + OUTLOOK_STEPS)).alias("_number"))
    columns = [c for c in numbered.columns if c not in ("_month", "_place", "_n", "_before", "_number")]
    scenario = materialize(wanted.join(numbered, "_number").select("_start", *columns), "outlook-scenarios")
    enough = scenario.groupBy("_start").agg(F.count("*").alias("_steps")).where(F.col("_steps") >= MIN_SCENARIO_STEPS).select("_start")

    ahead = plants.join(enough, "_start", "left_semi").join(scenario, "_start").select("plant_id", *columns)
    others = plants.join(enough, "_start", "left_anti").select("plant_id")
    replay = weather_for_plants(weather_replay(weather, as_of).select(*columns), others)
    ahead = ahead.withColumnRenamed("timestamp", "generation_date").withColumn("is_replay", F.lit(False))
    return ahead.unionByName(replay.withColumn("is_replay", F.lit(True)))


def upsample_hourly(df: DataFrame, keys: Sequence[str] = ("plant_id",), ts: str = "generation_date") -> DataFrame:
    """Hourly rows between 3-hourly ones: numbers interpolated forward, texts carried forward.

    Only inputs on the full hour carry a value; the others merely extend the grid.
    """
    values = [f for f in df.schema.fields if f.name not in keys and f.name != ts]
    on_hour = times.floor_bucket(ts, 60)
    slots = df.groupBy(*keys, on_hour.alias("_slot")).agg(*[
        F.max(F.when(F.col(ts) == on_hour, F.col(f.name))).alias(f.name) for f in values])
    grid = fill_gaps(slots.withColumnRenamed("_slot", ts), keys, ts, times.hours(1))
    numbers = [f.name for f in values if isinstance(f.dataType, T.NumericType)]
    texts = [f.name for f in values if f.name not in numbers]
    out = interpolate_linear(grid, numbers, keys, ts, both_ends=False)
    if texts:
        ahead = Window.partitionBy(*keys).orderBy(ts).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        out = out.withColumns({c: F.last(c, True).over(ahead) for c in texts})
    return out


def hour_profile(history: DataFrame, target: str = "generation_kwh") -> DataFrame:
    """Per plant and hour of day: latest value of the last 24 rows, mean of the last 168 rows."""
    newest = Window.partitionBy("plant_id").orderBy(F.desc("generation_date"))
    recent = history.select("plant_id", "generation_date", target).withColumn(
        "_rn", F.row_number().over(newest)).where(F.col("_rn") <= 168)
    day = F.col("_rn") <= 24
    return recent.groupBy("plant_id", F.hour("generation_date").alias("hour")).agg(
        F.min_by(target, F.when(day, F.col("_rn"))).alias("production_lag_24h"),
        F.avg(target).alias("production_lag_168h"),
        F.sum(F.when(F.col(target) > 0, F.col(target))).alias("positive_sum"),
        F.count_if(F.col(target) > 0).alias("positive_n"))


def hour_matched_lags(forecast: DataFrame, history: DataFrame | None, target: str = "generation_kwh") -> DataFrame:
    """Give forecast hours the lags of the same hour in history; 0 where no hour matches.

    The profile of a plant is a map of at most 24 hours, so history is read once and joined once.
    """
    if history is None:
        return forecast.withColumns({c: F.lit(v) for c, v in DEFAULT_LAGS.items()})
    by_hour = F.map_from_entries(F.collect_list(
        F.struct("hour", F.struct("production_lag_24h", "production_lag_168h"))))
    plants = hour_profile(history, target).groupBy("plant_id").agg(
        by_hour.alias("_by_hour"),
        F.try_divide(F.sum("positive_sum"), F.sum("positive_n")).alias("production_7d_mean"))
    out = forecast.join(plants, "plant_id", "left")
    same_hour = F.try_element_at("_by_hour", F.hour("generation_date"))
    return out.withColumns({
        "production_lag_24h": F.coalesce(same_hour["production_lag_24h"], F.lit(0.0)),
        "production_lag_168h": F.coalesce(same_hour["production_lag_168h"], F.lit(0.0)),
        "production_7d_mean": F.coalesce("production_7d_mean", F.lit(0.0)),
    }).drop("_by_hour")


def expanding_temp_mean(df: DataFrame) -> DataFrame:
    """Mean temperature over up to 168 rows, the overall mean where none is known yet."""
    plant = Window.partitionBy("plant_id")
    rolling = F.avg("temp").over(plant.orderBy("generation_date").rowsBetween(-167, 0))
    return df.withColumn("temp_7d_mean", F.coalesce(rolling, F.avg("temp").over(plant)))


def forecast_features(weather: DataFrame, history: DataFrame | None, plants: DataFrame) -> DataFrame:
    """Daylight forecast hours per plant with the features the models were trained on."""
    hourly = upsample_hourly(weather)
    out = add_weather_features(add_temporal(add_solar(hourly, plants)))
    out = hour_matched_lags(out, history)
    return filter_daytime(expanding_temp_mean(out))


def weather_for_plants(weather: DataFrame, plants: DataFrame) -> DataFrame:
    """The shared site's outlook (at most forty rows) repeated for every plant."""
    weather = weather.orderBy("timestamp").limit(OUTLOOK_STEPS)
    rows = plants.select("plant_id", F.explode(weather.agg(
        F.collect_list(F.struct(*weather.columns))).scalar()).alias("w")).select("plant_id", "w.*")
    return rows.withColumnRenamed("timestamp", "generation_date")


def forecast_feature_stats(forecast: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Minimum, maximum and mean of forecast columns per plant, in one aggregate."""
    value = {c: F.col(c).cast("double") for c in columns}
    wide = forecast.groupBy("plant_id").agg(*[
        F.struct(F.min(v).alias("min_value"), F.max(v).alias("max_value"), F.avg(v).alias("mean_value")).alias(c) for c, v in value.items()])
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    return wide.selectExpr("plant_id", f"stack({len(value)}, {pairs}) AS (feature, r)").select("plant_id", "feature", "r.*")


def weather_ranges(weather: DataFrame, columns: Sequence[str] = ("temp", "humidity", "clouds_all", "wind_speed")) -> DataFrame:
    """Overall minimum and maximum per weather column."""
    wide = weather.agg(*[F.struct(F.min(c).alias("min_value"), F.max(c).alias("max_value")).alias(c) for c in columns])
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    return wide.selectExpr(f"stack({len(columns)}, {pairs}) AS (feature, r)").select("feature", "r.*")


def weather_daily_summary(forecast: DataFrame, history: DataFrame, weather: DataFrame, replay: bool = False,
                          tail_rows: int = 120, dates: int = 5) -> DataFrame:
    """Weather and production per plant-day: forecast days, and before them the latest history days."""
    day = F.col("generation_date").cast("date").alias("date")

    def conditions() -> list[Column]:
        return [F.min("temp").alias("min_temp"), F.max("temp").alias("max_temp"), F.avg("humidity").alias("avg_humidity"),
                F.avg("clouds_all").alias("avg_clouds"), F.avg("wind_speed").alias("avg_wind")]

    ahead = forecast.groupBy("plant_id", day).agg(
        *conditions(), sum_or_zero("predicted_kwh").alias("predicted_kwh")).withColumn(
        "type", F.lit("Replay" if replay else "Forecast"))
    produced = history.groupBy("plant_id", day).agg(
        sum_or_zero("generation_kwh").alias("actual_kwh"), sum_or_zero("ml_predicted_kwh").alias("predicted_kwh"))
    if replay:
        actual = produced.select("plant_id", "date", "actual_kwh")
        return ahead.join(actual, ["plant_id", "date"], "left").withColumn(
            "actual_kwh", F.coalesce("actual_kwh", F.lit(0.0)))
    ahead = ahead.withColumn("actual_kwh", F.lit(None).cast("double"))

    newest = Window.partitionBy("plant_id").orderBy(F.desc("generation_date"))
    recent = history.select("plant_id", "generation_date").withColumn("_rn", F.row_number().over(newest)).where(
        F.col("_rn") <= tail_rows).select("plant_id", day).distinct()
    rank = F.row_number().over(Window.partitionBy("plant_id").orderBy(F.desc("date")))
    shown = recent.withColumn("_rank", rank).where(F.col("_rank") <= dates).drop("_rank")
    by_day = weather.groupBy(day).agg(*conditions())
    past = shown.join(produced, ["plant_id", "date"]).join(by_day, "date", "left").withColumns({
        "actual_kwh": F.greatest("actual_kwh", F.lit(0.0)), "type": F.lit("Historical")})
    return past.unionByName(ahead)
