"""Weather merge, interpolation, lags, rolling means and the full feature frame.

Inputs hold one row per plant and hour, so a per-plant window is bounded by the calendar. All
windows here partition by plant, so after the first exchange the rest reuse it. Backward fills sort
descending and look back: a frame that runs to the end of a partition is quadratic in Spark.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heliospark import config
from heliospark.functions.solar import with_clearsky, with_solar_position

INTERPOLATED = ["temp", "visibility", "clouds_all"]


def merge_weather(generation: DataFrame, weather: DataFrame) -> DataFrame:
    """Attach hourly weather by timestamp, then fill holes along each plant's rows."""
    return interpolate_weather(generation.join(weather, "generation_date", "left"))


def interpolate_weather(df: DataFrame) -> DataFrame:
    present = [c for c in INTERPOLATED if c in df.columns]
    out = interpolate_linear(df, present)
    if "rain_1h" in out.columns:
        out = out.withColumn("rain_1h", F.coalesce("rain_1h", F.lit(0.0)))
    return out


def interpolate_linear(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ("plant_id",),
                       ts: str = "generation_date", both_ends: bool = True) -> DataFrame:
    """Linear interpolation by row position; ends take the nearest value (or stay NULL at the start)."""
    ahead = Window.partitionBy(*keys).orderBy(ts)
    back = Window.partitionBy(*keys).orderBy(F.desc(ts))
    to_here = (Window.unboundedPreceding, Window.currentRow)
    known = lambda c: F.when(F.col(c).isNotNull(), F.struct(F.col("_pos").alias("p"), F.col(c).alias("v")))
    out = df.withColumn("_pos", F.row_number().over(ahead))
    out = out.withColumns({f"_before_{c}": F.last(known(c), True).over(ahead.rowsBetween(*to_here)) for c in columns})
    out = out.withColumns({f"_after_{c}": F.last(known(c), True).over(back.rowsBetween(*to_here)) for c in columns})
    filled = {}
    for c in columns:
        before, after = F.col(f"_before_{c}"), F.col(f"_after_{c}")
        slope = (after["v"] - before["v"]) / (after["p"] - before["p"])
        start = after["v"] if both_ends else F.lit(None).cast("double")
        filled[c] = (F.when(F.col(c).isNotNull(), F.col(c))
                     .when(before.isNull(), start).when(after.isNull(), before["v"])
                     .otherwise(before["v"] + slope * (F.col("_pos") - before["p"])))
    return out.withColumns(filled).select(*df.columns)


def add_temporal(df: DataFrame, ts: str = "generation_date") -> DataFrame:
    two_pi = F.lit(2.0) * F.pi()
    hour, doy = F.hour(ts), F.dayofyear(ts)
    return df.withColumns({
        "hour": hour, "day_of_year": doy, "month": F.month(ts), "day_of_week": F.weekday(ts),
        "hour_sin": F.sin(two_pi * hour / 24), "hour_cos": F.cos(two_pi * hour / 24),
        "day_sin": F.sin(two_pi * doy / 365), "day_cos": F.cos(two_pi * doy / 365),
    })


def add_weather_features(df: DataFrame) -> DataFrame:
    """Cloud impact, rain flag and derived irradiance; unknown clouds stay NULL, unknown rain is no rain."""
    return df.withColumns({
        "cloud_impact": F.lit(1.0) - F.col("clouds_all") / 100,
        "has_rain": F.when(F.col("rain_1h") > 0, 1).otherwise(0),
        "temp_squared": F.col("temp") * F.col("temp"),
    }).withColumns({
        "effective_irradiance": F.col("ghi") * F.col("cloud_impact"),
        "elevation_x_cloud": F.col("elevation") * F.col("cloud_impact"),
    })


def add_lags(df: DataFrame, target: str = "generation_kwh", time_aligned: bool = False) -> DataFrame:
    """Target 24 and 168 rows back, or exactly that many hours back with ``time_aligned``."""
    if not time_aligned:
        w = Window.partitionBy("plant_id").orderBy("generation_date")
        return df.withColumns({f"production_lag_{n}h": F.lag(target, n).over(w) for n in (24, 168)})
    second = F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("generation_date"))
    w = Window.partitionBy("plant_id").orderBy(second)
    return df.withColumns({f"production_lag_{n}h": F.max(target).over(w.rangeBetween(-3600 * n, -3600 * n)) for n in (24, 168)})


def rolling_mean(c: str, rows: int, min_rows: int, exclude_current: bool = False,
                 keys: Sequence[str] = ("plant_id",), ts: str = "generation_date") -> Column:
    frame = (-rows, -1) if exclude_current else (-(rows - 1), 0)
    w = Window.partitionBy(*keys).orderBy(ts).rowsBetween(*frame)
    return F.when(F.count(c).over(w) >= min_rows, F.avg(c).over(w))


def add_rolling(df: DataFrame, target: str = "generation_kwh", exclude_current: bool = False) -> DataFrame:
    """Mean over 168 rows of target and temperature, once 24 of them are present.

    The window includes the current row, as trained models expect; ``exclude_current`` leaves the
    target of the current row out.
    """
    return df.withColumns({
        "production_7d_mean": rolling_mean(target, 168, 24, exclude_current),
        "temp_7d_mean": rolling_mean("temp", 168, 24),
    })


def daily_trend(df: DataFrame) -> DataFrame:
    """Daily production per plant with 7- and 30-day means that skip days without production."""
    daily = df.groupBy("plant_id", F.col("generation_date").cast("date").alias("date")).agg(
        F.coalesce(F.sum("generation_kwh"), F.lit(0.0)).alias("production"))
    return daily.withColumn("production_clean", F.nullif("production", F.lit(0.0))).withColumns({
        f"rolling_avg_{n}d": rolling_mean("production_clean", n, 1, ts="date") for n in (7, 30)})


def impute_features(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ("plant_id",),
                    ts: str = "generation_date") -> DataFrame:
    """Last known value, else next known value, else 0, in time order within the keys."""
    to_here = (Window.unboundedPreceding, Window.currentRow)
    ahead = Window.partitionBy(*keys).orderBy(ts).rowsBetween(*to_here)
    back = Window.partitionBy(*keys).orderBy(F.desc(ts)).rowsBetween(*to_here)
    out = df.withColumns({f"_fwd_{c}": F.last(c, True).over(ahead) for c in columns})
    out = out.withColumns({f"_bwd_{c}": F.last(c, True).over(back) for c in columns})
    zero = lambda c: F.lit(0).cast(df.schema[c].dataType)
    return out.withColumns({c: F.coalesce(f"_fwd_{c}", f"_bwd_{c}", zero(c)) for c in columns}).select(*df.columns)


def filter_daytime(df: DataFrame, min_elevation: float = config.MIN_SUN_ELEVATION) -> DataFrame:
    """Rows with the sun above the limit; by the clock (6 to 18 h) when there is no elevation."""
    if "elevation" in df.columns:
        return df.where(F.col("elevation") > min_elevation)
    return df.where(F.hour("generation_date").between(6, 18))


def drop_null_target(df: DataFrame, target: str = "generation_kwh") -> DataFrame:
    return df.where(F.col(target).isNotNull())


def add_solar(df: DataFrame, plants: DataFrame, ts: str = "generation_date",
              turbidity: list[float] | None = None) -> DataFrame:
    """Sun position, clear-sky irradiance and the clear-sky yield of each plant's capacity."""
    sized = df.join(plants.select("plant_id", F.col("plant_capacity").alias("_kwp")), "plant_id", "left")
    return with_clearsky(with_solar_position(sized, ts), F.col("_kwp"), ts, turbidity).drop("_kwp")


def build_features(df: DataFrame, plants: DataFrame) -> DataFrame:
    """The modelling frame: all features over daylight rows that have a target."""
    out = add_weather_features(add_temporal(add_solar(df, plants)))
    return drop_null_target(filter_daytime(add_rolling(add_lags(out))))


def feature_columns(df: DataFrame) -> list[str]:
    """Every column that is not target or metadata, in frame order."""
    return [c for c in df.columns if c not in config.NON_FEATURES]
