"""Weather outlooks, forecast features and forecasts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.bindings import Fixture
from catalog.model_queries import best_fleet_models, merged, ridge_coefficients, trained
from catalog.oracle_tables import RIDGE_SUM, TABLES, solar_ctes
from catalog.registry import query
from heliospark import config
from heliospark.functions.times import hours
from heliospark.operators import kpi, outlook
from heliospark.operators.features import build_features
from heliospark.plans import dashboard
from heliospark.operators.cleaning import select_plants
from heliospark.sources.forecast_payload import flatten_forecast
from heliospark.sources.weather import weather_outlook

_NUMBERS = ["temp", "feels_like", "pressure", "humidity", "clouds_all", "wind_speed", "wind_deg", "visibility", "rain_1h"]


def forecast_weather(x: Fixture) -> DataFrame:
    """Payload steps of the fleet's plants in local time."""
    df = select_plants(flatten_forecast(x.payloads), x.fleet)
    return df.withColumn("generation_date", F.col("timestamp") + hours(6)).drop("timestamp")


TABLES["fc_in"] = """
SELECT * EXCLUDE (timestamp), timestamp + INTERVAL '6 hours' AS generation_date FROM forecast_rows WHERE plant_id IN (SELECT plant_id FROM fleet)"""
TABLES["fc_grid"] = """
SELECT g.plant_id, g.generation_date, row_number() OVER (PARTITION BY g.plant_id ORDER BY g.generation_date) AS pos, f.* EXCLUDE (plant_id, generation_date)
FROM (SELECT plant_id, unnest(generate_series(min(generation_date), max(generation_date), INTERVAL '1 hour')) AS generation_date FROM fc_in GROUP BY 1) g
LEFT JOIN fc_in f ON f.plant_id = g.plant_id AND f.generation_date = g.generation_date"""
TABLES["fc_marks"] = """
SELECT *, max(CASE WHEN temp IS NOT NULL THEN pos END) OVER (PARTITION BY plant_id ORDER BY pos) AS b,
  min(CASE WHEN temp IS NOT NULL THEN pos END) OVER (PARTITION BY plant_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS a FROM fc_grid"""
TABLES["fc_hourly"] = "SELECT m.plant_id, m.generation_date, p.weather_main, p.weather_description, " + ", ".join(
    f"CASE WHEN m.a = m.b THEN p.{c} ELSE p.{c} + (n.{c} - p.{c}) / (m.a - m.b) * (m.pos - m.b) END AS {c}" for c in _NUMBERS) + """
FROM fc_marks m JOIN fc_grid p ON p.plant_id = m.plant_id AND p.pos = m.b JOIN fc_grid n ON n.plant_id = m.plant_id AND n.pos = m.a"""
TABLES.update(solar_ctes("fc_hourly", "fc_sun"))
TABLES["fc_recent"] = """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY plant_id ORDER BY generation_date DESC) AS rn FROM feat_day) WHERE rn <= 168"""
TABLES["fc_profile"] = """
SELECT plant_id, hour(generation_date) AS h, arg_min(generation_kwh, rn) FILTER (rn <= 24) AS lag24, avg(generation_kwh) AS lag168 FROM fc_recent GROUP BY 1, 2"""
TABLES["fc_features"] = """
SELECT s.*, coalesce(p.lag24, 0) AS production_lag_24h, coalesce(p.lag168, 0) AS production_lag_168h, coalesce(d.m, 0) AS production_7d_mean,
  1 - clouds_all / 100 AS cloud_impact, ghi * (1 - clouds_all / 100) AS effective_irradiance, elevation * (1 - clouds_all / 100) AS elevation_x_cloud,
  temp * temp AS temp_squared, CASE WHEN rain_1h > 0 THEN 1 ELSE 0 END AS has_rain, hour(s.generation_date) AS hour, month(s.generation_date) AS month,
  isodow(s.generation_date) - 1 AS day_of_week, dayofyear(s.generation_date) AS day_of_year,
  sin(2 * pi() * hour(s.generation_date) / 24) AS hour_sin, cos(2 * pi() * hour(s.generation_date) / 24) AS hour_cos,
  sin(2 * pi() * dayofyear(s.generation_date) / 365) AS day_sin, cos(2 * pi() * dayofyear(s.generation_date) / 365) AS day_cos,
  avg(temp) OVER (PARTITION BY s.plant_id ORDER BY s.generation_date ROWS BETWEEN 167 PRECEDING AND CURRENT ROW) AS temp_7d_mean
FROM fc_sun s LEFT JOIN fc_profile p ON p.plant_id = s.plant_id AND p.h = hour(s.generation_date)
LEFT JOIN (SELECT plant_id, avg(generation_kwh) AS m FROM fc_recent WHERE generation_kwh > 0 GROUP BY 1) d ON d.plant_id = s.plant_id"""
TABLES["fc_out"] = f"""
SELECT * EXCLUDE (raw), CASE WHEN raw IS NOT NULL THEN round(greatest(0, raw), 3) END AS predicted_kwh FROM (
  SELECT f.*, {RIDGE_SUM} AS raw FROM fc_features f LEFT JOIN (SELECT plant_id, w, intercept FROM ridge_fit) r USING (plant_id) WHERE elevation > 5)"""


def forecast(x: Fixture) -> DataFrame:
    """Forecast with the history's own features; scoring the history is not needed for the lags."""
    x = x.with_clean_tables()
    history = build_features(merged(x), x.fleet)
    ahead = dashboard.forecast(forecast_weather(x), history, x.fleet, config.ALL_FEATURES, ridge_coefficients(x))
    return ahead.withColumn("predicted_kwh", F.round("predicted_kwh", 3))


@query("upsample_hourly", "W7 J5", f"SELECT plant_id, generation_date, weather_main, weather_description, {', '.join(_NUMBERS)} FROM fc_hourly", " ".join(_NUMBERS))
def upsample_hourly(x: Fixture):
    return outlook.upsample_hourly(forecast_weather(x))


@query("hour_matched_lags", "W10 J10", """
SELECT plant_id, generation_date, production_lag_24h, production_lag_168h, production_7d_mean FROM fc_features""",
       "production_lag_24h production_lag_168h production_7d_mean")
def hour_matched_lags(x: Fixture):
    hourly = outlook.upsample_hourly(forecast_weather(x)).select("plant_id", "generation_date")
    return outlook.hour_matched_lags(hourly, build_features(merged(x), x.fleet))


@query("default_lags", "W10", """
SELECT plant_id, generation_date, 50.0 AS production_lag_24h, 50.0 AS production_lag_168h, 40.0 AS production_7d_mean FROM fc_in""",
       "production_lag_24h production_lag_168h production_7d_mean")
def default_lags(x: Fixture):
    return outlook.hour_matched_lags(forecast_weather(x).select("plant_id", "generation_date"), None)


@query("expanding_temp_mean", "W11", "SELECT plant_id, generation_date, temp_7d_mean FROM fc_features", "temp_7d_mean")
def expanding_temp_mean(x: Fixture):
    return outlook.expanding_temp_mean(outlook.upsample_hourly(forecast_weather(x))).select("plant_id", "generation_date", "temp_7d_mean")


@query("forecast_ridge", "M12 F13", """
SELECT plant_id, generation_date, elevation, effective_irradiance, production_lag_24h, temp_7d_mean, predicted_kwh FROM fc_out""",
       "elevation effective_irradiance production_lag_24h temp_7d_mean predicted_kwh")
def forecast_ridge(x: Fixture):
    return forecast(x).select("plant_id", "generation_date", "elevation", "effective_irradiance", "production_lag_24h", "temp_7d_mean", "predicted_kwh")


@query("forecast_totals", "A31", """
SELECT plant_id, sum(predicted_kwh) AS total_kwh, count(DISTINCT CAST(generation_date AS DATE)) AS num_days, max(predicted_kwh) AS peak_kwh,
  sum(predicted_kwh) / count(DISTINCT CAST(generation_date AS DATE)) AS daily_avg_kwh FROM fc_out GROUP BY 1""", "total_kwh peak_kwh daily_avg_kwh")
def forecast_totals(x: Fixture):
    return kpi.forecast_totals(forecast(x))


_TIMELINE_SQL = """
WITH a AS (SELECT plant_id, CAST(generation_date AS DATE) AS date, coalesce(sum(predicted_kwh), 0) AS f FROM ({ahead}) GROUP BY 1, 2),
h AS (SELECT plant_id, CAST(generation_date AS DATE) AS date, coalesce(sum(generation_kwh), 0) AS act, coalesce(sum(ml_predicted_kwh), 0) AS pred FROM scored GROUP BY 1, 2),
e AS (SELECT plant_id, max(a.date) <= max(h.date) AS replay FROM a JOIN h USING (plant_id) GROUP BY 1)
SELECT plant_id, date, 'history' AS series, act AS actual_kwh, CASE WHEN NOT replay THEN pred END AS prediction_kwh, replay FROM (
  SELECT h.*, replay, row_number() OVER (PARTITION BY plant_id ORDER BY date DESC) AS rn FROM h JOIN e USING (plant_id)) k
WHERE CASE WHEN replay THEN EXISTS (SELECT 1 FROM a WHERE a.plant_id = k.plant_id AND a.date = k.date) ELSE rn <= 5 END
UNION ALL SELECT plant_id, date, 'forecast', NULL, f, replay FROM a JOIN e USING (plant_id)"""


@query("forecast_timeline_replay", "U2 J7", _TIMELINE_SQL.format(
    ahead="SELECT plant_id, generation_date, temp AS predicted_kwh FROM fc_in"), "actual_kwh prediction_kwh")
def forecast_timeline_replay(x: Fixture):
    ahead = forecast_weather(x).withColumn("predicted_kwh", F.col("temp"))
    return kpi.forecast_timeline(ahead, x.scored)


@query("forecast_timeline_ahead", "U2", _TIMELINE_SQL.format(
    ahead="SELECT plant_id, generation_date + INTERVAL '20 days' AS generation_date, temp AS predicted_kwh FROM fc_in"), "actual_kwh prediction_kwh")
def forecast_timeline_ahead(x: Fixture):
    ahead = forecast_weather(x).withColumns({
        "predicted_kwh": F.col("temp"), "generation_date": F.col("generation_date") + F.expr("INTERVAL 20 DAY")})
    return kpi.forecast_timeline(ahead, x.scored)


_3H = ["temp", "pressure", "humidity", "clouds_all", "wind_speed", "feels_like", "wind_deg", "visibility", "rain_1h"]


def _bucket_sql(condition: str) -> str:
    return (f"SELECT time_bucket(INTERVAL '3 hours', timestamp) AS timestamp, {', '.join(f'avg({c}) AS {c}' for c in _3H)} FROM outlook WHERE {condition} "
            "GROUP BY 1 HAVING avg(temp) IS NOT NULL AND avg(pressure) IS NOT NULL AND avg(humidity) IS NOT NULL AND avg(clouds_all) IS NOT NULL AND avg(wind_speed) IS NOT NULL")


@query("weather_3h", "A35", _bucket_sql("true"), " ".join(_3H))
def weather_3h(x: Fixture):
    return outlook.weather_3h(weather_outlook(x.weather_raw))


_REPLAY_SQL = "SELECT * FROM ({0}) ORDER BY timestamp DESC LIMIT 40".format(_bucket_sql("timestamp <= TIMESTAMP '2024-01-25'"))
_SCENARIO_SQL = "SELECT * FROM ({0}) ORDER BY timestamp LIMIT 40"


@query("weather_replay", "A35 L3", _REPLAY_SQL, " ".join(_3H))
def weather_replay(x: Fixture):
    return outlook.weather_replay(weather_outlook(x.weather_raw), F.expr("TIMESTAMP_NTZ'2024-01-25 00:00:00'"))


@query("weather_scenario", "A35 L3", _SCENARIO_SQL.format(_bucket_sql("timestamp >= TIMESTAMP '2024-01-12'")), " ".join(_3H))
def weather_scenario(x: Fixture):
    return outlook.weather_scenario(weather_outlook(x.weather_raw), F.expr("TIMESTAMP_NTZ'2024-01-12 00:00:00'"))


@query("outlook_falls_back_to_replay", "A35", f"SELECT *, true AS is_replay FROM ({_REPLAY_SQL})", " ".join(_3H))
def outlook_replay(x: Fixture):
    """Production and weather end together, so no scenario follows."""
    return outlook.outlook_weather(weather_outlook(x.weather_raw), x.hourly, F.expr("TIMESTAMP_NTZ'2024-01-25 00:00:00'"))


@query("outlook_uses_scenario", "A35", "SELECT *, false AS is_replay FROM (" + _SCENARIO_SQL.format(_bucket_sql("timestamp >= TIMESTAMP '2024-01-12'")) + ")", " ".join(_3H))
def outlook_scenario(x: Fixture):
    """Production known up to a cut-off, weather beyond it."""
    known = x.hourly.where("generation_date < TIMESTAMP_NTZ'2024-01-12 00:00:00'")
    return outlook.outlook_weather(weather_outlook(x.weather_raw), known, F.expr("TIMESTAMP_NTZ'2024-01-25 00:00:00'"))


@query("outlook_by_plant", "A35 U1", f"""
WITH s AS (SELECT plant_id, CAST(CAST(max(generation_date) AS DATE) + 1 AS TIMESTAMP) AS start FROM hourly GROUP BY 1),
r AS (SELECT plant_id, b.*, row_number() OVER (PARTITION BY plant_id ORDER BY timestamp) AS k FROM s JOIN ({_bucket_sql("true")}) b ON b.timestamp >= start),
e AS (SELECT plant_id FROM r GROUP BY 1 HAVING count(*) >= 8)
SELECT plant_id, timestamp AS generation_date, {", ".join(_3H)}, false AS is_replay FROM r WHERE k <= 40 AND plant_id IN (SELECT plant_id FROM e)
UNION ALL SELECT plant_id, timestamp, {", ".join(_3H)}, true FROM s CROSS JOIN ({_REPLAY_SQL}) q WHERE plant_id NOT IN (SELECT plant_id FROM e)""", " ".join(_3H))
def outlook_by_plant(x: Fixture):
    """Every plant's own start, from its last hour."""
    return outlook.outlook_for_plants(weather_outlook(x.weather_raw), x.hourly, F.expr("TIMESTAMP_NTZ'2024-01-25 00:00:00'"))


@query("forecast_feature_stats", "A30", " UNION ALL ".join(
    f"SELECT plant_id, '{c}' AS feature, min({c}) AS min_value, max({c}) AS max_value, avg({c}) AS mean_value FROM fc_out GROUP BY 1"
    for c in ("elevation", "ghi", "temp", "clouds_all", "cloud_impact", "effective_irradiance", "production_lag_24h", "production_lag_168h", "production_7d_mean", "temp_7d_mean", "predicted_kwh")),
       "min_value max_value mean_value")
def forecast_feature_stats(x: Fixture):
    """Range and mean of what the forecast was made from."""
    names = ("elevation", "ghi", "temp", "clouds_all", "cloud_impact", "effective_irradiance", "production_lag_24h", "production_lag_168h", "production_7d_mean", "temp_7d_mean", "predicted_kwh")
    return outlook.forecast_feature_stats(forecast(x), names)


@query("weather_for_plants", "A35 U1", f"""
SELECT plant_id, q.* RENAME (timestamp AS generation_date) FROM fleet CROSS JOIN ({_REPLAY_SQL}) q""", " ".join(_3H))
def weather_for_plants(x: Fixture):
    replay = outlook.weather_replay(weather_outlook(x.weather_raw), F.expr("TIMESTAMP_NTZ'2024-01-25 00:00:00'"))
    return outlook.weather_for_plants(replay, x.fleet)


@query("weather_ranges", "A34", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, min({c}) AS min_value, max({c}) AS max_value FROM weather_rows" for c in ("temp", "humidity", "clouds_all", "wind_speed")),
       "min_value max_value")
def weather_ranges(x: Fixture):
    typed = weather_outlook(x.weather_raw)
    return outlook.weather_ranges(typed)


_CONDITIONS = "min(temp) AS min_temp, max(temp) AS max_temp, avg(humidity) AS avg_humidity, avg(clouds_all) AS avg_clouds, avg(wind_speed) AS avg_wind"
_SUMMARY_DOUBLES = "min_temp max_temp avg_humidity avg_clouds avg_wind actual_kwh predicted_kwh"


@query("weather_daily_summary", "A32", f"""
WITH a AS (SELECT plant_id, CAST(generation_date AS DATE) AS date, {_CONDITIONS}, coalesce(sum(temp), 0) AS predicted_kwh FROM fc_in GROUP BY 1, 2),
p AS (SELECT plant_id, CAST(generation_date AS DATE) AS date, coalesce(sum(generation_kwh), 0) AS actual_kwh, coalesce(sum(ml_predicted_kwh), 0) AS predicted_kwh FROM scored GROUP BY 1, 2),
w AS (SELECT CAST(generation_date AS DATE) AS date, {_CONDITIONS} FROM weather GROUP BY 1),
r AS (SELECT DISTINCT plant_id, CAST(generation_date AS DATE) AS date FROM (SELECT *, row_number() OVER (PARTITION BY plant_id ORDER BY generation_date DESC) AS rn FROM scored) WHERE rn <= 120),
s AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY plant_id ORDER BY date DESC) AS k FROM r) WHERE k <= 5)
SELECT plant_id, date, min_temp, max_temp, avg_humidity, avg_clouds, avg_wind, actual_kwh, predicted_kwh, 'Historical' AS type
FROM s JOIN p USING (plant_id, date) LEFT JOIN w USING (date)
UNION ALL SELECT plant_id, date, min_temp, max_temp, avg_humidity, avg_clouds, avg_wind, NULL, predicted_kwh, 'Forecast' FROM a""", _SUMMARY_DOUBLES)
def weather_daily_summary(x: Fixture):
    ahead = forecast_weather(x).withColumn("predicted_kwh", F.col("temp"))
    return outlook.weather_daily_summary(ahead, x.scored, x.weather)


@query("weather_daily_summary_replay", "A32", f"""
WITH a AS (SELECT plant_id, CAST(generation_date AS DATE) AS date, {_CONDITIONS}, coalesce(sum(temp), 0) AS predicted_kwh FROM fc_in GROUP BY 1, 2),
p AS (SELECT plant_id, CAST(generation_date AS DATE) AS date, coalesce(sum(generation_kwh), 0) AS actual_kwh FROM scored GROUP BY 1, 2)
SELECT plant_id, date, min_temp, max_temp, avg_humidity, avg_clouds, avg_wind, coalesce(actual_kwh, 0) AS actual_kwh, predicted_kwh, 'Replay' AS type
FROM a LEFT JOIN p USING (plant_id, date)""", _SUMMARY_DOUBLES)
def weather_daily_summary_replay(x: Fixture):
    ahead = forecast_weather(x).withColumn("predicted_kwh", F.col("temp"))
    return outlook.weather_daily_summary(ahead, x.scored, x.weather, replay=True)


def _forecast_by(x: Fixture, models: DataFrame) -> DataFrame:
    history = build_features(merged(x), x.fleet)
    ahead = dashboard.forecast(forecast_weather(x), history, x.fleet, config.ALL_FEATURES, fleet_models=models)
    return ahead.select("plant_id", "generation_date", "predicted_kwh")


@query("forecast_forest", "M12 M3")
def forecast_forest(x: Fixture):
    """Forecast by every plant's forest."""
    x = x.with_clean_tables()
    return _forecast_by(x, trained(x, "forest").models)


@query("forecast_best", "M12 M9")
def forecast_best(x: Fixture):
    """Forecast by every plant's best model on its test side."""
    x = x.with_clean_tables()
    return _forecast_by(x, best_fleet_models(x))
