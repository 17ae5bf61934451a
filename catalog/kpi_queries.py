"""Production KPIs, rankings, calendars and statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.bindings import Fixture
from catalog.registry import query
from heliospark.functions import numbers
from heliospark.operators import features, kpi


def as_of():
    return F.expr("DATE'1997-10-15'")

_DAILY_SQL = """
SELECT *, CASE WHEN predicted_total > 0 THEN actual_total / predicted_total * 100 ELSE 0 END AS performance_ratio,
  CASE WHEN predicted_total > 0 THEN actual_total / predicted_total * 100 ELSE 0 END < 90 AS has_anomaly
FROM (SELECT plant_id, CAST(generation_date AS DATE) AS date, coalesce(sum(generation_kwh), 0) AS actual_total,
  coalesce(sum(ml_predicted_kwh), 0) AS predicted_total, coalesce(sum(clearsky_expected_kwh), 0) AS clearsky_total,
  max(generation_kwh) AS actual_peak, max(ml_predicted_kwh) AS predicted_peak, count(*) AS num_hours FROM {0} GROUP BY 1, 2)"""
_DAILY_DOUBLES = "actual_total predicted_total clearsky_total actual_peak predicted_peak performance_ratio"


@query("daily_metrics", "A21 A24", _DAILY_SQL.format("scored"), _DAILY_DOUBLES)
def daily_metrics(x: Fixture):
    return kpi.daily_metrics(x.scored)


@query("daily_metrics_history", "A21 A24", _DAILY_SQL.format("history"), _DAILY_DOUBLES)
def daily_metrics_history(x: Fixture):
    return kpi.daily_metrics(x.history)


@query("daily_metrics_without_predictions", "A21", """
SELECT plant_id, CAST(generation_date AS DATE) AS date, coalesce(sum(generation_kwh), 0) AS actual_total, 0.0 AS predicted_total, 0.0 AS clearsky_total,
  max(generation_kwh) AS actual_peak, 0.0 AS predicted_peak, count(*) AS num_hours, 0.0 AS performance_ratio, true AS has_anomaly
FROM scored GROUP BY 1, 2""", _DAILY_DOUBLES)
def daily_metrics_plain(x: Fixture):
    return kpi.daily_metrics(x.scored.select("plant_id", "generation_date", "generation_kwh"))


@query("capacity_factor", "A22", """
SELECT plant_id, coalesce(sum(generation_kwh), 0) AS total_kwh, count(*) AS hours,
  coalesce(sum(generation_kwh), 0) / (plant_capacity * count(*)) * 100 AS capacity_factor
FROM history JOIN fleet USING (plant_id) GROUP BY plant_id, plant_capacity""", "total_kwh capacity_factor")
def capacity_factor(x: Fixture):
    return kpi.capacity_factor(x.history, x.fleet)


@query("monthly_metrics", "A23", """
SELECT plant_id, CAST(date_trunc('month', generation_date) AS DATE) AS month, coalesce(sum(generation_kwh), 0) AS total_kwh,
  avg(generation_kwh) AS avg_hourly_kwh, max(generation_kwh) AS peak_hour_kwh, count(generation_kwh) AS num_hours,
  coalesce(sum(ml_predicted_kwh), 0) AS predicted_kwh,
  coalesce(sum(generation_kwh), 0) / nullif(any_value(plant_capacity) * count(generation_kwh), 0) * 100 AS capacity_factor,
  coalesce(sum(generation_kwh), 0) / nullif(sum(ml_predicted_kwh), 0) * 100 AS performance_ratio
FROM history JOIN fleet USING (plant_id) GROUP BY 1, 2""",
       "total_kwh avg_hourly_kwh peak_hour_kwh predicted_kwh capacity_factor performance_ratio")
def monthly_metrics(x: Fixture):
    return kpi.monthly_metrics(x.history, x.fleet)


@query("underperforming_days", "A25", """
SELECT *, predicted_kwh - actual_kwh AS gap_kwh FROM (SELECT *, actual_kwh / nullif(predicted_kwh, 0) * 100 AS performance_ratio FROM (
  SELECT plant_id, CAST(generation_date AS DATE) AS date, coalesce(sum(generation_kwh), 0) AS actual_kwh, coalesce(sum(ml_predicted_kwh), 0) AS predicted_kwh
  FROM history GROUP BY 1, 2)) WHERE performance_ratio < 80""", "actual_kwh predicted_kwh performance_ratio gap_kwh")
def underperforming_days(x: Fixture):
    return kpi.underperforming_days(x.history)


_ANOMALY_SQL = f"""
SELECT plant_id, date, actual_total AS actual_kwh, predicted_total AS predicted_kwh, performance_ratio, predicted_total - actual_total AS deficit_kwh,
  CASE WHEN actual_total = 0 THEN 'Missing Data' ELSE 'deficit' END AS kind
FROM (SELECT *, row_number() OVER (PARTITION BY plant_id ORDER BY date DESC) AS rn FROM ({_DAILY_SQL.format("history")})) WHERE rn <= 90 AND has_anomaly"""


@query("anomaly_days", "A26", _ANOMALY_SQL, "actual_kwh predicted_kwh performance_ratio deficit_kwh")
def anomaly_days(x: Fixture):
    kind = F.when(F.col("status") == "Missing Data", F.col("status")).otherwise("deficit")
    return kpi.anomaly_days(x.history).withColumn("kind", kind).drop("status")


@query("anomaly_review", "A26", f"""
SELECT plant_id, count(*) AS underperformance_days, avg(performance_ratio) AS avg_performance,
  coalesce(sum(deficit_kwh) FILTER (actual_kwh > 0), 0) AS total_deficit_kwh FROM ({_ANOMALY_SQL}) GROUP BY 1""",
       "avg_performance total_deficit_kwh")
def anomaly_review(x: Fixture):
    return kpi.anomaly_review(x.history)


@query("seasonal", "A27 F14", """
WITH s AS (SELECT CAST(i AS INTEGER) AS season_order, n AS season FROM (VALUES (0, 'Winter / Dry'), (1, 'Pre-monsoon'), (2, 'Monsoon'), (3, 'Post-monsoon')) v(i, n)),
a AS (SELECT plant_id, CASE WHEN month(generation_date) IN (12, 1, 2) THEN 'Winter / Dry' WHEN month(generation_date) IN (3, 4, 5) THEN 'Pre-monsoon'
  WHEN month(generation_date) IN (6, 7, 8, 9) THEN 'Monsoon' ELSE 'Post-monsoon' END AS season, coalesce(sum(generation_kwh), 0) AS total_kwh,
  avg(generation_kwh) AS mean_kwh, stddev_samp(generation_kwh) AS std_kwh FROM history GROUP BY 1, 2)
SELECT p.plant_id, s.season_order, s.season, total_kwh, mean_kwh, std_kwh FROM (SELECT DISTINCT plant_id FROM history) p CROSS JOIN s
LEFT JOIN a ON a.plant_id = p.plant_id AND a.season = s.season""", "total_kwh mean_kwh std_kwh")
def seasonal(x: Fixture):
    return kpi.seasonal(x.history)


@query("seasonal_with_absent_seasons", "A27", """
WITH s AS (SELECT CAST(i AS INTEGER) AS season_order, n AS season FROM (VALUES (0, 'Winter / Dry'), (1, 'Pre-monsoon'), (2, 'Monsoon'), (3, 'Post-monsoon')) v(i, n))
SELECT plant_id, season_order, season, CASE WHEN season_order = 0 THEN coalesce(sum(generation_kwh), 0) END AS total_kwh,
  CASE WHEN season_order = 0 THEN avg(generation_kwh) END AS mean_kwh, CASE WHEN season_order = 0 THEN stddev_samp(generation_kwh) END AS std_kwh
FROM hourly CROSS JOIN s GROUP BY 1, 2, 3""", "total_kwh mean_kwh std_kwh")
def seasonal_absent(x: Fixture):
    return kpi.seasonal(x.hourly)


@query("production_totals", "A28", """
SELECT plant_id, sum(kwh) / 1000 AS total_mwh, avg(kwh) AS daily_avg_kwh FROM (
  SELECT plant_id, CAST(generation_date AS DATE) AS date, coalesce(sum(generation_kwh), 0) AS kwh FROM history GROUP BY 1, 2) GROUP BY 1""",
       "total_mwh daily_avg_kwh")
def production_totals(x: Fixture):
    return kpi.production_totals(x.history)


_COLUMNS = ["ml_predicted_kwh", "clearsky_expected_kwh", "discount", "tax"]
_CORR_SQL = " UNION ALL ".join(
    f"""SELECT plant_id, '{c}' AS feature, covar_samp(generation_kwh, {c}) / nullif(stddev_samp(CASE WHEN {c} IS NOT NULL THEN generation_kwh END)
    * stddev_samp(CASE WHEN generation_kwh IS NOT NULL THEN {c} END), 0) AS correlation FROM history GROUP BY 1""" for c in _COLUMNS)


@query("feature_correlations", "A29", _CORR_SQL, "correlation")
def feature_correlations(x: Fixture):
    return kpi.feature_correlations(x.history, _COLUMNS)


@query("top_correlations", "A29 L4", f"""
SELECT plant_id, feature, correlation, importance, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, abs(correlation) AS importance, row_number() OVER (PARTITION BY plant_id ORDER BY abs(correlation) DESC, feature) AS rank
  FROM ({_CORR_SQL}) WHERE correlation IS NOT NULL) WHERE rank <= 2""", "correlation importance")
def top_correlations(x: Fixture):
    return kpi.top_correlations(x.history, _COLUMNS, 2)


@query("feature_stats", "A30", " UNION ALL ".join(
    f"SELECT plant_id, '{c}' AS feature, avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS min, max({c}) AS max FROM history GROUP BY 1"
    for c in ["generation_kwh", *_COLUMNS]), "mean std min max")
def feature_stats(x: Fixture):
    return kpi.feature_stats(x.history, ["generation_kwh", *_COLUMNS])


@query("peak_hour", "A33", """
SELECT plant_id, date, arg_max(generation_date, (generation_kwh, -epoch(generation_date))) FILTER (generation_kwh IS NOT NULL) AS peak_time, max(generation_kwh) AS peak_kwh
FROM (SELECT *, CAST(generation_date AS DATE) AS date, max(CAST(generation_date AS DATE)) OVER (PARTITION BY plant_id) AS last FROM scored)
WHERE date = last GROUP BY 1, 2""", "peak_kwh")
def peak_hour(x: Fixture):
    return kpi.peak_hour(x.scored)


@query("model_vs_clearsky", "M14", """
SELECT *, clearsky_error_pct / nullif(predicted_error_pct, 0) AS times_more_accurate FROM (
  SELECT *, abs(predicted_mean - actual_mean) / nullif(actual_mean, 0) * 100 AS predicted_error_pct,
    abs(clearsky_mean - actual_mean) / nullif(actual_mean, 0) * 100 AS clearsky_error_pct FROM (
    SELECT plant_id, avg(generation_kwh) AS actual_mean, avg(ml_predicted_kwh) AS predicted_mean, avg(clearsky_expected_kwh) AS clearsky_mean
    FROM history WHERE ml_predicted_kwh IS NOT NULL GROUP BY 1))""",
       "actual_mean predicted_mean clearsky_mean predicted_error_pct clearsky_error_pct times_more_accurate")
def model_vs_clearsky(x: Fixture):
    return kpi.model_vs_clearsky(x.history)


_DAYS_SQL = "SELECT plant_id, CAST(generation_date AS DATE) AS date, coalesce(sum(generation_kwh), 0) AS production_kwh FROM history GROUP BY 1, 2"


@query("top_days", "L1", f"""
SELECT plant_id, date, production_kwh, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY plant_id ORDER BY production_kwh DESC, date) AS rank
FROM ({_DAYS_SQL})) WHERE rank <= 5""", "production_kwh")
def top_days(x: Fixture):
    return kpi.top_days(x.history)


@query("lowest_days", "L2", f"""
SELECT plant_id, date, production_kwh, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY plant_id ORDER BY production_kwh, date) AS rank
FROM ({_DAYS_SQL}) WHERE production_kwh > 0) WHERE rank <= 5""", "production_kwh")
def lowest_days(x: Fixture):
    return kpi.top_days(x.history, lowest=True)


def _since_sql(days: int) -> str:
    return f"""
SELECT plant_id, generation_date, generation_kwh FROM (SELECT *, max(generation_date) OVER (PARTITION BY plant_id) AS latest FROM scored)
WHERE generation_date >= latest - INTERVAL '{days} days'"""


@query("last_7_days", "P6", _since_sql(6), "generation_kwh")
def last_7_days(x: Fixture):
    return kpi.since_last(x.scored, 6).select("plant_id", "generation_date", "generation_kwh")


@query("last_30_days", "P6", _since_sql(29), "generation_kwh")
def last_30_days(x: Fixture):
    return kpi.since_last(x.scored, 29).select("plant_id", "generation_date", "generation_kwh")


@query("tail_rows", "L3", """
SELECT plant_id, generation_date, generation_kwh FROM (SELECT *, row_number() OVER (PARTITION BY plant_id ORDER BY generation_date DESC) AS rn FROM scored)
WHERE rn <= 120""", "generation_kwh")
def tail_rows(x: Fixture):
    return kpi.tail_rows(x.scored, 120).select("plant_id", "generation_date", "generation_kwh")


@query("latest_usable_day", "L6 J7", """
WITH d AS (SELECT plant_id, CAST(generation_date AS DATE) AS date, sum(generation_kwh) AS kwh FROM scored GROUP BY 1, 2),
c AS (SELECT plant_id, coalesce(max(date) FILTER (kwh > 0), max(date)) AS date FROM d GROUP BY 1)
SELECT s.plant_id, s.generation_date, s.generation_kwh, c.date FROM scored s JOIN c ON c.plant_id = s.plant_id AND c.date = CAST(s.generation_date AS DATE)""",
       "generation_kwh")
def latest_usable_day(x: Fixture):
    return kpi.latest_usable_day(x.scored).select("plant_id", "generation_date", "generation_kwh", "date")


@query("years", "L7", "SELECT DISTINCT CAST(year(generation_date) AS INTEGER) AS year FROM history ORDER BY 1 DESC")
def years(x: Fixture):
    return kpi.years(x.history)


@query("production_calendar", "F16 F15", """
SELECT f.plant_id, g.date, coalesce(d.production, 0) AS production, CAST(year(g.date) AS INTEGER) AS year, CAST(month(g.date) AS INTEGER) AS month,
  CAST(day(g.date) AS INTEGER) AS day
FROM fleet f CROSS JOIN (SELECT CAST(unnest(generate_series(DATE '1997-01-01', DATE '1997-10-15', INTERVAL '1 day')) AS DATE) AS date) g
LEFT JOIN (SELECT plant_id, CAST(generation_date AS DATE) AS date, sum(generation_kwh) AS production FROM history GROUP BY 1, 2) d
  ON d.plant_id = f.plant_id AND d.date = g.date""", "production")
def production_calendar(x: Fixture):
    return kpi.production_calendar(x.history, x.fleet, 1997, as_of())


@query("daily_trend", "W3", """
WITH d AS (SELECT plant_id, CAST(generation_date AS DATE) AS date, coalesce(sum(generation_kwh), 0) AS production FROM history GROUP BY 1, 2)
SELECT *, avg(production_clean) OVER (PARTITION BY plant_id ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS rolling_avg_7d,
  avg(production_clean) OVER (PARTITION BY plant_id ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS rolling_avg_30d
FROM (SELECT *, nullif(production, 0) AS production_clean FROM d)""", "production production_clean rolling_avg_7d rolling_avg_30d")
def daily_trend(x: Fixture):
    return features.daily_trend(x.history)


@query("clamped_predictions", "F13", """
SELECT l_orderkey, l_linenumber, greatest(l_quantity - 25, 0) AS predicted_kwh FROM lineitem""", "predicted_kwh")
def clamped_predictions(x: Fixture):
    return x.table("lineitem").select("l_orderkey", "l_linenumber",
                                      numbers.non_negative(F.col("l_quantity") - 25).alias("predicted_kwh"))
