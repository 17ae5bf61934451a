"""Scans, cleaning, hourly targets, daily agreement."""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.bindings import EXPECTED, Fixture
from catalog.registry import query
from heliospark import config
from heliospark.functions import labels, numbers, times
from heliospark.operators import cleaning, daily, hourly
from heliospark.plans import clean_build
from heliospark.sources import sinks, tables, weather
from heliospark.sources.forecast_payload import flatten_forecast
from heliospark.sources.intermediate import shared_folder


@query("scan_declared_schema", "S1", """
SELECT event_type, count(*) AS n, sum(value) AS total FROM events GROUP BY 1""", "total")
def scan_declared_schema(x: Fixture):
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    candidates = [f"{x.directory}/missing/events.parquet", f"{x.directory}/events.parquet"]
    return tables.read_table(x.spark, candidates, schema).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


@query("scan_pruned_columns", "S2", """
SELECT l_returnflag, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1""", "quantity")
def scan_pruned_columns(x: Fixture):
    df = tables.read_table(x.spark, f"{x.directory}/lineitem.parquet", columns=["l_returnflag", "l_quantity"])
    return df.groupBy("l_returnflag").agg(F.sum("l_quantity").alias("quantity"))


@query("read_or_build", "S3", """
SELECT plant_id, count(*) AS hours, count(generation_kwh) AS usable_hours FROM hourly GROUP BY 1""")
def read_or_build(x: Fixture):
    df = tables.read_or_build(x.spark, f"{x.directory}/clean/hourly_model_targets", lambda: x.hourly)
    return df.groupBy("plant_id").agg(F.count(F.lit(1)).alias("hours"), F.count("generation_kwh").alias("usable_hours"))


@query("optional_sources", "S4", """
SELECT plant_id, date, five_min_kwh, daily_inverter_kwh FROM (
  SELECT plant_id, date, max(kwh) FILTER (source = 'five') AS five_min_kwh, max(kwh) FILTER (source = 'daily') AS daily_inverter_kwh
  FROM log_days WHERE source IN ('five', 'daily') GROUP BY 1, 2)""", "five_min_kwh daily_inverter_kwh")
def optional_sources(x: Fixture):
    """One source file is absent and the meters lack a required column, so three sources drop out."""
    missing = tables.optional_table(x.spark, f"{x.directory}/no_such_log.parquet")
    no_meter_id = x.meter_billing.drop("meter_id")
    raw = {**x.daily_raw, "generation_hourly": missing, "meter_hourly": x.meter_hourly.drop("meter_id"), "meter_billing": no_meter_id}
    return clean_build.aligned_sources(raw, x.fleet).select("plant_id", "date", "five_min_kwh", "daily_inverter_kwh")


@query("flatten_forecast", "S5", "SELECT * FROM forecast_rows",
       "temp feels_like pressure humidity clouds_all wind_speed wind_deg visibility rain_1h")
def flatten_forecast_query(x: Fixture):
    return flatten_forecast(x.payloads)


@query("weather_outlook", "S8", "SELECT * FROM outlook",
       "temp pressure humidity clouds_all wind_speed feels_like wind_deg visibility rain_1h")
def weather_outlook_query(x: Fixture):
    return weather.weather_outlook(x.weather_raw)


@query("weather_outlook_absent_columns", "S8", """
SELECT timestamp, temp, pressure, humidity, clouds_all, wind_speed, temp AS feels_like, 0.0 AS wind_deg,
  10000.0 AS visibility, 0.0 AS rain_1h FROM outlook""",
       "temp pressure humidity clouds_all wind_speed feels_like wind_deg visibility rain_1h")
def weather_outlook_absent(x: Fixture):
    return weather.weather_outlook(x.weather_raw.drop("feels_like", "wind_deg", "visibility", "rain_1h"))


@query("select_plants", "P1", """
SELECT plant_id, count(*) AS n FROM raw_log WHERE plant_id IN (SELECT plant_id FROM fleet) GROUP BY 1""")
def select_plants(x: Fixture):
    return cleaning.select_plants(x.generation_5min, x.fleet).groupBy("plant_id").agg(F.count(F.lit(1)).alias("n"))


@query("clean_plants", "P2 L5", """
SELECT f.plant_id, f.plant_name, CASE WHEN r_regionkey % 2 = 0 THEN 'Roof' ELSE 'Solar Region' END AS plant_address,
  200.0 + r_regionkey * 50 AS plant_capacity, true AS selected_for_dashboard
FROM region JOIN fleet f ON f.plant_id = 900001 + r_regionkey ORDER BY ordinal""", "plant_capacity")
def clean_plants(x: Fixture):
    return cleaning.clean_plants(x.plants, x.fleet)


@query("normalize_names", "P3", """
SELECT coalesce(a.label, o.name) AS plant_name, count(*) AS n
FROM (SELECT CASE l_linenumber WHEN 1 THEN 'Demo Plant A' WHEN 2 THEN 'Demo Plant E (Low Quality)' WHEN 3 THEN 'Demo Plant C'
  WHEN 4 THEN 'Plant B' ELSE 'Other ' || l_returnflag END AS name FROM lineitem) o LEFT JOIN aliases a ON a.alias = o.name GROUP BY 1""")
def normalize_names(x: Fixture):
    line = F.col("l_linenumber")
    old = (F.when(line == 1, "Demo Plant A").when(line == 2, "Demo Plant E (Low Quality)").when(line == 3, "Demo Plant C")
           .when(line == 4, "Plant B").otherwise(F.concat(F.lit("Other "), "l_returnflag")))
    named = x.table("lineitem").select(old.alias("plant_name"))
    return cleaning.normalize_names(named).groupBy("plant_name").agg(F.count(F.lit(1)).alias("n"))


@query("clean_generation", "P4 W9 F1 F2", """
SELECT plant_id, plant_name, generation_date, wh AS generation_amount_wh, kwh AS generation_kwh, false AS is_negative_generation,
  copies AS duplicate_rows_removed_for_same_plant_timestamp FROM gen_clean JOIN fleet USING (plant_id)""",
       "generation_amount_wh generation_kwh")
def clean_generation(x: Fixture):
    return x.generation.select("plant_id", "plant_name", "generation_date", "generation_amount_wh", "generation_kwh",
                               "is_negative_generation", "duplicate_rows_removed_for_same_plant_timestamp")


@query("dedup_last", "W9", """
SELECT plant_id, stamp, arg_max(value, event_id) AS value, arg_max(event_type, event_id) AS event_type
FROM raw_log GROUP BY 1, 2""", "value")
def dedup_last(x: Fixture):
    rows = x.events.select("plant_id", "stamp", "value", "event_type", "ingest_seq")
    return cleaning.dedup_last(rows, ["plant_id", "stamp"], ["ingest_seq"]).drop("ingest_seq")


@query("duplicate_audit", "W12", """
SELECT plant_id, CAST(sum(n) AS BIGINT) AS total_rows, CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS duplicated_rows,
  CAST(sum(n - 1) AS BIGINT) AS rows_removed
FROM (SELECT plant_id, local_ts, count(*) AS n FROM fleet_log WHERE local_ts IS NOT NULL GROUP BY 1, 2) GROUP BY 1""")
def duplicate_audit(x: Fixture):
    return cleaning.duplicate_audit(x.generation_5min, x.fleet)


@query("parsed_amounts", "F1", """
SELECT event_id, try_cast(replace(CASE WHEN event_id % 101 = 0 THEN 'n/a'
  WHEN event_id % 97 = 0 THEN '-' || format('{:,}', CAST(round(value * 100) AS BIGINT))
  ELSE format('{:,}', CAST(round(value * 100) AS BIGINT)) END, ',', '') AS DOUBLE) AS amount FROM events""", "amount")
def parsed_amounts(x: Fixture):
    return x.generation_5min.select(F.col("ingest_seq").alias("event_id"), numbers.numeric_amount("generation_amount").alias("amount"))


@query("utc_to_local", "F2", """
SELECT event_id, try_cast(CASE WHEN event_id % 103 = 0 THEN 'not a time'
  ELSE strftime(time_bucket(INTERVAL '5 minutes', ts), '%Y-%m-%d %H:%M:%S') END AS TIMESTAMP) + INTERVAL '6 hours' AS local_ts
FROM events""")
def utc_to_local(x: Fixture):
    df = x.generation_5min
    return df.select(F.col("ingest_seq").alias("event_id"), times.utc_to_local(df, "generation_date").alias("local_ts"))


@query("floor_buckets", "F3", """
SELECT event_id, time_bucket(INTERVAL '5 minutes', ts) AS b5, date_trunc('hour', ts) AS b60,
  time_bucket(INTERVAL '3 hours', ts) AS b180, CAST(date_trunc('day', ts) AS TIMESTAMP) AS b1440 FROM events""")
def floor_buckets(x: Fixture):
    return x.events.select("event_id", *[times.floor_bucket("ts", m).alias(f"b{m}") for m in (5, 60, 180, 1440)])


@query("join_plant_dimension", "J1", """
SELECT plant_id, plant_name, count(*) AS n, sum(value) AS total FROM raw_log LEFT JOIN fleet USING (plant_id) GROUP BY 1, 2""", "total")
def join_plant_dimension(x: Fixture):
    return cleaning.with_plant_name(x.events.select("plant_id", "value"), x.fleet).groupBy("plant_id", "plant_name").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


@query("hourly_targets", "A1 J5 U1", """
SELECT plant_id, plant_name, generation_date, generation_kwh, generation_kwh_raw, records_collected, expected_records, missing_records,
  data_completeness_pct, data_available, '5min_inverter_cleaned' AS target_source,
  CASE WHEN data_available THEN 'usable_5min_hour' ELSE 'incomplete_hour_excluded' END AS target_quality_flag FROM hourly""",
       "generation_kwh generation_kwh_raw data_completeness_pct")
def hourly_targets(x: Fixture):
    return x.hourly


@query("clean_tables_round_trip", "S6", """
SELECT plant_id, generation_date, generation_kwh, records_collected, data_available FROM hourly""", "generation_kwh")
def clean_tables_round_trip(x: Fixture):
    """Hourly targets as written to and read back from the clean folder."""
    folder = f"{shared_folder(x.spark)}/clean-{uuid.uuid4().hex}"
    sinks.write_clean({"hourly_model_targets": x.hourly, "plants_clean": x.fleet}, folder)
    back = sinks.read_clean(x.spark, folder, "hourly_model_targets")
    return back.selectExpr("CAST(plant_id AS BIGINT) AS plant_id", "generation_date", "generation_kwh", "records_collected", "data_available")


_SIX_TABLES = {
    "plants_clean": ("SELECT 200.0 + r_regionkey * 50 AS v FROM region JOIN fleet f ON f.plant_id = 900001 + r_regionkey", "plant_capacity"),
    "generation_5min_clean": ("SELECT kwh AS v FROM gen_clean", "generation_kwh"),
    "hourly_model_targets": ("SELECT generation_kwh AS v FROM hourly", "generation_kwh"),
    "daily_source_agreement": ("SELECT five_min_kwh AS v FROM agreement", "five_min_kwh"),
    "weather_hourly_clean": ("SELECT temp AS v FROM weather", "temp"),
    "data_quality_summary": ("SELECT DISTINCT plant_id * 1.0 AS v FROM hourly", "plant_id"),
}


@query("clean_versions_round_trip", "S3 S6", " UNION ALL ".join(
    f"SELECT '{name}' AS name, count(*) AS n, sum(v) AS total FROM ({rows})" for name, (rows, _) in _SIX_TABLES.items()), "total")
def clean_versions_round_trip(x: Fixture):
    """All six clean tables, written as one version after another and read back through the manifest."""
    folder = f"{shared_folder(x.spark)}/clean-{uuid.uuid4().hex}"
    built = clean_build.build_clean_dataset(x.raw, x.fleet, EXPECTED)
    sinks.write_version({"plants_clean": x.fleet.limit(0)}, folder)
    sinks.write_version(built, folder)
    parts = [sinks.read_version(x.spark, folder, name).agg(F.lit(name).alias("name"), F.count("*").alias("n"), F.sum(F.col(c).cast("double")).alias("total"))
             for name, (_, c) in _SIX_TABLES.items()]
    return functools.reduce(DataFrame.unionByName, parts)


@query("daily_log", "A2", """
SELECT plant_id, date, 'five_min_kwh' AS source, kwh, records FROM log_days WHERE source = 'five'""", "kwh")
def daily_log(x: Fixture):
    return daily.daily_log(x.generation_5min, x.fleet, config.FIVE_MIN, 1000.0)


@query("daily_log_shifted", "A2", """
SELECT plant_id, date, 'daily_inverter_kwh' AS source, kwh, records FROM log_days WHERE source = 'daily'""", "kwh")
def daily_log_shifted(x: Fixture):
    return daily.daily_log(x.generation_daily, x.fleet, config.DAILY_INVERTER, 1.0, shift_days=-1)


@query("daily_meter", "A3 W4", """
SELECT plant_id, date, 'billing_meter_kwh' AS source, kwh, records FROM meter_days WHERE event_type = 'error'""", "kwh")
def daily_meter(x: Fixture):
    return daily.daily_meter(x.meter_billing, x.fleet, config.BILLING_METER)


@query("align_daily_sources", "J3", "SELECT * FROM aligned",
       "five_min_kwh hourly_inverter_kwh daily_inverter_kwh hourly_meter_kwh billing_meter_kwh")
def align_daily_sources(x: Fixture):
    return x.aligned


@query("daily_agreement", "A4", """
SELECT plant_id, plant_name, date, five_min_kwh, hourly_inverter_kwh_minus_5min_kwh, daily_inverter_kwh_minus_5min_kwh,
  hourly_meter_kwh_minus_5min_kwh, billing_meter_kwh_minus_5min_kwh, hourly_inverter_kwh_ratio_to_5min, daily_inverter_kwh_ratio_to_5min,
  hourly_meter_kwh_ratio_to_5min, billing_meter_kwh_ratio_to_5min, source_agreement_flag FROM agreement JOIN fleet USING (plant_id)""",
       "five_min_kwh hourly_inverter_kwh_minus_5min_kwh daily_inverter_kwh_minus_5min_kwh hourly_meter_kwh_minus_5min_kwh "
       "billing_meter_kwh_minus_5min_kwh hourly_inverter_kwh_ratio_to_5min daily_inverter_kwh_ratio_to_5min "
       "hourly_meter_kwh_ratio_to_5min billing_meter_kwh_ratio_to_5min")
def daily_agreement(x: Fixture):
    df = x.agreement
    kept = [c for c in df.columns if c.endswith(("_minus_5min_kwh", "_ratio_to_5min"))]
    return df.select("plant_id", "plant_name", "date", "five_min_kwh", *kept, "source_agreement_flag")


@query("clean_weather", "A5", "SELECT * FROM weather",
       "temp visibility rain_1h clouds_all pressure humidity wind_speed feels_like wind_deg")
def clean_weather(x: Fixture):
    return x.weather


@query("source_summaries", "A8", "SELECT * FROM summaries",
       "correlation source_to_5min_total daily_mae_kwh max_abs_diff_kwh matching_days_pct")
def source_summaries(x: Fixture):
    return daily.source_summaries(x.aligned)


@query("weak_days", "A9", "SELECT plant_id, date FROM weak")
def weak_days(x: Fixture):
    return daily.weak_days(x.agreement, x.fleet)


@query("filter_source_agreement", "J6", """
SELECT plant_id, count(*) AS hours, count(generation_kwh) AS targets, min(generation_date) AS first_hour FROM hourly h
WHERE NOT EXISTS (SELECT 1 FROM weak w WHERE w.plant_id = h.plant_id AND w.date = CAST(h.generation_date AS DATE)) GROUP BY 1""")
def filter_source_agreement(x: Fixture):
    kept = daily.filter_source_agreement(x.hourly, x.agreement, x.fleet)
    return kept.groupBy("plant_id").agg(F.count(F.lit(1)).alias("hours"), F.count("generation_kwh").alias("targets"),
                                        F.min("generation_date").alias("first_hour"))


@query("hourly_source_diagnostics", "A10 J4", """
SELECT plant_id, generation_date, raw AS generation_kwh_5min_raw, n AS records_collected_5min, pct AS data_completeness_pct,
  five_ok AS five_min_available, hourly AS generation_kwh_hourly, hourly_records, final AS generation_kwh_final, target_source,
  target_source = 'hourly_inverter_fallback' AS target_is_fallback,
  hourly - raw AS delta_kwh_hourly_minus_5min, delta_pct AS delta_pct_hourly_vs_5min, flag AS target_quality_flag,
  CAST(score AS INTEGER) AS target_quality_score FROM diagnostics""",
       "generation_kwh_5min_raw data_completeness_pct generation_kwh_hourly generation_kwh_final delta_kwh_hourly_minus_5min delta_pct_hourly_vs_5min")
def hourly_source_diagnostics(x: Fixture):
    return _diagnostics(x).select(
        "plant_id", "generation_date", "generation_kwh_5min_raw", "records_collected_5min", "data_completeness_pct", "five_min_available",
        "generation_kwh_hourly", "hourly_records", "generation_kwh_final", "target_source", "target_is_fallback",
        "delta_kwh_hourly_minus_5min", "delta_pct_hourly_vs_5min", "target_quality_flag", "target_quality_score")


@query("source_diagnostics_without_log", "A10", """
SELECT plant_id, generation_date, raw AS generation_kwh_5min_raw, n AS records_collected_5min, pct AS data_completeness_pct, five_ok AS five_min_available,
  CASE WHEN five_ok THEN raw END AS generation_kwh_final, CASE WHEN five_ok THEN '5min_inverter' ELSE 'missing' END AS target_source,
  CASE WHEN five_ok THEN '5min_primary' ELSE 'missing' END AS target_quality_flag, CAST(CASE WHEN five_ok THEN 3 ELSE 0 END AS INTEGER) AS target_quality_score
FROM diagnostics WHERE n IS NOT NULL""", "generation_kwh_5min_raw data_completeness_pct generation_kwh_final")
def source_diagnostics_without_log(x: Fixture):
    """The diagnosis where no hourly log is given."""
    return hourly.hourly_source_diagnostics(x.generation_5min, None, x.fleet, EXPECTED).select(
        "plant_id", "generation_date", "generation_kwh_5min_raw", "records_collected_5min", "data_completeness_pct", "five_min_available",
        "generation_kwh_final", "target_source", "target_quality_flag", "target_quality_score")


def _diagnostics(x: Fixture):
    return hourly.hourly_source_diagnostics(x.generation_5min, x.generation_hourly, x.fleet, EXPECTED)


@query("hourly_difference", "A11", """
SELECT plant_id, date, hourly_inverter_kwh - five_min_kwh AS hourly_difference_kwh, abs(hourly_inverter_kwh - five_min_kwh) AS hourly_abs_difference_kwh,
  (hourly_inverter_kwh - five_min_kwh) / nullif(five_min_kwh, 0) * 100 AS hourly_pct_difference FROM aligned""",
       "hourly_difference_kwh hourly_abs_difference_kwh hourly_pct_difference")
def hourly_difference(x: Fixture):
    return daily.hourly_difference(x.aligned).select(
        "plant_id", "date", "hourly_difference_kwh", "hourly_abs_difference_kwh", "hourly_pct_difference")


@query("control_deltas", "A12 F12", """
WITH c AS (SELECT plant_id, CAST(generation_date AS DATE) AS date, sum(final) AS kwh FROM diagnostics GROUP BY 1, 2),
p AS (SELECT c.plant_id, s.control_source, c.kwh AS cand, s.kwh AS ctrl FROM c JOIN (
  SELECT plant_id, date, 'Daily inverter control' AS control_source, daily_inverter_kwh AS kwh FROM aligned
  UNION ALL SELECT plant_id, date, 'Hourly meter control', hourly_meter_kwh FROM aligned
  UNION ALL SELECT plant_id, date, 'Billing meter control', billing_meter_kwh FROM aligned) s USING (plant_id, date)
  WHERE c.kwh IS NOT NULL AND s.kwh IS NOT NULL),
g AS (SELECT plant_id, control_source, count(*) AS overlap_days, sum(cand) / nullif(sum(ctrl), 0) AS candidate_to_control_total,
  avg(cand - ctrl) AS mean_delta_kwh, min(cand - ctrl) AS min_delta_kwh, max(cand - ctrl) AS max_delta_kwh, avg(abs(cand - ctrl)) AS mae_kwh
  FROM p GROUP BY 1, 2)
SELECT *, CASE WHEN candidate_to_control_total IS NULL THEN 'n/a' WHEN abs((candidate_to_control_total - 1) * 100) <= 5 THEN 'Close agreement'
  ELSE 'Candidate is ' || CAST(CAST(round_even(abs((candidate_to_control_total - 1) * 100), 0) AS BIGINT) AS VARCHAR) || '% ' ||
    CASE WHEN candidate_to_control_total > 1 THEN 'higher' ELSE 'lower' END || ' than control' END AS interpretation FROM g""",
       "candidate_to_control_total mean_delta_kwh min_delta_kwh max_delta_kwh mae_kwh")
def control_deltas(x: Fixture):
    return daily.control_deltas(daily.candidate_with_controls(_diagnostics(x), x.aligned))


@query("billing_agreement", "A13", """
WITH f AS (SELECT plant_id, CAST(local_ts AS DATE) AS date, coalesce(sum(wh), 0) / 1000 AS five FROM fleet_log WHERE local_ts IS NOT NULL GROUP BY 1, 2),
m AS (SELECT plant_id, date, coalesce(kwh, 0) AS meter FROM meter_days WHERE event_type = 'error')
SELECT plant_id, count(*) AS overlap_days, covar_samp(five, meter) / nullif(stddev_samp(five) * stddev_samp(meter), 0) AS correlation,
  sum(five) / nullif(sum(meter), 0) AS sum_ratio, avg(abs(five - meter)) AS mae_kwh
FROM f JOIN m USING (plant_id, date) GROUP BY 1 HAVING count(*) >= 10""", "correlation sum_ratio mae_kwh")
def billing_agreement(x: Fixture):
    return daily.billing_agreement(x.generation_5min, x.meter_billing, x.fleet)


@query("target_confidence_grid", "A36", """
WITH d AS (SELECT *, max(generation_date) OVER (PARTITION BY plant_id) AS latest FROM diagnostics)
SELECT plant_id, CAST(generation_date AS DATE) AS date, """ + ", ".join(
    f"CAST(max(score) FILTER (hour(generation_date) = {h}) AS INTEGER) AS h{h:02d}" for h in range(24)) + """
FROM d WHERE generation_date >= latest - INTERVAL '90 days' GROUP BY 1, 2""")
def target_confidence_grid(x: Fixture):
    return hourly.target_confidence_grid(_diagnostics(x))


@query("target_shares", "A38", """
SELECT plant_id, count(*) AS total_hours, count(final) * 100.0 / count(*) AS usable_pct,
  count(*) FILTER (target_source = '5min_inverter') * 100.0 / count(*) AS five_min_pct,
  count(*) FILTER (target_source = 'hourly_inverter_fallback') * 100.0 / count(*) AS fallback_pct,
  count(*) FILTER (target_source = 'missing') * 100.0 / count(*) AS missing_pct FROM diagnostics GROUP BY 1""",
       "usable_pct five_min_pct fallback_pct missing_pct")
def target_shares(x: Fixture):
    return hourly.target_shares(_diagnostics(x))


@query("kpi_bands", "F8 F9 F10 F14", """
SELECT plant_id, source, correlation, source_to_5min_total, CASE WHEN correlation IS NOT NULL THEN greatest(0, least(100, correlation * 100)) END AS corr_score,
  CASE WHEN source_to_5min_total IS NOT NULL THEN greatest(0, 100 - abs(source_to_5min_total - 1) * 100) END AS ratio_score,
  CASE WHEN source_to_5min_total IS NULL THEN 'missing' WHEN abs(source_to_5min_total - 1) <= 0.05 THEN 'close'
    WHEN abs(source_to_5min_total - 1) <= 0.2 THEN 'moderate' WHEN abs(source_to_5min_total - 1) <= 0.5 THEN 'wide' ELSE 'far' END AS ratio_band,
  CASE WHEN matching_days_pct >= 90 THEN 'high' WHEN matching_days_pct >= 70 THEN 'medium' WHEN matching_days_pct >= 50 THEN 'low' ELSE 'very low' END AS match_band,
  CASE WHEN correlation >= 0.5 THEN 'good' WHEN correlation >= 0 THEN 'fair' WHEN correlation < 0 THEN 'poor' END AS r2_band,
  CASE WHEN daily_mae_kwh <= 50 THEN 'good' WHEN daily_mae_kwh <= 70 THEN 'fair' ELSE 'poor' END AS wape_band,
  CASE WHEN overlap_days >= 85 THEN 'good' WHEN overlap_days >= 60 THEN 'fair' ELSE 'poor' END AS completeness_band,
  CASE WHEN overlap_days <= 7 THEN 'CURRENT' WHEN overlap_days <= 30 THEN 'RECENT' WHEN overlap_days <= 90 THEN 'STALE' ELSE 'VERY STALE' END AS source_freshness,
  CASE WHEN overlap_days = 0 THEN 'CURRENT' WHEN overlap_days <= 7 THEN 'RECENT' WHEN overlap_days <= 30 THEN 'STALE' ELSE 'VERY STALE' END AS audit_freshness
FROM summaries""", "correlation source_to_5min_total corr_score ratio_score")
def kpi_bands(x: Fixture):
    df = daily.source_summaries(x.aligned)
    corr, total = F.col("correlation"), F.col("source_to_5min_total")
    days = F.col("overlap_days")
    return df.select(
        "plant_id", "source", "correlation", "source_to_5min_total", numbers.score_correlation(corr).alias("corr_score"),
        numbers.score_closeness(total).alias("ratio_score"), labels.ratio_band(total).alias("ratio_band"),
        labels.percentage_band(F.col("matching_days_pct")).alias("match_band"), labels.r2_band(corr).alias("r2_band"),
        labels.wape_band(F.col("daily_mae_kwh")).alias("wape_band"), labels.completeness_band(days).alias("completeness_band"),
        labels.source_freshness(days).alias("source_freshness"), labels.audit_freshness(days).alias("audit_freshness"))
