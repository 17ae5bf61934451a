"""Completeness, audit and quality summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.bindings import Fixture
from catalog.registry import query
from heliospark import config
from heliospark.functions import labels
from heliospark.functions.solar import with_clearsky, with_solar_position
from heliospark.operators import completeness as quality
from heliospark.operators import daily
from heliospark.plans.clean_build import build_clean_dataset

def as_of():
    return F.expr("TIMESTAMP_NTZ'2024-03-01 12:00:00'")

_SUMMARY_SQL = """
WITH s AS (SELECT plant_id, plant_name, count(*) AS total_hourly_targets, count(*) FILTER (data_available) AS usable_hourly_targets,
  count(*) FILTER (elevation > 5) AS daylight_modeling_hours, count(*) FILTER (elevation > 5 AND data_available) AS usable_daylight_modeling_hours,
  CAST(sum(records_collected) AS BIGINT) AS five_min_records_collected, CAST(sum(expected_records) AS BIGINT) AS five_min_records_expected
  FROM hourly_sun GROUP BY 1, 2),
b AS (SELECT plant_id, covar_samp(five_min_kwh, billing_meter_kwh) / nullif(stddev_samp(five_min_kwh) * stddev_samp(billing_meter_kwh), 0) AS corr,
  sum(five_min_kwh) / nullif(sum(billing_meter_kwh), 0) AS ratio FROM aligned
  WHERE five_min_kwh IS NOT NULL AND billing_meter_kwh IS NOT NULL GROUP BY 1),
j AS (SELECT s.*, usable_hourly_targets * 100.0 / total_hourly_targets AS usable_hourly_targets_pct,
  usable_daylight_modeling_hours * 100.0 / nullif(daylight_modeling_hours, 0) AS usable_daylight_modeling_hours_pct,
  five_min_records_collected * 100.0 / five_min_records_expected AS five_min_record_completeness_pct,
  corr AS billing_meter_to_5min_overlap_corr, ratio AS five_min_total_div_billing_meter_total FROM s LEFT JOIN b USING (plant_id))
SELECT *, coalesce(nullif(concat_ws('; ', CASE WHEN usable_daylight_modeling_hours_pct < 60 THEN 'Low usable daylight coverage' END,
  CASE WHEN plant_name = 'Plant E' THEN 'Known source-data issue' END,
  CASE WHEN five_min_total_div_billing_meter_total < 0.8 OR five_min_total_div_billing_meter_total > 1.2
    THEN 'Billing-meter total differs from 5-minute inverter total' END), ''), 'None') AS warnings FROM j"""
_SUMMARY_DOUBLES = ("usable_hourly_targets_pct usable_daylight_modeling_hours_pct five_min_record_completeness_pct "
                    "billing_meter_to_5min_overlap_corr five_min_total_div_billing_meter_total")


def summary(x: Fixture) -> DataFrame:
    return quality.quality_summary(x.hourly, x.agreement, x.fleet)


def overview(x: Fixture) -> DataFrame:
    return quality.quality_overview(quality.daylight_availability(x.hourly), daily.source_summaries(x.aligned), x.fleet)


@query("quality_summary", "A6", _SUMMARY_SQL, _SUMMARY_DOUBLES)
def quality_summary(x: Fixture):
    return summary(x)


@query("clean_build_summary", "S6 A6", _SUMMARY_SQL, _SUMMARY_DOUBLES)
def clean_build_summary(x: Fixture):
    """The last table of the whole clean build, which depends on three of the others."""
    return build_clean_dataset(x.raw, x.fleet, 2)["data_quality_summary"]


@query("daylight_availability", "A7", "SELECT * FROM availability", "availability_pct")
def daylight_availability(x: Fixture):
    return quality.daylight_availability(x.hourly)


@query("source_completeness", "A14 A15 F8", """
WITH b AS (SELECT plant_id, date_trunc('hour', stamp) AS bucket, minute(stamp) AS m FROM fleet_log
  WHERE event_type = 'click' AND event_id % 103 <> 0),
s AS (SELECT plant_id, count(DISTINCT bucket) AS collected_records, min(bucket) AS first_bucket, max(bucket) AS last_bucket,
  count(DISTINCT m) AS distinct_minutes FROM b GROUP BY 1),
e AS (SELECT *, CAST(date_diff('hour', first_bucket, last_bucket) + 1 AS BIGINT) AS expected_records,
  CAST(floor(epoch(TIMESTAMP '2024-03-01 12:00:00' - last_bucket) / 86400) AS BIGINT) AS days_since_last_data FROM s)
SELECT plant_id, collected_records, first_bucket, last_bucket, CAST(distinct_minutes AS INTEGER) AS distinct_minutes, expected_records,
  days_since_last_data, greatest(expected_records - collected_records, 0) AS missing_records,
  collected_records * 100.0 / expected_records AS completeness_pct,
  CASE WHEN days_since_last_data <= 7 THEN 'CURRENT' WHEN days_since_last_data <= 30 THEN 'RECENT'
    WHEN days_since_last_data <= 90 THEN 'STALE' ELSE 'VERY STALE' END AS freshness, distinct_minutes > 2 AS irregular_minutes FROM e""",
       "completeness_pct")
def source_completeness(x: Fixture):
    return _completeness_of(x, "generation_hourly", "generation_date", 60)


def _completeness_of(x: Fixture, table: str, column: str, bucket: int) -> DataFrame:
    rows = quality_rows(x, table, column)
    return quality.source_completeness(rows, "utc", bucket, as_of())


def quality_rows(x: Fixture, table: str, column: str) -> DataFrame:
    from heliospark.functions.times import utc_to_local
    from heliospark.operators.cleaning import select_plants
    df = getattr(x, table)
    return select_plants(df, x.fleet).select("plant_id", utc_to_local(df, column, "UTC").alias("utc"))


_ROLE_SOURCES = {
    config.FIVE_MIN: ("generation_5min", "generation_date", 5),
    config.HOURLY_INVERTER: ("generation_hourly", "generation_date", 60),
    config.DAILY_INVERTER: ("generation_daily", "generation_date", 1440),
    config.HOURLY_METER: ("meter_hourly", "date", 60),
    config.BILLING_METER: ("meter_billing", "date", 1440),
}


@query("source_roles", "A16", """
WITH c AS (
  SELECT plant_id, 'five_min_kwh' AS source, count(DISTINCT stamp) * 100.0 / (epoch(max(stamp) - min(stamp)) / 300 + 1) AS pct
  FROM fleet_log WHERE event_id % 103 <> 0 GROUP BY 1
  UNION ALL SELECT plant_id, CASE event_type WHEN 'click' THEN 'hourly_inverter_kwh' ELSE 'hourly_meter_kwh' END,
  count(DISTINCT date_trunc('hour', stamp)) * 100.0 / (date_diff('hour', min(date_trunc('hour', stamp)), max(date_trunc('hour', stamp))) + 1)
  FROM fleet_log WHERE event_id % 103 <> 0 AND event_type IN ('click', 'signup') GROUP BY 1, 2
  UNION ALL SELECT plant_id, CASE event_type WHEN 'purchase' THEN 'daily_inverter_kwh' ELSE 'billing_meter_kwh' END,
  count(DISTINCT CAST(stamp AS DATE)) * 100.0 / (date_diff('day', min(CAST(stamp AS DATE)), max(CAST(stamp AS DATE))) + 1)
  FROM fleet_log WHERE event_id % 103 <> 0 AND event_type IN ('purchase', 'error') GROUP BY plant_id, event_type),
m AS (SELECT plant_id, pct AS model_pct FROM c WHERE source = 'five_min_kwh')
SELECT plant_id, source, pct AS completeness_pct, CASE
  WHEN source = 'five_min_kwh' AND model_pct < 95 THEN 'Primary model source (partial)'
  WHEN source LIKE '%meter%' AND model_pct < 70 THEN 'Fallback candidate + confirmation'
  WHEN source LIKE '%meter%' AND model_pct < 95 THEN 'Confirmation / fallback candidate'
  WHEN source = 'five_min_kwh' THEN 'Cleaned hourly model target source'
  WHEN source = 'hourly_inverter_kwh' THEN 'Confirmation / inverter cross-check'
  WHEN source = 'daily_inverter_kwh' THEN 'Aggregate confirmation'
  WHEN source = 'hourly_meter_kwh' THEN 'Meter cross-check' ELSE 'Aggregate meter check' END AS role
FROM c JOIN m USING (plant_id)""", "completeness_pct")
def source_roles(x: Fixture):
    parts = [_completeness_of(x, *spec).select("plant_id", F.lit(source).alias("source"), "completeness_pct")
             for source, spec in _ROLE_SOURCES.items()]
    return quality.source_roles(reduce(DataFrame.unionByName, parts))


@query("source_status", "A14 A15 A16", """
WITH c AS (
  SELECT plant_id, 'five_min_kwh' AS source, count(DISTINCT stamp) AS n, min(stamp) AS lo, max(stamp) AS hi, epoch(max(stamp) - min(stamp)) / 300 + 1 AS e,
  count(DISTINCT minute(stamp)) > 2 AS irregular_minutes FROM fleet_log WHERE event_id % 103 <> 0 GROUP BY 1
  UNION ALL SELECT plant_id, 'hourly_inverter_kwh', count(DISTINCT date_trunc('hour', stamp)), min(date_trunc('hour', stamp)), max(date_trunc('hour', stamp)),
  date_diff('hour', min(date_trunc('hour', stamp)), max(date_trunc('hour', stamp))) + 1, count(DISTINCT minute(stamp)) > 2
  FROM fleet_log WHERE event_id % 103 <> 0 AND event_type = 'click' GROUP BY 1
  UNION ALL SELECT 900001 + l_suppkey % 5, 'daily_inverter_kwh', count(DISTINCT l_shipdate), CAST(min(l_shipdate) AS TIMESTAMP), CAST(max(l_shipdate) AS TIMESTAMP),
  date_diff('day', CAST(min(l_shipdate) AS DATE), CAST(max(l_shipdate) AS DATE)) + 1, false FROM lineitem GROUP BY 1),
k AS (SELECT plant_id, source, status FROM fleet CROSS JOIN (VALUES ('five_min_kwh', 'Unavailable: no rows for selected plant'),
  ('hourly_inverter_kwh', 'Unavailable: no rows for selected plant'), ('daily_inverter_kwh', 'Unavailable: no rows for selected plant'),
  ('hourly_meter_kwh', 'Missing file'), ('billing_meter_kwh', 'Unavailable: required columns not found')) v(source, status)),
j AS (SELECT k.plant_id, k.source, CASE WHEN n IS NULL THEN k.status ELSE 'Available' END AS status, lo AS first_bucket, hi AS last_bucket,
  CAST(e AS BIGINT) AS expected_records, n AS collected_records, greatest(CAST(e AS BIGINT) - n, 0) AS missing_records, n * 100.0 / e AS completeness_pct,
  CAST(floor(epoch(TIMESTAMP '2024-03-01 12:00:00' - hi) / 86400) AS BIGINT) AS days_since_last_data, irregular_minutes
  FROM k LEFT JOIN c ON c.plant_id = k.plant_id AND c.source = k.source),
m AS (SELECT plant_id, completeness_pct AS model_pct FROM j WHERE source = 'five_min_kwh')
SELECT j.plant_id, source, status, first_bucket, last_bucket, expected_records, collected_records,
  CASE WHEN collected_records IS NOT NULL THEN missing_records END AS missing_records, completeness_pct, days_since_last_data,
  CASE WHEN status = 'Missing file' THEN 'Missing' WHEN status <> 'Available' THEN 'Unavailable' WHEN days_since_last_data <= 7 THEN 'CURRENT'
    WHEN days_since_last_data <= 30 THEN 'RECENT' WHEN days_since_last_data <= 90 THEN 'STALE' ELSE 'VERY STALE' END AS freshness,
  irregular_minutes, CASE WHEN source = 'five_min_kwh' AND model_pct < 95 THEN 'Primary model source (partial)'
    WHEN source = 'five_min_kwh' THEN 'Cleaned hourly model target source' WHEN source = 'hourly_inverter_kwh' THEN 'Confirmation / inverter cross-check'
    WHEN source = 'daily_inverter_kwh' THEN 'Aggregate confirmation' WHEN source = 'hourly_meter_kwh' THEN 'Meter cross-check'
    ELSE 'Aggregate meter check' END AS role
FROM j JOIN m USING (plant_id)""", "completeness_pct")
def source_status(x: Fixture):
    """One source is missing, one has lost its time column, and one, a log that ends years earlier, is stale."""
    old = x.history.select("plant_id", F.col("generation_date").cast("string").alias("generation_date"))
    return quality.source_status({
        config.FIVE_MIN: x.generation_5min, config.HOURLY_INVERTER: x.generation_hourly, config.DAILY_INVERTER: old,
        config.HOURLY_METER: None, config.BILLING_METER: x.meter_billing.withColumnRenamed("date", "day")}, x.fleet, as_of())


_OVERVIEW_DOUBLES = ("data_quality_score usable_daylight_pct source_agreement_score hourly_inverter_match_pct daily_inverter_ratio "
                     "daily_inverter_corr hourly_meter_ratio hourly_meter_corr billing_meter_ratio billing_meter_corr")


@query("quality_overview", "A17 L5", """
SELECT plant_id, plant_name, score AS data_quality_score, band AS data_quality_band, availability_pct AS usable_daylight_pct,
  source_score AS source_agreement_score, hm AS hourly_inverter_match_pct, dr AS daily_inverter_ratio, dc AS daily_inverter_corr,
  mr AS hourly_meter_ratio, mc AS hourly_meter_corr, br AS billing_meter_ratio, bc AS billing_meter_corr, warnings FROM overview""",
       _OVERVIEW_DOUBLES)
def quality_overview(x: Fixture):
    return overview(x)


@query("daily_completeness", "A18 J5", "SELECT * FROM completeness", "total_production completeness_pct")
def daily_completeness(x: Fixture):
    return quality.daily_completeness(x.audit_rows)


@query("incomplete_days", "L5 A18", """
SELECT plant_id, date, expected_records, records_collected, missing_records, completeness_pct, status FROM completeness
WHERE status <> 'Complete' ORDER BY completeness_pct, plant_id, date""", "completeness_pct")
def incomplete_days(x: Fixture):
    return quality.incomplete_days(quality.daily_completeness(x.audit_rows)).select(
        "plant_id", "date", "expected_records", "records_collected", "missing_records", "completeness_pct", "status")


_RANGE_SQL = """
SELECT plant_id, count(*) AS total_expected, count(kwh) AS total_collected FROM (
  SELECT plant_id, unnest(generate_series(min(generation_date), max(generation_date), INTERVAL '5 minutes')) AS generation_date
  FROM audit_rows GROUP BY 1) g LEFT JOIN audit_rows USING (plant_id, generation_date) GROUP BY 1"""


@query("range_completeness", "A19", f"""
SELECT *, total_expected - total_collected AS missing, total_collected * 100.0 / total_expected AS completeness_pct FROM ({_RANGE_SQL})""",
       "completeness_pct")
def range_completeness(x: Fixture):
    return quality.range_completeness(x.audit_rows).withColumnRenamed("total_missing", "missing")


_GAPS_SQL = """
SELECT plant_id, count(*) FILTER (gap > 3600) AS timestamp_gaps,
  coalesce(max(gap) FILTER (gap > 300), 0) / 3600 AS largest_gap_hours FROM (
  SELECT plant_id, epoch(generation_date - lag(generation_date) OVER (PARTITION BY plant_id ORDER BY generation_date)) AS gap FROM audit_rows)
GROUP BY 1"""


@query("timestamp_gaps", "W5", _GAPS_SQL, "largest_gap_hours")
def timestamp_gaps(x: Fixture):
    return quality.timestamp_gaps(x.audit_rows)


_AUDIT_SQL = f"""
WITH r AS (SELECT *, total_collected * 100.0 / total_expected AS completeness_pct FROM ({_RANGE_SQL})), g AS ({_GAPS_SQL}),
s AS (SELECT plant_id, min(generation_date) AS start_date, max(generation_date) AS end_date, count(*) FILTER (kwh < 0) AS negative_values,
  count(*) FILTER (elevation <= 0 AND kwh > 0.1) AS nighttime_production,
  count(*) FILTER ((hour(generation_date) >= 20 OR hour(generation_date) < 5) AND kwh > 0.1) AS clock_night FROM audit_sun GROUP BY 1)
SELECT s.*, total_expected, total_collected, completeness_pct, timestamp_gaps, largest_gap_hours,
  CAST(floor(epoch(TIMESTAMP '2024-03-01 12:00:00' - end_date) / 86400) AS BIGINT) AS days_since_last_data,
  CAST(floor(epoch(end_date - start_date) / 86400) + 1 AS BIGINT) AS total_days
FROM s JOIN r USING (plant_id) JOIN g USING (plant_id)"""


@query("audit", "A20 F6 F8", f"""
SELECT plant_id, start_date, end_date, negative_values, nighttime_production, total_expected, total_collected, completeness_pct, timestamp_gaps,
  largest_gap_hours, days_since_last_data, total_days, CASE WHEN days_since_last_data = 0 THEN 'CURRENT' WHEN days_since_last_data <= 7 THEN 'RECENT'
  WHEN days_since_last_data <= 30 THEN 'STALE' ELSE 'VERY STALE' END AS data_freshness FROM ({_AUDIT_SQL})""", "completeness_pct largest_gap_hours")
def audit(x: Fixture):
    return quality.audit(x.audit_rows, as_of()).drop("total_missing", "night_severity")


_ISSUES_SQL = """
SELECT plant_id, 'Coverage Gap' AS type, 'HIGH' AS severity, 'Data stops on ' || CAST(CAST(end_date AS DATE) AS VARCHAR) || ', ' || days_since_last_data || ' days ago' AS description,
  days_since_last_data AS count, CAST(NULL AS DOUBLE) AS largest_gap_hours FROM ({0}) WHERE days_since_last_data > 1
UNION ALL SELECT plant_id, 'Timestamp Gaps', 'MEDIUM', timestamp_gaps || ' gaps > 1 hour found in data sequence', timestamp_gaps, largest_gap_hours FROM ({0}) WHERE timestamp_gaps > 0
UNION ALL SELECT plant_id, 'Negative Values', 'HIGH', negative_values || ' records with negative generation', negative_values, NULL FROM ({0}) WHERE negative_values > 0
UNION ALL """
_NIGHT_SQL = """SELECT plant_id, 'Nighttime Production', '{1}', {2} || '{3}', {2}, NULL FROM ({0}) WHERE {2} > 0"""


@query("audit_issues", "A20", (_ISSUES_SQL + _NIGHT_SQL).format(
    _AUDIT_SQL, "MEDIUM", "nighttime_production", " records with production when sun is below horizon (solar elevation ≤ 0°)"), "largest_gap_hours")
def audit_issues(x: Fixture):
    return quality.audit_issues(quality.audit(x.audit_rows, as_of()))


@query("audit_issues_by_clock", "A20 P7", (_ISSUES_SQL + _NIGHT_SQL).format(
    _AUDIT_SQL, "LOW", "clock_night", " records with production during night hours (20:00-5:00) - approximate check"), "largest_gap_hours")
def audit_issues_by_clock(x: Fixture):
    return quality.audit_issues(quality.audit(x.audit_rows, as_of(), by_clock=True))


@query("completeness_grid", "A36 F15", """
SELECT plant_id, CAST(date_trunc('week', date) AS DATE) AS week_start, """ + ", ".join(
    f"max(completeness_pct) FILTER (isodow(date) = {i + 1}) AS {d}" for i, d in enumerate(["mon", "tue", "wed", "thu", "fri", "sat", "sun"])) + """
FROM completeness GROUP BY 1, 2""", "mon tue wed thu fri sat sun")
def completeness_grid(x: Fixture):
    return quality.completeness_grid(quality.daily_completeness(x.audit_rows))


@query("quality_cards", "A37", """
SELECT plant_id, plant_name, band, CASE WHEN availability_pct IS NULL THEN 'n/a' ELSE printf('%.1f%%', round_even(availability_pct, 1)) END AS completeness,
  warnings FROM overview""")
def quality_cards(x: Fixture):
    return quality.quality_cards(x.fleet, overview(x), summary(x))


@query("quality_cards_fallback", "A37", f"""
SELECT f.plant_id, f.plant_name, CASE WHEN s.plant_id IS NULL THEN 'Needs rebuild' WHEN usable_daylight_modeling_hours_pct >= 85 THEN 'Good'
  WHEN usable_daylight_modeling_hours_pct >= 60 THEN 'Usable' ELSE 'Poor' END AS band,
  CASE WHEN usable_daylight_modeling_hours_pct IS NULL THEN 'n/a' ELSE printf('%.1f%%', round_even(usable_daylight_modeling_hours_pct, 1)) END AS completeness,
  coalesce(s.warnings, 'Run the clean build') AS warnings FROM fleet f LEFT JOIN ({_SUMMARY_SQL}) s ON s.plant_id = f.plant_id""")
def quality_cards_fallback(x: Fixture):
    return quality.quality_cards(x.fleet, None, summary(x))


@query("solar_position", "F6", "SELECT plant_id, generation_date, elevation, azimuth FROM hourly_sun", "elevation azimuth")
def solar_position(x: Fixture):
    return with_solar_position(x.hourly.select("plant_id", "generation_date"))


@query("clearsky_expected", "F7", """
SELECT plant_id, generation_date, ghi, ghi / 1000 * plant_capacity * 0.82 AS clearsky_expected_kwh FROM hourly_sun JOIN fleet USING (plant_id)""",
       "ghi clearsky_expected_kwh")
def clearsky_expected(x: Fixture):
    rows = x.hourly.select("plant_id", "generation_date").join(x.fleet.select("plant_id", "plant_capacity"), "plant_id")
    return with_clearsky(with_solar_position(rows), F.col("plant_capacity")).select(
        "plant_id", "generation_date", "ghi", "clearsky_expected_kwh")


@query("score_bands", "F10", """
SELECT plant_id, band AS quality_band, CASE WHEN availability_pct IS NULL THEN NULL WHEN availability_pct >= 85 THEN 'good'
  WHEN availability_pct >= 60 THEN 'fair' ELSE 'poor' END AS completeness_band FROM overview""")
def score_bands(x: Fixture):
    return overview(x).select("plant_id", F.col("data_quality_band").alias("quality_band"),
                              labels.completeness_band(F.col("usable_daylight_pct")).alias("completeness_band"))
