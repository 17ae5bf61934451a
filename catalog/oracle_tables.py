"""SQL definitions of the bound tables, written independently of the Spark code."""

from __future__ import annotations

import re

from heliospark import config
from heliospark.config import FLEET, NAME_ALIASES

_FLEET_ROWS = ", ".join(
    f"({i}, '{n}', {c}::DOUBLE, DATE '{d}', {m}::DOUBLE, {str(r).lower()}, {k})" for k, (i, n, c, d, m, r) in enumerate(FLEET))
_ALIAS_ROWS = ", ".join(f"('{a}', '{b}')" for a, b in NAME_ALIASES.items())

TABLES: dict[str, str] = {}

TABLES["fleet"] = f"""
SELECT CAST(plant_id AS BIGINT) AS plant_id, plant_name, plant_capacity, split_date, max_ratio_difference, reliable, ordinal
FROM (VALUES {_FLEET_ROWS}) v(plant_id, plant_name, plant_capacity, split_date, max_ratio_difference, reliable, ordinal)"""

TABLES["aliases"] = f"SELECT * FROM (VALUES {_ALIAS_ROWS}) v(alias, label)"

TABLES["raw_log"] = """
SELECT event_id, event_type, value, CAST(900001 + user_id % 6 AS BIGINT) AS plant_id, user_id % 3 AS meter_id,
  time_bucket(INTERVAL '5 minutes', ts) AS stamp,
  CASE WHEN event_id % 103 <> 0 THEN time_bucket(INTERVAL '5 minutes', ts) + INTERVAL '6 hours' END AS local_ts,
  CASE WHEN event_id % 101 = 0 THEN NULL WHEN event_id % 97 = 0 THEN -1.0 ELSE 1.0 END AS sign
FROM events"""

TABLES["fleet_log"] = """
SELECT r.*, sign * round(value * 100) AS wh FROM raw_log r WHERE plant_id IN (SELECT plant_id FROM fleet)"""

TABLES["gen_clean"] = """
SELECT plant_id, local_ts AS generation_date, arg_max(wh, event_id) AS wh, arg_max(wh, event_id) / 1000 AS kwh,
  count(*) - 1 AS copies
FROM fleet_log WHERE local_ts IS NOT NULL AND wh >= 0 GROUP BY plant_id, local_ts"""

TABLES["audit_rows"] = """
SELECT plant_id, local_ts AS generation_date, arg_max_null(wh, event_id) / 1000 AS kwh
FROM fleet_log WHERE local_ts IS NOT NULL GROUP BY plant_id, local_ts"""

TABLES["hour_sums"] = """
SELECT plant_id, date_trunc('hour', generation_date) AS generation_date, sum(kwh) AS raw, count(*) AS n
FROM gen_clean GROUP BY 1, 2"""

TABLES["hour_grid"] = """
SELECT plant_id, unnest(generate_series(min(generation_date), max(generation_date), INTERVAL '1 hour')) AS generation_date
FROM hour_sums GROUP BY plant_id"""

TABLES["hourly"] = """
SELECT g.plant_id, f.plant_name, g.generation_date, s.raw AS generation_kwh_raw, coalesce(s.n, 0) AS records_collected,
  CAST(2 AS BIGINT) AS expected_records, 2 - coalesce(s.n, 0) AS missing_records,
  coalesce(s.n, 0) / 2.0 * 100 AS data_completeness_pct, coalesce(s.n, 0) / 2.0 * 100 >= 80 AS data_available,
  CASE WHEN coalesce(s.n, 0) / 2.0 * 100 >= 80 THEN s.raw END AS generation_kwh
FROM hour_grid g JOIN fleet f USING (plant_id) LEFT JOIN hour_sums s USING (plant_id, generation_date)"""

TABLES["meter_rows"] = """
SELECT plant_id, meter_id, event_type, local_ts, CASE WHEN event_id % 101 <> 0 THEN value * 1000 END AS reading
FROM fleet_log WHERE event_type IN ('signup', 'error')"""

TABLES["meter_steps"] = """
SELECT plant_id, event_type, CAST(local_ts AS DATE) AS date,
  (reading - lag(reading) OVER (PARTITION BY plant_id, event_type, meter_id ORDER BY local_ts, reading)) / 1000 AS kwh
FROM meter_rows WHERE local_ts IS NOT NULL AND reading IS NOT NULL"""

TABLES["meter_days"] = """
SELECT plant_id, event_type, date, sum(CASE WHEN kwh >= 0 THEN kwh END) AS kwh,
  count(CASE WHEN kwh >= 0 THEN 1 END) AS records
FROM meter_steps GROUP BY 1, 2, 3"""

TABLES["log_days"] = """
SELECT plant_id, CAST(local_ts AS DATE) AS date, 'five' AS source, sum(wh) / 1000 AS kwh, count(*) AS records
FROM fleet_log WHERE local_ts IS NOT NULL AND wh IS NOT NULL GROUP BY 1, 2
UNION ALL
SELECT plant_id, CAST(local_ts AS DATE), 'hourly', sum(sign * round(value * 500)) / 1000, count(*)
FROM fleet_log WHERE local_ts IS NOT NULL AND sign IS NOT NULL AND event_type = 'click' GROUP BY 1, 2
UNION ALL
SELECT plant_id, CAST(local_ts AS DATE), 'daily', sum(sign * value * 0.5), count(*)
FROM fleet_log WHERE local_ts IS NOT NULL AND sign IS NOT NULL AND event_type = 'purchase' GROUP BY 1, 2"""

TABLES["aligned"] = """
SELECT plant_id, date,
  five.kwh AS five_min_kwh, CAST(five.records AS BIGINT) AS five_min_kwh_records,
  hourly.kwh AS hourly_inverter_kwh, CAST(hourly.records AS BIGINT) AS hourly_inverter_kwh_records,
  daily.kwh AS daily_inverter_kwh, CAST(daily.records AS BIGINT) AS daily_inverter_kwh_records,
  hm.kwh AS hourly_meter_kwh, CAST(hm.records AS BIGINT) AS hourly_meter_kwh_records,
  bm.kwh AS billing_meter_kwh, CAST(bm.records AS BIGINT) AS billing_meter_kwh_records
FROM (SELECT * FROM log_days WHERE source = 'five') five
FULL JOIN (SELECT * FROM log_days WHERE source = 'hourly') hourly USING (plant_id, date)
FULL JOIN (SELECT * FROM log_days WHERE source = 'daily') daily USING (plant_id, date)
FULL JOIN (SELECT * FROM meter_days WHERE event_type = 'signup') hm USING (plant_id, date)
FULL JOIN (SELECT * FROM meter_days WHERE event_type = 'error') bm USING (plant_id, date)"""

_RATIOS = ", ".join(
    f"{s} - five_min_kwh AS {s}_minus_5min_kwh, "
    f"CASE WHEN abs(five_min_kwh) > 0.01 THEN {s} / five_min_kwh END AS {s}_ratio_to_5min"
    for s in ("hourly_inverter_kwh", "daily_inverter_kwh", "hourly_meter_kwh", "billing_meter_kwh"))

TABLES["measured"] = f"SELECT *, {_RATIOS} FROM aligned"

TABLES["agreement"] = """
SELECT m.*, CASE WHEN d IS NULL THEN 'no_reference_overlap' WHEN d <= 0.05 THEN 'close_agreement'
  WHEN d <= 0.20 THEN 'moderate_difference' ELSE 'large_difference' END AS source_agreement_flag
FROM (SELECT *, least(abs(hourly_inverter_kwh_ratio_to_5min - 1), abs(daily_inverter_kwh_ratio_to_5min - 1),
  abs(hourly_meter_kwh_ratio_to_5min - 1), abs(billing_meter_kwh_ratio_to_5min - 1)) AS d FROM measured) m"""

TABLES["weak"] = """
SELECT a.plant_id, a.date FROM agreement a JOIN fleet f USING (plant_id)
WHERE five_min_kwh >= 1.0 AND abs(daily_inverter_kwh_ratio_to_5min - 1) > max_ratio_difference"""

TABLES["weather_rows"] = """
SELECT time_bucket(INTERVAL '1 hour', ts) + INTERVAL '6 hours' AS generation_date,
  CASE WHEN event_id % 89 <> 0 THEN 15.0 + value / 10 END AS temp, 10000.0 - value * 20 AS visibility,
  CASE WHEN value > 100 THEN value - 100 END AS rain_1h, least(100.0, value) AS clouds_all,
  1000.0 + value / 20 AS pressure, least(100.0, 40.0 + value / 2) AS humidity, value / 25 AS wind_speed,
  CASE WHEN event_id % 7 <> 0 THEN 14.0 + value / 10 END AS feels_like,
  CASE WHEN event_id % 11 <> 0 THEN CAST(event_id * 37 % 360 AS DOUBLE) END AS wind_deg
FROM events WHERE event_type = 'error'"""

TABLES["weather"] = """
SELECT generation_date, avg(temp) AS temp, avg(visibility) AS visibility, avg(coalesce(rain_1h, 0)) AS rain_1h,
  avg(clouds_all) AS clouds_all, avg(pressure) AS pressure, avg(humidity) AS humidity, avg(wind_speed) AS wind_speed,
  avg(feels_like) AS feels_like, avg(wind_deg) AS wind_deg
FROM weather_rows GROUP BY 1"""

TABLES["outlook"] = """
SELECT generation_date AS timestamp, temp, pressure, humidity, clouds_all, wind_speed,
  coalesce(feels_like, temp) AS feels_like, coalesce(wind_deg, 0.0) AS wind_deg, coalesce(visibility, 10000.0) AS visibility,
  coalesce(rain_1h, 0.0) AS rain_1h FROM weather_rows"""

TABLES["scored"] = """
SELECT h.plant_id, h.generation_date, h.generation_kwh,
  avg(h.generation_kwh) OVER (PARTITION BY h.plant_id, hour(h.generation_date)) AS ml_predicted_kwh,
  greatest(0.0, sin(pi() * (hour(h.generation_date) - 6) / 12)) * f.plant_capacity * 0.82 AS clearsky_expected_kwh
FROM hourly h JOIN fleet f USING (plant_id)"""

TABLES["history"] = """
SELECT CAST(900001 + l_suppkey % 5 AS BIGINT) AS plant_id, l_shipdate + to_hours(CAST(l_linenumber * 3 AS BIGINT)) AS generation_date,
  CASE WHEN l_linenumber <> 7 THEN l_quantity END AS generation_kwh,
  l_quantity * (0.9 + l_discount * 4) AS ml_predicted_kwh, l_extendedprice / 1000 AS clearsky_expected_kwh,
  l_discount AS discount, l_tax AS tax
FROM lineitem"""

TABLES["payload_steps"] = """
SELECT plant_id, time_bucket(INTERVAL '3 hours', stamp) AS timestamp, avg(value) AS v, min(event_id) AS e
FROM raw_log WHERE event_type = 'error' GROUP BY 1, 2"""

TABLES["forecast_rows"] = """
SELECT plant_id, timestamp, 15.0 + v / 10 AS temp, 14.0 + v / 10 AS feels_like, 1000.0 + v / 20 AS pressure,
  least(100.0, 40.0 + v / 2) AS humidity, least(100.0, v) AS clouds_all, v / 25 AS wind_speed,
  CASE WHEN e % 11 <> 0 THEN CAST(e % 360 AS DOUBLE) ELSE 0.0 END AS wind_deg,
  CASE WHEN v > 60 THEN 'Rain' ELSE 'Clear' END AS weather_main, 'code ' || CAST(e % 10 AS VARCHAR) AS weather_description,
  CASE WHEN e % 5 <> 0 THEN 10000.0 - v * 20 ELSE 10000.0 END AS visibility,
  CASE WHEN v > 60 THEN v - 60 ELSE 0.0 END AS rain_1h
FROM payload_steps"""


def solar_ctes(source: str, prefix: str) -> dict[str, str]:
    """Sun position of ``source.generation_date`` (local, six hours ahead of UTC), step by step."""
    lat, lon = 24.022350694140282, 90.29576719011767
    return {
        f"{prefix}_a": f"SELECT *, epoch(generation_date - INTERVAL '6 hours') AS secs FROM {source}",
        f"{prefix}_b": f"SELECT *, (secs / 86400.0 + 2440587.5 - 2451545.0) / 36525.0 AS t FROM {prefix}_a",
        f"{prefix}_c": f"""SELECT *, radians((280.46646 + t * (36000.76983 + t * 0.0003032)) % 360) AS l0,
          radians(357.52911 + t * (35999.05029 - 0.0001537 * t)) AS m,
          0.016708634 - t * (0.000042037 + 0.0000001267 * t) AS ecc, radians(125.04 - 1934.136 * t) AS om FROM {prefix}_b""",
        f"{prefix}_d": f"""SELECT *, l0 + radians(sin(m) * (1.914602 - t * (0.004817 + 0.000014 * t))
          + sin(2 * m) * (0.019993 - 0.000101 * t) + sin(3 * m) * 0.000289 - 0.00569 - 0.00478 * sin(om)) AS lam,
          radians(23 + (26 + (21.448 - t * (46.815 + t * (0.00059 - t * 0.001813))) / 60) / 60 + 0.00256 * cos(om)) AS eps
          FROM {prefix}_c""",
        f"{prefix}_e": f"SELECT *, asin(sin(eps) * sin(lam)) AS decl, pow(tan(eps / 2), 2) AS y FROM {prefix}_d",
        f"{prefix}_f": f"""SELECT *, radians(((secs % 86400) / 60.0 + 4 * {lon} + 4 * degrees(y * sin(2 * l0) - 2 * ecc * sin(m)
          + 4 * ecc * y * sin(m) * cos(2 * l0) - 0.5 * y * y * sin(4 * l0) - 1.25 * ecc * ecc * sin(2 * m))) / 4 - 180) AS ha
          FROM {prefix}_e""",
        f"{prefix}_g": f"""SELECT *, sin(decl) * sin(radians({lat})) + cos(decl) * cos(radians({lat})) * cos(ha) AS cosz,
          degrees(atan2(sin(ha), cos(ha) * sin(radians({lat})) - tan(decl) * cos(radians({lat})))) + 180 AS az FROM {prefix}_f""",
        prefix: f"""SELECT * EXCLUDE (secs, t, l0, m, ecc, om, lam, eps, decl, y, ha, cosz, az), elevation_ AS elevation,
          ((az % 360) + 360) % 360 AS azimuth,
          CASE WHEN sin(radians(elevation_)) > 0 THEN 1098.0 * sin(radians(elevation_)) * exp(-0.057 / sin(radians(elevation_))) ELSE 0.0 END AS ghi
          FROM (SELECT *, degrees(asin(least(1.0, greatest(-1.0, cosz)))) AS elevation_ FROM {prefix}_g)""",
    }


TABLES.update(solar_ctes("hourly", "hourly_sun"))
TABLES.update(solar_ctes("audit_rows", "audit_sun"))

TABLES["availability"] = """
SELECT plant_id, count(*) FILTER (elevation > 5) AS total_hours, count(*) FILTER (elevation > 5 AND data_available) AS available_hours,
  count(*) FILTER (elevation > 5 AND data_available) * 100.0 / nullif(count(*) FILTER (elevation > 5), 0) AS availability_pct
FROM hourly_sun GROUP BY 1"""

TABLES["pairs"] = """
SELECT plant_id, date, source, five_min_kwh AS base, kwh FROM (
  SELECT plant_id, date, five_min_kwh, 'Hourly inverter' AS source, hourly_inverter_kwh AS kwh FROM aligned
  UNION ALL SELECT plant_id, date, five_min_kwh, 'Daily inverter', daily_inverter_kwh FROM aligned
  UNION ALL SELECT plant_id, date, five_min_kwh, 'Hourly meter', hourly_meter_kwh FROM aligned
  UNION ALL SELECT plant_id, date, five_min_kwh, 'Billing meter', billing_meter_kwh FROM aligned)
WHERE five_min_kwh IS NOT NULL AND kwh IS NOT NULL"""

TABLES["summaries"] = """
SELECT plant_id, source, count(*) AS overlap_days,
  covar_samp(base, kwh) / nullif(stddev_samp(base) * stddev_samp(kwh), 0) AS correlation,
  sum(kwh) / nullif(sum(base), 0) AS source_to_5min_total, avg(abs(kwh - base)) AS daily_mae_kwh,
  max(abs(kwh - base)) AS max_abs_diff_kwh,
  avg(CASE WHEN abs(kwh - base) <= 0.01 THEN 1.0 ELSE 0.0 END) * 100 AS matching_days_pct
FROM pairs GROUP BY 1, 2"""

TABLES["overview_parts"] = """
SELECT f.plant_id, f.plant_name, a.availability_pct,
  max(s.matching_days_pct) FILTER (source = 'Hourly inverter') AS hm,
  max(s.source_to_5min_total) FILTER (source = 'Daily inverter') AS dr, max(s.correlation) FILTER (source = 'Daily inverter') AS dc,
  max(s.source_to_5min_total) FILTER (source = 'Hourly meter') AS mr, max(s.correlation) FILTER (source = 'Hourly meter') AS mc,
  max(s.source_to_5min_total) FILTER (source = 'Billing meter') AS br, max(s.correlation) FILTER (source = 'Billing meter') AS bc
FROM fleet f LEFT JOIN availability a USING (plant_id) LEFT JOIN summaries s USING (plant_id) GROUP BY 1, 2, 3"""


def _weighted(parts: list[tuple[str, float]]) -> str:
    top = " + ".join(f"coalesce(({s}) * {w}, 0)" for s, w in parts)
    bottom = " + ".join(f"CASE WHEN ({s}) IS NULL THEN 0 ELSE {w} END" for s, w in parts)
    return f"({top}) / nullif({bottom}, 0)"


def _corr_score(c: str) -> str:
    return f"CASE WHEN {c} IS NOT NULL THEN greatest(0, least(100, {c} * 100)) END"


def _close_score(c: str) -> str:
    return f"CASE WHEN {c} IS NOT NULL THEN greatest(0, 100 - abs({c} - 1) * 100) END"


_DAILY = _weighted([(_corr_score("dc"), 0.5), (_close_score("dr"), 0.5)])
_BILLING = _weighted([(_corr_score("bc"), 0.5), (_close_score("br"), 0.5)])

TABLES["overview_scores"] = f"SELECT *, {_weighted([('hm', 0.20), (_DAILY, 0.35), (_BILLING, 0.45)])} AS source_score FROM overview_parts"
TABLES["overview"] = f"""
SELECT *, CASE WHEN score IS NULL THEN 'Unknown' WHEN score >= 80 THEN 'Good' WHEN score >= 65 THEN 'Usable'
  WHEN score >= 50 THEN 'Caution' ELSE 'Poor' END AS band,
  coalesce(nullif(concat_ws('; ', CASE WHEN availability_pct < 60 THEN 'Low daylight coverage' END,
    CASE WHEN source_score < 60 THEN 'Weak source agreement' END,
    CASE WHEN br < 0.8 OR br > 1.2 THEN 'Meter total differs from inverter' END), ''), 'None') AS warnings
FROM (SELECT *, {_weighted([('availability_pct', 0.55), ('source_score', 0.45)])} AS score FROM overview_scores)"""

TABLES["diagnostics_five"] = """
SELECT plant_id, generation_date, sum(kwh) AS raw, count(kwh) AS n FROM (
  SELECT plant_id, date_trunc('hour', local_ts) AS generation_date, local_ts, arg_max(wh, event_id) / 1000 AS kwh
  FROM fleet_log WHERE local_ts IS NOT NULL AND wh IS NOT NULL GROUP BY ALL) GROUP BY ALL"""

TABLES["diagnostics_grid"] = """
SELECT plant_id, unnest(generate_series(min(generation_date), max(generation_date), INTERVAL '1 hour')) AS generation_date
FROM diagnostics_five GROUP BY plant_id"""

TABLES["diagnostics_hourly"] = """
SELECT plant_id, date_trunc('hour', local_ts) AS generation_date, sum(sign * round(value * 500)) / 1000 AS hourly, count(*) AS hourly_records
FROM fleet_log WHERE local_ts IS NOT NULL AND sign IS NOT NULL AND event_type = 'click' GROUP BY 1, 2"""

TABLES["diagnostics_base"] = """
SELECT plant_id, generation_date, raw, n, n / 2.0 * 100 AS pct, coalesce(n / 2.0 * 100 >= 80, false) AS five_ok, hourly, hourly_records,
  CASE WHEN abs(raw) > 0.01 THEN (hourly - raw) / raw * 100 WHEN abs(hourly - raw) <= 0.01 THEN 0.0 END AS delta_pct
FROM (SELECT g.plant_id, g.generation_date, f.raw, coalesce(f.n, 0) AS n FROM diagnostics_grid g
      LEFT JOIN diagnostics_five f USING (plant_id, generation_date)) d
FULL JOIN diagnostics_hourly USING (plant_id, generation_date)"""

TABLES["diagnostics"] = """
SELECT *, CASE WHEN flag = 'missing' THEN 0 WHEN flag = 'large_difference' THEN 1
  WHEN flag IN ('hourly_fallback', 'moderate_difference') THEN 2 ELSE 3 END AS score
FROM (SELECT *, CASE WHEN five_ok THEN raw ELSE hourly END AS final,
  CASE WHEN five_ok THEN '5min_inverter' WHEN hourly IS NOT NULL THEN 'hourly_inverter_fallback' ELSE 'missing' END AS target_source,
  CASE WHEN five_ok AND hourly IS NOT NULL AND abs(delta_pct) > 20 THEN 'large_difference'
       WHEN five_ok AND hourly IS NOT NULL AND abs(delta_pct) > 5 THEN 'moderate_difference'
       WHEN five_ok AND hourly IS NOT NULL AND abs(delta_pct) <= 5 THEN 'confirmed_5min'
       WHEN five_ok THEN '5min_primary' WHEN hourly IS NOT NULL THEN 'hourly_fallback' ELSE 'missing' END AS flag
  FROM diagnostics_base)"""

TABLES["gen_days"] = """
SELECT plant_id, CAST(generation_date AS DATE) AS date, count(kwh) AS n, coalesce(sum(kwh), 0) AS total
FROM audit_rows GROUP BY 1, 2"""

TABLES["completeness"] = """
SELECT *, 288 - records_collected AS missing_records, round_even(records_collected / 288.0 * 100, 1) AS completeness_pct,
  CASE WHEN total_production = 0 THEN 'No Production Data' WHEN records_collected < 288 THEN 'Partial Data' ELSE 'Complete' END AS status
FROM (SELECT g.plant_id, g.date, coalesce(d.n, 0) AS records_collected, coalesce(d.total, 0.0) AS total_production, CAST(288 AS BIGINT) AS expected_records
  FROM (SELECT plant_id, CAST(unnest(generate_series(min(date), max(date), INTERVAL '1 day')) AS DATE) AS date FROM gen_days GROUP BY 1) g
  LEFT JOIN gen_days d USING (plant_id, date))"""

TABLES["joined_weather"] = """
SELECT h.plant_id, h.plant_name, h.generation_date, h.generation_kwh, w.temp, w.visibility, w.rain_1h, w.clouds_all,
  row_number() OVER (PARTITION BY h.plant_id ORDER BY h.generation_date) AS pos
FROM hourly h LEFT JOIN weather w USING (generation_date)"""


def _interpolated(c: str) -> str:
    before = f"max(CASE WHEN {c} IS NOT NULL THEN pos END) OVER (PARTITION BY plant_id ORDER BY pos)"
    after = f"min(CASE WHEN {c} IS NOT NULL THEN pos END) OVER (PARTITION BY plant_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    return f"{before} AS b_{c}, {after} AS a_{c}"


TABLES["known"] = f"SELECT *, {', '.join(_interpolated(c) for c in ('temp', 'visibility', 'clouds_all'))} FROM joined_weather"

TABLES["merged"] = """
SELECT k.plant_id, k.plant_name, k.generation_date, k.generation_kwh, coalesce(k.rain_1h, 0) AS rain_1h, """ + ", ".join(
    f"""CASE WHEN k.{c} IS NOT NULL THEN k.{c} WHEN k.b_{c} IS NULL THEN p{c}a.{c} WHEN k.a_{c} IS NULL THEN p{c}b.{c}
    ELSE p{c}b.{c} + (p{c}a.{c} - p{c}b.{c}) / (k.a_{c} - k.b_{c}) * (k.pos - k.b_{c}) END AS {c}"""
    for c in ("temp", "visibility", "clouds_all")) + "\nFROM known k " + " ".join(
    f"LEFT JOIN joined_weather p{c}{side} ON p{c}{side}.plant_id = k.plant_id AND p{c}{side}.pos = k.{side}_{c}"
    for c in ("temp", "visibility", "clouds_all") for side in ("b", "a"))


def feature_ctes(source: str, prefix: str) -> dict[str, str]:
    """The modelling frame over a weather-merged hourly source."""
    out = solar_ctes(source, f"{prefix}_sun")
    w = "OVER (PARTITION BY plant_id ORDER BY generation_date ROWS BETWEEN 167 PRECEDING AND CURRENT ROW)"
    lag = "OVER (PARTITION BY plant_id ORDER BY generation_date)"
    out[prefix] = f"""
    SELECT s.* EXCLUDE (ghi), ghi, ghi / 1000 * plant_capacity * 0.82 AS clearsky_expected_kwh,
      CAST(hour(generation_date) AS INTEGER) AS hour, CAST(dayofyear(generation_date) AS INTEGER) AS day_of_year,
      CAST(month(generation_date) AS INTEGER) AS month, CAST(isodow(generation_date) - 1 AS INTEGER) AS day_of_week,
      sin(2 * pi() * hour(generation_date) / 24) AS hour_sin, cos(2 * pi() * hour(generation_date) / 24) AS hour_cos,
      sin(2 * pi() * dayofyear(generation_date) / 365) AS day_sin, cos(2 * pi() * dayofyear(generation_date) / 365) AS day_cos,
      1 - clouds_all / 100 AS cloud_impact, CASE WHEN rain_1h > 0 THEN 1 ELSE 0 END AS has_rain, temp * temp AS temp_squared,
      ghi * (1 - clouds_all / 100) AS effective_irradiance, elevation * (1 - clouds_all / 100) AS elevation_x_cloud,
      lag(generation_kwh, 24) {lag} AS production_lag_24h, lag(generation_kwh, 168) {lag} AS production_lag_168h,
      CASE WHEN count(generation_kwh) {w} >= 24 THEN avg(generation_kwh) {w} END AS production_7d_mean,
      CASE WHEN count(temp) {w} >= 24 THEN avg(temp) {w} END AS temp_7d_mean
    FROM {prefix}_sun s JOIN fleet f USING (plant_id, plant_name)"""
    out[f"{prefix}_day"] = f"SELECT * FROM {prefix} WHERE elevation > 5 AND generation_kwh IS NOT NULL"
    return out


TABLES.update(feature_ctes("merged", "feat"))
TABLES["merged_reliable"] = """
SELECT m.* FROM merged m WHERE NOT EXISTS (
  SELECT 1 FROM weak w WHERE w.plant_id = m.plant_id AND w.date = CAST(m.generation_date AS DATE))"""
TABLES.update(feature_ctes("merged_reliable", "tfeat"))

_WORD = re.compile(r"\b[a-z_0-9]+\b")


def _filled(columns, keys: str) -> str:
    """Last known value, else the next, else 0, in time order within the keys."""
    over = f"PARTITION BY {keys} ORDER BY generation_date ROWS BETWEEN"
    return ", ".join(f"coalesce(last_value({c} IGNORE NULLS) OVER ({over} UNBOUNDED PRECEDING AND CURRENT ROW), "
                     f"first_value({c} IGNORE NULLS) OVER ({over} CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS {c}" for c in columns)


POSITION_SQL = """
SELECT plant_id, generation_date, CASE WHEN generation_date < cut THEN 'train' ELSE 'test' END AS split FROM (
  SELECT *, CASE WHEN n_test < {min_test} THEN max(generation_date) FILTER (rn = pos) OVER (PARTITION BY plant_id) ELSE wanted END AS cut FROM (
    SELECT *, count(*) OVER (PARTITION BY plant_id) AS n, row_number() OVER (PARTITION BY plant_id ORDER BY generation_date) AS rn,
      CAST(floor(count(*) OVER (PARTITION BY plant_id) * 0.8) AS BIGINT) + 1 AS pos,
      count(*) FILTER (generation_date >= wanted) OVER (PARTITION BY plant_id) AS n_test
    FROM (SELECT plant_id, generation_date, {wanted} AS wanted FROM {source})))"""
CONFIGURED = "CASE WHEN plant_id = 900005 THEN TIMESTAMP '2025-04-01' ELSE TIMESTAMP '2025-06-01' END"
FEATURES = config.ALL_FEATURES
TABLES["train_split"] = f"SELECT f.*, p.split FROM tfeat_day f JOIN ({POSITION_SQL.format(min_test=500, wanted=CONFIGURED, source='tfeat_day')}) p USING (plant_id, generation_date)"
TABLES["train_rows"] = f"SELECT plant_id, generation_date, generation_kwh, split, {_filled(FEATURES, 'plant_id, split')} FROM train_split"
TABLES["score_rows"] = f"SELECT plant_id, generation_date, generation_kwh, {_filled(FEATURES, 'plant_id')} FROM feat_day"


def _system(source: str, keys: str, alpha: str) -> str:
    """Centred normal equations of a ridge with their right-hand side, as a list of rows."""
    def cell(i: int, j: int) -> str:
        other = FEATURES[j] if j < len(FEATURES) else "generation_kwh"
        return f"covar_pop({FEATURES[i]}, {other}) * count(*)" + (f" + {alpha}" if i == j else "")
    rows = ", ".join("[" + ", ".join(cell(i, j) for j in range(len(FEATURES) + 1)) + "]" for i in range(len(FEATURES)))
    means = ", ".join(f"avg({c})" for c in FEATURES)
    return f"SELECT {keys}, count(*) AS n, avg(generation_kwh) AS level, [{means}] AS means, [{rows}] AS m FROM {source} GROUP BY {keys}"


def _solved(system: str, keys: str) -> str:
    """Gauss-Jordan elimination, one feature a step."""
    size = len(FEATURES)
    return f"""
WITH RECURSIVE g AS (
  SELECT {keys}, n, level, means, 1 AS k, m FROM {system}
  UNION ALL SELECT {keys}, n, level, means, k + 1, list_transform(m, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda v: v / r[k])
    ELSE list_transform(r, lambda v, j: v - r[k] * m[k][j] / m[k][k]) END) FROM g WHERE k <= {size})
SELECT *, level - list_inner_product(w, means) AS intercept FROM (
  SELECT {keys}, n, level, means, list_transform(m, lambda r: r[{size + 1}]) AS w FROM g WHERE k = {size + 1})"""


TABLES["ridge_system"] = _system("(SELECT * FROM train_rows WHERE split = 'train')", "plant_id", "100")
TABLES["ridge_fit"] = _solved("ridge_system", "plant_id")
TABLES["fold_rows"] = """
SELECT *, CAST(CASE WHEN rn > n - size THEN 3 WHEN rn > n - 2 * size THEN 2 WHEN rn > n - 3 * size THEN 1 ELSE 0 END AS INTEGER) AS fold
FROM (SELECT *, n // 4 AS size FROM (SELECT *, count(*) OVER (PARTITION BY plant_id) AS n, row_number() OVER (PARTITION BY plant_id ORDER BY generation_date) AS rn
  FROM train_rows WHERE split = 'train'))"""
TABLES["fold_system"] = _system("(SELECT r.* EXCLUDE (n), test, alpha FROM fold_rows r JOIN (VALUES (1), (2), (3)) t(test) ON fold < test "
                                f"CROSS JOIN (VALUES {', '.join(f'({float(a)!r}::DOUBLE)' for a in config.RIDGE_GRID['alpha'])}) v(alpha))", "plant_id, test, alpha", "alpha")
TABLES["fold_fit"] = _solved("fold_system", "plant_id, test, alpha")
RIDGE_SUM = "intercept + " + " + ".join(f"w[{i + 1}] * {c}" for i, c in enumerate(FEATURES))


def with_tables(body: str) -> str:
    """Prefix a query with the definitions it needs, directly or through others."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in set(_WORD.findall(text)) & TABLES.keys() - needed:
            needed.add(name)
            visit(TABLES[name])

    visit(body)
    defined = ", ".join(f"{name} AS ({TABLES[name]})" for name in TABLES if name in needed)
    return f"WITH {defined} {body}" if defined else body
