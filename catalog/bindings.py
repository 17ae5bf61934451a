"""Fixture tables bound to the canonical input schemas.

``events`` plays the interval log and, by event type, the other sources; ``lineitem`` plays a scored
history over many years. Unreadable texts, negatives, duplicates and foreign plants are part of it.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heliospark import config
from heliospark.functions.times import floor_bucket
from heliospark.operators.cleaning import audit_rows, clean_generation
from heliospark.operators.daily import daily_agreement
from heliospark.operators.hourly import hourly_targets
from heliospark.plans.clean_build import aligned_sources
from heliospark.sources.intermediate import materialize
from heliospark.sources.tables import read_table
from heliospark.sources.weather import clean_weather

EXPECTED = 2  # events are sparser than twelve per plant and hour


class Fixture:
    """Lazy access to the bound tables of one data folder."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory
        self.fleet = config.fleet(spark)

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, f"{self.directory}/{name}.parquet")

    @functools.cached_property
    def events(self) -> DataFrame:
        stamped = self.table("events").withColumn("ts", F.col("ts").cast("timestamp_ntz")).withColumn(
            "stamp", floor_bucket("ts", 5))
        return stamped.selectExpr(
            "*", "900001L + user_id % 6 AS plant_id", "user_id % 3 AS meter_id", "event_id AS ingest_seq")

    def _log(self, condition: str, amount: str, stamp: str = "stamp") -> DataFrame:
        return self.events.where(condition).selectExpr(
            "plant_id",
            f"IF(event_id % 103 = 0, 'not a time', CAST({stamp} AS STRING)) AS generation_date",
            f"CASE WHEN event_id % 101 = 0 THEN 'n/a' WHEN event_id % 97 = 0 THEN concat('-', {amount})"
            f" ELSE {amount} END AS generation_amount",
            "ingest_seq")

    @functools.cached_property
    def generation_5min(self) -> DataFrame:
        return self._log("true", "format_number(CAST(round(value * 100) AS BIGINT), 0)")

    @functools.cached_property
    def generation_hourly(self) -> DataFrame:
        return self._log("event_type = 'click'", "format_number(CAST(round(value * 500) AS BIGINT), 0)")

    @functools.cached_property
    def generation_daily(self) -> DataFrame:
        return self._log("event_type = 'purchase'", "CAST(value * 0.5 AS STRING)", "stamp + INTERVAL 1 DAY")

    def _meter(self, event_type: str) -> DataFrame:
        return self.events.where(F.col("event_type") == event_type).selectExpr(
            "plant_id", "meter_id", "IF(event_id % 103 = 0, 'not a time', CAST(stamp AS STRING)) AS date",
            "IF(event_id % 101 = 0, 'n/a', CAST(value * 1000 AS STRING)) AS meter_reading")

    @functools.cached_property
    def meter_hourly(self) -> DataFrame:
        return self._meter("signup")

    @functools.cached_property
    def meter_billing(self) -> DataFrame:
        return self._meter("error")

    @functools.cached_property
    def plants(self) -> DataFrame:
        regions = self.table("region").selectExpr(
            "900001L + r_regionkey AS plant_id", "r_name AS plant_name", "IF(r_regionkey % 2 = 0, 'Roof', NULL) AS plant_address",
            "200D + r_regionkey * 50 AS plant_capacity")
        nations = self.table("nation").selectExpr(
            "910000L + n_nationkey AS plant_id", "n_name AS plant_name", "'Roof' AS plant_address", "100D AS plant_capacity")
        return regions.unionByName(nations)

    @functools.cached_property
    def weather_raw(self) -> DataFrame:
        hour = floor_bucket("stamp", 60).cast("string")
        return self.events.where("event_type = 'error'").withColumn("hour", hour).selectExpr(
            "concat(hour, ' +0000 UTC') AS dt_iso",
            "IF(event_id % 89 = 0, 'bad', CAST(15D + value / 10 AS STRING)) AS temp",
            "CAST(10000D - value * 20 AS STRING) AS visibility",
            "CAST(IF(value > 100, value - 100, NULL) AS STRING) AS rain_1h",
            "CAST(least(100D, value) AS STRING) AS clouds_all",
            "CAST(1000D + value / 20 AS STRING) AS pressure",
            "CAST(least(100D, 40D + value / 2) AS STRING) AS humidity",
            "CAST(value / 25 AS STRING) AS wind_speed",
            "CAST(IF(event_id % 7 != 0, 14D + value / 10, NULL) AS STRING) AS feels_like",
            "CAST(IF(event_id % 11 != 0, DOUBLE(event_id * 37 % 360), NULL) AS STRING) AS wind_deg")

    @functools.cached_property
    def payloads(self) -> DataFrame:
        """Forecast payloads as JSON text: one per plant and UTC day."""
        steps = self.events.where("event_type = 'error'").groupBy(
            "plant_id", floor_bucket("stamp", 180).alias("bucket")).agg(F.avg("value").alias("v"), F.min("event_id").alias("e"))
        item = steps.selectExpr(
            "plant_id", "CAST(bucket AS DATE) AS day",
            "struct(unix_date(CAST(bucket AS DATE)) * 86400L + hour(bucket) * 3600 AS dt,"
            " struct(15D + v / 10 AS temp, 14D + v / 10 AS feels_like, 1000D + v / 20 AS pressure,"
            "  least(100D, 40D + v / 2) AS humidity) AS main,"
            " struct(least(100D, v) AS `all`) AS clouds,"
            " struct(v / 25 AS speed, IF(e % 11 != 0, DOUBLE(e % 360), NULL) AS deg) AS wind,"
            " array(struct(IF(v > 60, 'Rain', 'Clear') AS main, concat('code ', e % 10) AS description)) AS weather,"
            " IF(e % 5 != 0, 10000D - v * 20, NULL) AS visibility,"
            " IF(v > 60, struct(v - 60 AS `1h`), NULL) AS rain) AS item")
        lists = item.groupBy("plant_id", "day").agg(F.sort_array(F.collect_list("item")).alias("list"))
        return lists.select("plant_id", F.to_json(F.struct("list")).alias("payload"))

    @functools.cached_property
    def daily_raw(self) -> dict[str, DataFrame]:
        return {"generation_5min": self.generation_5min, "generation_hourly": self.generation_hourly,
                "generation_daily": self.generation_daily, "meter_hourly": self.meter_hourly,
                "meter_billing": self.meter_billing}

    @property
    def raw(self) -> dict[str, DataFrame]:
        return {**self.daily_raw, "plants": self.plants, "weather": self.weather_raw}

    @functools.cached_property
    def generation(self) -> DataFrame:
        return clean_generation(self.generation_5min, self.fleet)

    @functools.cached_property
    def hourly(self) -> DataFrame:
        return hourly_targets(self.generation, self.fleet, EXPECTED)

    @functools.cached_property
    def weather(self) -> DataFrame:
        return clean_weather(self.weather_raw)

    @functools.cached_property
    def aligned(self) -> DataFrame:
        return aligned_sources(self.daily_raw, self.fleet)

    @functools.cached_property
    def scored(self) -> DataFrame:
        """Hourly targets with the mean of the same plant and hour of day as prediction."""
        hourly = self.hourly.withColumn("hour", F.hour("generation_date"))
        typical = hourly.groupBy("plant_id", "hour").agg(F.avg("generation_kwh").alias("ml_predicted_kwh"))
        capacity = self.fleet.select("plant_id", "plant_capacity")
        return hourly.join(typical, ["plant_id", "hour"], "left").join(capacity, "plant_id").selectExpr(
            "plant_id", "generation_date", "generation_kwh", "ml_predicted_kwh",
            "greatest(0D, sin(pi() * (hour - 6) / 12)) * plant_capacity * 0.82D AS clearsky_expected_kwh")

    @functools.cached_property
    def history(self) -> DataFrame:
        """A scored history over many years, several rows per plant and hour."""
        return self.table("lineitem").selectExpr(
            "900001L + l_suppkey % 5 AS plant_id",
            "CAST(l_shipdate AS TIMESTAMP_NTZ) + make_dt_interval(0, l_linenumber * 3) AS generation_date",
            "IF(l_linenumber != 7, l_quantity, NULL) AS generation_kwh",
            "l_quantity * (0.9D + l_discount * 4) AS ml_predicted_kwh",
            "l_extendedprice / 1000 AS clearsky_expected_kwh", "l_discount AS discount", "l_tax AS tax")

    @functools.cached_property
    def agreement(self) -> DataFrame:
        return daily_agreement(self.aligned, self.fleet)

    @functools.cached_property
    def audit_rows(self) -> DataFrame:
        return audit_rows(self.generation_5min, self.fleet)

    def with_clean_tables(self) -> Fixture:
        """Use written clean tables from here on, for jobs that read them more than once."""
        self.hourly = materialize(self.hourly, "hourly-targets")
        self.weather = materialize(self.weather, "weather")
        return self
