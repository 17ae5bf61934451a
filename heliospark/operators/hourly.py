"""Hourly targets, the hourly fallback diagnosis and dense time grids.

Everything after the first aggregation holds one row per plant and hour, so a per-plant window is
bounded by the calendar (8,784 rows a year) however skewed the raw log is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heliospark import config
from heliospark.functions.times import days, floor_bucket, minutes
from heliospark.operators.cleaning import last_amounts, parse_generation, with_plant_name


def fill_gaps(df: DataFrame, keys: Sequence[str], ts: str, step: Column) -> DataFrame:
    """Make a series gap-free between its first and last timestamp; new rows are NULL elsewhere.

    Input has one row per key and timestamp on the grid. Each row emits the slots up to its
    successor, which needs one pass and no self-join.
    """
    series = Window.partitionBy(*keys).orderBy(ts)
    last_slot = F.coalesce(F.lead(ts).over(series) - step, F.col(ts))
    slots = df.withColumn("_last_slot", last_slot).withColumn(
        "_slot", F.explode(F.sequence(F.col(ts), F.col("_last_slot"), step)))
    real = F.col("_slot") == F.col(ts)
    rest = [c for c in df.columns if c not in keys and c != ts]
    return slots.select(*keys, F.col("_slot").alias(ts), *[F.when(real, F.col(c)).alias(c) for c in rest])


def densify(grid_of: DataFrame, df: DataFrame, key: str, start: Column, end: Column, step: Column,
            ts: str = "generation_date") -> DataFrame:
    """Calendar grid from ``start`` to ``end`` for every row of ``grid_of``, left-joined with the data."""
    grid = grid_of.select(key, F.explode(F.sequence(start, end, step)).alias(ts))
    return grid.join(df, [key, ts], "left")


def hourly_targets(df: DataFrame, plants: DataFrame, expected: int = config.EXPECTED_RECORDS_PER_HOUR,
                   min_pct: float = config.MIN_HOURLY_COMPLETENESS_PCT, bucket_minutes: int = 60) -> DataFrame:
    """Dense hourly targets from cleaned interval rows; an hour with too few records has no target."""
    hourly = df.groupBy("plant_id", floor_bucket("generation_date", bucket_minutes).alias("generation_date")).agg(
        F.sum("generation_kwh").alias("generation_kwh_raw"),
        F.count("generation_kwh").alias("records_collected"))
    dense = fill_gaps(hourly, ["plant_id"], "generation_date", minutes(bucket_minutes))
    return with_plant_name(_target_columns(dense, expected, min_pct), plants).select(
        "plant_id", "plant_name", "generation_date", "generation_kwh", "generation_kwh_raw",
        "records_collected", "expected_records", "missing_records", "data_completeness_pct",
        "data_available", "target_source", "target_quality_flag")


def _target_columns(dense: DataFrame, expected: int, min_pct: float) -> DataFrame:
    collected = F.coalesce("records_collected", F.lit(0)).cast("long")
    pct = F.col("records_collected") / expected * 100
    available = F.col("data_available")
    return dense.withColumn("records_collected", collected).withColumns({
        "expected_records": F.lit(expected).cast("long"),
        "missing_records": F.lit(expected) - F.col("records_collected"),
        "data_completeness_pct": pct,
        "data_available": pct >= min_pct,
    }).withColumns({
        "generation_kwh": F.when(available, F.col("generation_kwh_raw")),
        "target_source": F.lit("5min_inverter_cleaned"),
        "target_quality_flag": F.when(available, "usable_5min_hour").otherwise("incomplete_hour_excluded"),
    })


def hourly_source_diagnostics(five: DataFrame, hourly: DataFrame | None, plants: DataFrame,
                              expected: int = config.EXPECTED_RECORDS_PER_HOUR,
                              min_pct: float = config.MIN_HOURLY_COMPLETENESS_PCT) -> DataFrame:
    """Candidate target per hour: the 5-minute sum, else the hourly log if there is one, with agreement flags."""
    readable = F.col("generation_date").isNotNull() & F.col("amount").isNotNull()
    five_rows = last_amounts(five, plants, F.col("amount").isNotNull()).select(
        "plant_id", "generation_date", (F.col("amount") / 1000).alias("kwh"))
    five_hourly = fill_gaps(
        five_rows.groupBy("plant_id", floor_bucket("generation_date", 60).alias("generation_date")).agg(
            F.sum("kwh").alias("generation_kwh_5min_raw"), F.count("kwh").alias("records_collected_5min")),
        ["plant_id"], "generation_date", minutes(60)).withColumn(
            "records_collected_5min", F.coalesce("records_collected_5min", F.lit(0)).cast("long"))
    if hourly is None:
        both = five_hourly.withColumns({"generation_kwh_hourly": F.lit(None).cast("double"), "hourly_records": F.lit(None).cast("long")})
    else:
        logged = parse_generation(hourly, plants).where(readable).groupBy(
            "plant_id", floor_bucket("generation_date", 60).alias("generation_date")).agg(
                (F.sum("amount") / 1000).alias("generation_kwh_hourly"), F.count("amount").alias("hourly_records"))
        both = five_hourly.join(logged, ["plant_id", "generation_date"], "full")

    raw, other = F.col("generation_kwh_5min_raw"), F.col("generation_kwh_hourly")
    merged = both.withColumns({
        "data_completeness_pct": F.col("records_collected_5min") / expected * 100,
    }).withColumns({
        "expected_records_5min": F.when(F.col("records_collected_5min").isNotNull(), F.lit(expected).cast("long")),
        "five_min_available": F.coalesce(F.col("data_completeness_pct") >= min_pct, F.lit(False)),
        "hourly_available": other.isNotNull(),
        "delta_kwh_hourly_minus_5min": other - raw,
    })
    delta = F.col("delta_kwh_hourly_minus_5min")
    available, hourly_there = F.col("five_min_available"), F.col("hourly_available")
    fallback = F.col("generation_kwh_5min").isNull() & hourly_there
    gap = F.col("abs_delta_pct_hourly_vs_5min")
    return merged.withColumns({
        "generation_kwh_5min": F.when(available, raw),
        "delta_pct_hourly_vs_5min": F.when(F.abs(raw) > 0.01, F.try_divide(delta, raw) * 100)
        .when(F.abs(delta) <= 0.01, F.lit(0.0)),
    }).withColumns({
        "abs_delta_pct_hourly_vs_5min": F.abs("delta_pct_hourly_vs_5min"),
        "generation_kwh_final": F.coalesce("generation_kwh_5min", "generation_kwh_hourly"),
        "target_source": F.when(fallback, "hourly_inverter_fallback")
        .when(F.col("generation_kwh_5min").isNotNull(), "5min_inverter").otherwise("missing"),
    }).withColumns({
        "target_is_fallback": F.col("target_source") == "hourly_inverter_fallback",
        "target_quality_flag": F.when(available & hourly_there & (gap > 20), "large_difference")
        .when(available & hourly_there & (gap > 5), "moderate_difference")
        .when(available & hourly_there & (gap <= 5), "confirmed_5min")
        .when(fallback, "hourly_fallback").when(available, "5min_primary").otherwise("missing"),
    }).withColumn(
        "target_quality_score",
        F.when(F.col("target_quality_flag") == "missing", 0)
        .when(F.col("target_quality_flag") == "large_difference", 1)
        .when(F.col("target_quality_flag").isin("hourly_fallback", "moderate_difference"), 2).otherwise(3))


def target_shares(diagnostics: DataFrame) -> DataFrame:
    """Share of hours with a usable target and where it came from, in percent per plant."""
    total = F.count(F.lit(1))
    share = lambda test: F.count_if(test) / total * 100
    return diagnostics.groupBy("plant_id").agg(
        total.alias("total_hours"),
        share(F.col("generation_kwh_final").isNotNull()).alias("usable_pct"),
        share(F.col("target_source") == "5min_inverter").alias("five_min_pct"),
        share(F.col("target_source") == "hourly_inverter_fallback").alias("fallback_pct"),
        share(F.col("target_source") == "missing").alias("missing_pct"))


def target_confidence_grid(diagnostics: DataFrame, last_days: int | None = 90) -> DataFrame:
    """Quality score by date (rows) and hour of day (24 fixed columns)."""
    if last_days is not None:
        from heliospark.operators.kpi import since_last
        diagnostics = since_last(diagnostics, last_days)
    return diagnostics.groupBy("plant_id", F.col("generation_date").cast("date").alias("date")).agg(*[
        F.max(F.when(F.hour("generation_date") == h, F.col("target_quality_score"))).alias(f"h{h:02d}")
        for h in range(24)
    ])


def day_grid(df: DataFrame, key: str, ts: str) -> DataFrame:
    """Gap-free daily series."""
    return fill_gaps(df, [key], ts, days(1))
