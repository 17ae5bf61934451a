"""Daily totals per source and how the sources agree.

Long form of a daily source: ``plant_id, date, source, kwh, records``; a day may be split over several
partial rows, they add up when the sources are aligned. Unreadable rows carry NULL records and vanish
there: filtering them first would push the parsing into the scan's filter and do it twice.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heliospark import config
from heliospark.functions.labels import agreement_flag, control_interpretation
from heliospark.functions.numbers import guarded_corr, numeric, numeric_amount, ratio
from heliospark.functions.times import floor_bucket, utc_to_local
from heliospark.operators.cleaning import select_plants, with_plant_name
from heliospark.sources.intermediate import materialize

METER_COLUMNS = ["plant_id", "meter_id", "meter_reading", "date"]


def daily_log_rows(df: DataFrame, plants: DataFrame, source: str, divisor: float, shift_days: int = 0,
                   tz: str = config.TIMEZONE) -> DataFrame:
    """Rows of a generation log in long form, one per record; negatives and copies are kept."""
    parsed = select_plants(df, plants).select(
        "plant_id", F.date_add(utc_to_local(df, "generation_date", tz).cast("date"), shift_days).alias("date"),
        (numeric_amount("generation_amount") / divisor).alias("kwh"))
    readable = F.col("date").isNotNull() & F.col("kwh").isNotNull()
    return parsed.select("plant_id", "date", F.lit(source).alias("source"), "kwh",
                         F.when(readable, F.lit(1)).cast("long").alias("records"))


def daily_log(df: DataFrame, plants: DataFrame, source: str, divisor: float, shift_days: int = 0) -> DataFrame:
    """Daily kWh and record count of a generation log."""
    return _add_up(daily_log_rows(df, plants, source, divisor, shift_days))


def daily_meter(df: DataFrame, plants: DataFrame, source: str, chunk_minutes: int = 1440,
                tz: str = config.TIMEZONE) -> DataFrame:
    """Daily kWh from cumulative readings: differences along each meter, negative ones dropped.

    Readings that share a timestamp are taken in ascending order, so their differences telescope and
    reduce to (first, last, count) before any shuffle. Differences are then taken inside chunks of one
    meter's timeline, and across chunk borders on the chunk summaries. No task holds more of a meter
    than one chunk, or one summary row per chunk of the calendar.
    """
    local = utc_to_local(df, "date", tz)
    readings = select_plants(df, plants).where(F.col("meter_id").isNotNull()).select(
        "plant_id", "meter_id", local.alias("ts"), numeric("meter_reading").alias("reading"))
    readings = readings.withColumn("reading", F.when(F.col("ts").isNotNull(), F.col("reading")))
    instants = readings.groupBy("plant_id", "meter_id", floor_bucket("ts", chunk_minutes).alias("chunk"), "ts").agg(
        F.min("reading").alias("first"), F.max("reading").alias("last"), F.count("reading").alias("n"),
    ).where(F.col("n") > 0)

    inside = Window.partitionBy("plant_id", "meter_id", "chunk").orderBy("ts")
    step = F.col("first") - F.lag("last").over(inside)
    rises = instants.withColumn("step", step)
    chunks = rises.groupBy("plant_id", "meter_id", "chunk").agg(
        F.sum(F.when(F.col("n") > 1, F.col("last") - F.col("first"))).alias("within"),
        F.sum(F.when(F.col("step") >= 0, F.col("step"))).alias("between"),
        (F.sum(F.col("n") - 1) + F.count_if(F.col("step") >= 0)).alias("counted"),
        F.min_by("first", "ts").alias("opening"), F.max_by("last", "ts").alias("closing"))

    along = Window.partitionBy("plant_id", "meter_id").orderBy("chunk")
    border = F.col("opening") - F.lag("closing").over(along)
    daily = chunks.withColumn("border", border).withColumn("date", F.col("chunk").cast("date"))
    crossing = F.col("border") >= 0
    counted = F.col("counted") + F.when(crossing, 1).otherwise(0)
    total = (F.coalesce("within", F.lit(0.0)) + F.coalesce("between", F.lit(0.0))
             + F.when(crossing, F.col("border")).otherwise(0.0))
    rows = daily.select("plant_id", "date", F.lit(source).alias("source"),
                        F.when(counted > 0, total / 1000).alias("kwh"), counted.alias("records"))
    return _add_up(rows)


def _add_up(rows: DataFrame) -> DataFrame:
    totals = rows.groupBy("plant_id", "date", "source").agg(
        F.sum(F.when(F.col("records").isNotNull(), F.col("kwh"))).alias("kwh"), F.sum("records").alias("records"))
    return totals.where(F.col("records").isNotNull())


def align_daily_sources(parts: list[DataFrame], sources: list[str] | None = None) -> DataFrame:
    """Full outer alignment of daily sources on (plant, date): one row per plant-day.

    A union and one grouped pivot over known sources, hence one shuffle instead of a chain of full
    outer joins.
    """
    sources = config.DAILY_SOURCES if sources is None else sources
    rows = reduce(DataFrame.unionByName, parts)
    here = {s: (F.col("source") == s) & F.col("records").isNotNull() for s in sources}
    aligned = rows.groupBy("plant_id", "date").agg(
        *[F.sum(F.when(here[s], F.col("kwh"))).alias(s) for s in sources],
        *[F.sum(F.when(here[s], F.col("records"))).alias(f"{s}_records") for s in sources],
        F.count("records").alias("_usable")).where(F.col("_usable") > 0)
    return aligned.select("plant_id", "date", *[c for s in sources for c in (s, f"{s}_records")])


def daily_agreement(aligned: DataFrame, plants: DataFrame) -> DataFrame:
    """Difference and ratio to the 5-minute total per reference, and a flag from the closest one."""
    references = [s for s in config.REFERENCE_SOURCES if s in aligned.columns]
    base = F.col(config.FIVE_MIN) if config.FIVE_MIN in aligned.columns else F.lit(None).cast("double")
    measured = aligned.withColumns({
        name: expr for s in references for name, expr in {
            f"{s}_minus_5min_kwh": F.col(s) - base,
            f"{s}_ratio_to_5min": F.when(F.abs(base) > config.RATIO_BASELINE_FLOOR_KWH, ratio(F.col(s), base)),
        }.items()
    })
    distances = [F.abs(F.col(f"{s}_ratio_to_5min") - 1) for s in references]
    closest = F.lit(None).cast("double")
    if distances:
        closest = distances[0] if len(distances) == 1 else F.least(*distances)
    flagged = measured.withColumn("source_agreement_flag", agreement_flag(closest))
    return with_plant_name(flagged, plants).select("plant_id", "plant_name", *flagged.columns[1:])


def weak_days(agreement: DataFrame, fleet: DataFrame,
              min_daily_kwh: float = config.MIN_DAILY_KWH_FOR_AGREEMENT) -> DataFrame:
    """Plant-days whose daily log is further from the 5-minute total than the plant tolerates."""
    limits = fleet.select("plant_id", "max_ratio_difference")
    limit = F.coalesce("max_ratio_difference", F.lit(config.MAX_RATIO_DIFFERENCE))
    distance = F.abs(F.col(f"{config.DAILY_INVERTER}_ratio_to_5min") - 1)
    return agreement.join(limits, "plant_id", "left").where(
        (F.col(config.FIVE_MIN) >= min_daily_kwh) & (distance > limit)).select("plant_id", "date")


def filter_source_agreement(df: DataFrame, agreement: DataFrame, fleet: DataFrame) -> DataFrame:
    """Drop rows that fall on weak days.

    Weak days are written first: this join's test for dates that are not null would be pushed to the scans of the logs
    and parse every text again there, several times over.
    """
    weak = materialize(weak_days(agreement, fleet), "weak-days")
    day = F.col("generation_date").cast("date")
    return df.withColumn("date", day).join(weak, ["plant_id", "date"], "left_anti").drop("date")


def source_summaries(aligned: DataFrame) -> DataFrame:
    """Per plant and reference source: overlap, correlation, total ratio, errors, matching days."""
    references = [s for s in config.REFERENCE_SOURCES if s in aligned.columns]
    long = _unpivot(aligned, references, config.FIVE_MIN)
    diff = F.abs(F.col("kwh") - F.col("base"))
    summary = long.groupBy("plant_id", "key").agg(
        F.count(F.lit(1)).alias("overlap_days"),
        guarded_corr("base", "kwh").alias("correlation"),
        ratio(F.sum("kwh"), F.sum("base")).alias("source_to_5min_total"),
        F.avg(diff).alias("daily_mae_kwh"),
        F.max(diff).alias("max_abs_diff_kwh"),
        (F.avg(F.when(diff <= config.MATCH_TOLERANCE_KWH, 1.0).otherwise(0.0)) * 100).alias("matching_days_pct"))
    return summary.withColumn("source", _relabel("key", config.SOURCE_LABELS)).drop("key")


def hourly_difference(aligned: DataFrame) -> DataFrame:
    """Daily difference between the hourly log and the 5-minute total."""
    base, other = F.col(config.FIVE_MIN), F.col(config.HOURLY_INVERTER)
    diff = other - base
    return aligned.withColumns({
        "hourly_difference_kwh": diff,
        "hourly_abs_difference_kwh": F.abs(diff),
        "hourly_pct_difference": ratio(diff, base) * 100,
    })


def candidate_with_controls(diagnostics: DataFrame, aligned: DataFrame) -> DataFrame:
    """Daily totals of the candidate hourly target next to the daily sources."""
    candidate = diagnostics.groupBy("plant_id", F.col("generation_date").cast("date").alias("date")).agg(
        F.sum("generation_kwh_final").alias("candidate_hourly_target_kwh"))
    return candidate.join(aligned, ["plant_id", "date"], "full")


def control_deltas(daily: DataFrame) -> DataFrame:
    """Per plant and control source: ratio of totals, its reading, and delta statistics."""
    controls = [c for c in config.CONTROL_LABELS if c in daily.columns]
    long = _unpivot(daily, controls, "candidate_hourly_target_kwh")
    delta = F.col("base") - F.col("kwh")
    summary = long.groupBy("plant_id", "key").agg(
        F.count(F.lit(1)).alias("overlap_days"),
        ratio(F.sum("base"), F.sum("kwh")).alias("candidate_to_control_total"),
        F.avg(delta).alias("mean_delta_kwh"), F.min(delta).alias("min_delta_kwh"),
        F.max(delta).alias("max_delta_kwh"), F.avg(F.abs(delta)).alias("mae_kwh"))
    return summary.withColumns({
        "interpretation": control_interpretation(F.col("candidate_to_control_total")),
        "control_source": _relabel("key", config.CONTROL_LABELS),
    }).drop("key")


def billing_agreement(five: DataFrame, billing: DataFrame, plants: DataFrame, min_days: int = 10) -> DataFrame:
    """Quick check of 5-minute against billing-meter daily totals; only with enough shared days.

    Days without any readable value count as 0 here, on either side.
    """
    five_days = select_plants(five, plants).select(
        "plant_id", utc_to_local(five, "generation_date").cast("date").alias("date"),
        (numeric_amount("generation_amount") / 1000).alias("kwh")).where(F.col("date").isNotNull())
    five_daily = five_days.groupBy("plant_id", "date").agg(F.coalesce(F.sum("kwh"), F.lit(0.0)).alias("five_min_kwh"))
    meter = daily_meter(billing, plants, config.BILLING_METER).select(
        "plant_id", "date", F.coalesce("kwh", F.lit(0.0)).alias("meter_kwh"))
    both = five_daily.join(meter, ["plant_id", "date"])
    return both.groupBy("plant_id").agg(
        F.count(F.lit(1)).alias("overlap_days"),
        guarded_corr("five_min_kwh", "meter_kwh").alias("correlation"),
        ratio(F.sum("five_min_kwh"), F.sum("meter_kwh")).alias("sum_ratio"),
        F.avg(F.abs(F.col("five_min_kwh") - F.col("meter_kwh"))).alias("mae_kwh"),
    ).where(F.col("overlap_days") >= min_days)


def _unpivot(df: DataFrame, columns: list[str], base: str) -> DataFrame:
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    return df.select("plant_id", "date", F.col(base).alias("base"),
                     F.expr(f"stack({len(columns)}, {pairs}) AS (key, kwh)")).where(
        F.col("base").isNotNull() & F.col("kwh").isNotNull())


def _relabel(column: str, labels: dict[str, str]):
    expr = F.when(F.lit(False), "")
    for key, label in labels.items():
        expr = expr.when(F.col(column) == key, label)
    return expr
