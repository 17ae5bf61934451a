"""Completeness, audit and quality summaries.

Expected counts come from calendar arithmetic. No 5-minute grid is ever materialised: a row lies on
the grid exactly when its distance from the grid origin is a multiple of the step.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heliospark import config
from heliospark.functions import labels, times
from heliospark.functions.numbers import (guarded_corr, ratio, score_closeness, score_correlation,
                                          weighted_score)
from heliospark.functions.solar import with_solar_position
from heliospark.operators.cleaning import select_plants
from heliospark.operators.hourly import day_grid


def daily_completeness(rows: DataFrame, step_minutes: int = 5) -> DataFrame:
    """Records collected, expected and missing per plant-day, with a status.

    ``rows`` is deduplicated: plant_id, generation_date, generation_kwh.
    """
    expected = 1440 // step_minutes
    on_grid = times.epoch_micros("generation_date") % (step_minutes * 60 * times.MICROS_PER_SECOND) == 0
    kwh = F.when(on_grid, F.col("generation_kwh"))
    daily = rows.groupBy("plant_id", times.floor_bucket("generation_date", 1440).alias("day")).agg(
        F.count(kwh).alias("records_collected"), F.sum(kwh).alias("total_production"))
    pct = F.bround(F.col("records_collected") / F.col("expected_records") * 100, 1)
    return day_grid(daily, "plant_id", "day").select(
        "plant_id", F.col("day").cast("date").alias("date"),
        F.coalesce("records_collected", F.lit(0)).cast("long").alias("records_collected"),
        F.coalesce("total_production", F.lit(0.0)).alias("total_production"),
        F.lit(expected).cast("long").alias("expected_records"),
    ).withColumns({
        "missing_records": F.col("expected_records") - F.col("records_collected"),
        "completeness_pct": pct,
        "status": F.when(F.col("total_production") == 0, "No Production Data")
        .when(F.col("records_collected") < F.col("expected_records"), "Partial Data").otherwise("Complete"),
    })


def incomplete_days(daily: DataFrame) -> DataFrame:
    """Days that are not complete, worst first."""
    return daily.where(F.col("status") != "Complete").orderBy("completeness_pct", "plant_id", "date")


def range_completeness(rows: DataFrame, step_minutes: int = 5) -> DataFrame:
    """Expected and collected records between each plant's first and last timestamp.

    The grid starts at the first timestamp. Rows are counted per phase within the step; the phase that
    holds the first timestamp is the one on the grid, so one aggregate cascade answers it.
    """
    return _range_columns(_by_phase(rows, step_minutes, {}), step_minutes)


def _by_phase(rows: DataFrame, step_minutes: int, sums: dict[str, Column]) -> DataFrame:
    """Per plant: first and last timestamp, records on the grid, and further sums over all rows."""
    step = step_minutes * 60 * times.MICROS_PER_SECOND
    phases = rows.withColumn("_us", times.epoch_micros("generation_date")).groupBy(
        "plant_id", (F.col("_us") % step).alias("_phase")).agg(
        F.count("generation_kwh").alias("_n"), F.min("_us").alias("_lo"), F.max("_us").alias("_hi"),
        F.min("generation_date").alias("start_date"), F.max("generation_date").alias("end_date"),
        *[expr.alias(name) for name, expr in sums.items()])
    return phases.groupBy("plant_id").agg(
        F.min_by("_n", "_lo").alias("total_collected"), F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"),
        F.min("start_date").alias("start_date"), F.max("end_date").alias("end_date"),
        *[F.sum(name).alias(name) for name in sums])


def _range_columns(spans: DataFrame, step_minutes: int, *carried: str) -> DataFrame:
    step = step_minutes * 60 * times.MICROS_PER_SECOND
    expected = (F.floor((F.col("_hi") - F.col("_lo")) / step) + 1).cast("long")
    return spans.select("plant_id", *carried, expected.alias("total_expected"), "total_collected").withColumns({
        "total_missing": F.col("total_expected") - F.col("total_collected"),
        "completeness_pct": F.col("total_collected") / F.col("total_expected") * 100,
    })


def timestamp_gaps(rows: DataFrame, step_minutes: int = 5, significant_minutes: int = 60) -> DataFrame:
    """Per plant: gaps longer than the threshold and the largest gap above one step.

    Successive differences are taken inside a day and, between days, from each day's first and last
    row, so a task holds one day of a plant or one row per day.
    """
    day = times.floor_bucket("generation_date", 1440)
    points = rows.select("plant_id", day.alias("day"), times.epoch_micros("generation_date").alias("us"))
    inside = Window.partitionBy("plant_id", "day").orderBy("us")
    gap = F.col("us") - F.lag("us").over(inside)
    long_gap = F.col("gap") > significant_minutes * 60 * times.MICROS_PER_SECOND
    per_day = points.withColumn("gap", gap).groupBy("plant_id", "day").agg(
        F.count_if(long_gap).alias("n"), F.max("gap").alias("widest"),
        F.min("us").alias("lo"), F.max("us").alias("hi"))
    along = Window.partitionBy("plant_id").orderBy("day")
    per_day = per_day.withColumn("gap", F.col("lo") - F.lag("hi").over(along))
    widest = F.max(F.greatest("widest", "gap"))
    return per_day.groupBy("plant_id").agg(
        F.sum(F.col("n") + F.when(long_gap, 1).otherwise(0)).alias("timestamp_gaps"),
        F.when(widest > step_minutes * 60 * times.MICROS_PER_SECOND, widest).alias("largest_gap_us"),
    ).select("plant_id", "timestamp_gaps",
             F.coalesce(F.col("largest_gap_us") / 3.6e9, F.lit(0.0)).alias("largest_gap_hours"))


def audit(rows: DataFrame, as_of: Column, by_clock: bool = False) -> DataFrame:
    """Audit measures per plant over deduplicated rows that keep negatives.

    ``as_of`` is the local moment freshness is judged at. Night is the sun below the horizon, or the
    clock from 20:00 to 05:00 with ``by_clock``.
    """
    kwh = F.col("generation_kwh")
    if by_clock:
        hour = F.hour("generation_date")
        lit, night = rows, (hour >= 20) | (hour < 5)
    else:
        lit, night = with_solar_position(rows), F.col("elevation") <= 0
    counts = {"negative_values": F.count_if(kwh < 0), "nighttime_production": F.count_if(night & (kwh > 0.1))}
    stats = _range_columns(_by_phase(lit, 5, counts), 5, "start_date", "end_date", *counts)
    since = times.whole_days(F.col("end_date"), as_of)
    return (stats.join(timestamp_gaps(rows), "plant_id").withColumn("days_since_last_data", since)
            .withColumns({
                "total_days": times.whole_days(F.col("start_date"), F.col("end_date")) + 1,
                "data_freshness": labels.audit_freshness(F.col("days_since_last_data")),
                "night_severity": F.lit("LOW" if by_clock else "MEDIUM"),
            }))


def audit_issues(audited: DataFrame) -> DataFrame:
    """One row per plant and issue found; timestamp gaps carry the largest one."""
    def issue(test: Column, kind: str, severity: Column, text: Column, count: Column, largest: Column | None = None) -> Column:
        largest = F.lit(None).cast("double") if largest is None else largest
        return F.when(test, F.struct(F.lit(kind).alias("type"), severity.alias("severity"), text.alias("description"),
                                     count.cast("long").alias("count"), largest.alias("largest_gap_hours")))

    since, gaps = F.col("days_since_last_data"), F.col("timestamp_gaps")
    negatives, night = F.col("negative_values"), F.col("nighttime_production")
    night_text = F.when(
        F.col("night_severity") == "LOW",
        F.format_string("%d records with production during night hours (20:00-5:00) - approximate check", night),
    ).otherwise(F.format_string(
        "%d records with production when sun is below horizon (solar elevation ≤ 0°)", night))
    found = F.array_compact(F.array(
        issue(since > 1, "Coverage Gap", F.lit("HIGH"), F.format_string(
            "Data stops on %s, %d days ago", F.col("end_date").cast("date").cast("string"), since), since),
        issue(gaps > 0, "Timestamp Gaps", F.lit("MEDIUM"), F.format_string(
            "%d gaps > 1 hour found in data sequence", gaps), gaps, F.col("largest_gap_hours")),
        issue(negatives > 0, "Negative Values", F.lit("HIGH"), F.format_string(
            "%d records with negative generation", negatives), negatives),
        issue(night > 0, "Nighttime Production", F.col("night_severity"), night_text, night)))
    return audited.select("plant_id", F.explode(found).alias("i")).select("plant_id", "i.*")


def source_completeness(df: DataFrame, ts: str, bucket_minutes: int, as_of_utc: Column) -> DataFrame:
    """Distinct UTC buckets against the bucket grid between first and last, per plant.

    ``ts`` is a UTC wall-clock column. Distinct minutes are gathered as a bit mask, which avoids a
    second distinct aggregation.
    """
    rows = df.where(F.col(ts).isNotNull())
    buckets = rows.groupBy("plant_id", times.floor_bucket(ts, bucket_minutes).alias("bucket")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.minute(ts))).alias("minutes"))
    spans = buckets.groupBy("plant_id").agg(
        F.count(F.lit(1)).alias("collected_records"), F.min("bucket").alias("first_bucket"),
        F.max("bucket").alias("last_bucket"), F.bit_count(F.bit_or("minutes")).alias("distinct_minutes"))
    seconds = times.epoch_seconds("last_bucket") - times.epoch_seconds("first_bucket")
    expected = (seconds / (bucket_minutes * 60)).cast("long") + 1
    since = times.whole_days(F.col("last_bucket"), as_of_utc)
    return spans.withColumns({"expected_records": expected, "days_since_last_data": since}).withColumns({
        "missing_records": F.greatest(F.col("expected_records") - F.col("collected_records"), F.lit(0).cast("long")),
        "completeness_pct": F.col("collected_records") / F.col("expected_records") * 100,
        "freshness": labels.source_freshness(F.col("days_since_last_data")),
        "irregular_minutes": F.col("distinct_minutes") > 2,
    })


# Display roles per source.
ROLES = {
    config.FIVE_MIN: "Cleaned hourly model target source",
    config.HOURLY_INVERTER: "Confirmation / inverter cross-check",
    config.DAILY_INVERTER: "Aggregate confirmation",
    config.HOURLY_METER: "Meter cross-check",
    config.BILLING_METER: "Aggregate meter check",
}


# Time column and bucket in minutes per source, and the status texts.
CATALOGUE = {
    config.FIVE_MIN: ("generation_date", 5),
    config.HOURLY_INVERTER: ("generation_date", 60),
    config.DAILY_INVERTER: ("generation_date", 1440),
    config.HOURLY_METER: ("date", 60),
    config.BILLING_METER: ("date", 1440),
}
AVAILABLE, MISSING = "Available", "Missing file"
NO_COLUMNS, NO_ROWS = "Unavailable: required columns not found", "Unavailable: no rows for selected plant"


def source_status(sources: dict[str, DataFrame | None], plants: DataFrame, as_of_utc: Column) -> DataFrame:
    """Completeness, freshness, status and role of every catalogued source for every plant, absent sources included.

    ``sources`` holds raw tables by catalogue name; None or no entry means that the file is missing. A table
    without its columns, or without a readable timestamp of a plant, is unavailable and never promoted.
    """
    found, states = [], []
    for name, (ts, bucket) in CATALOGUE.items():
        df = sources.get(name)
        if df is None:
            states.append(MISSING)
        elif not {"plant_id", ts} <= set(df.columns):
            states.append(NO_COLUMNS)
        else:
            states.append(NO_ROWS)
            rows = select_plants(df, plants).select("plant_id", times.utc_to_local(df, ts, "UTC").alias("utc"))
            found.append(source_completeness(rows, "utc", bucket, as_of_utc).withColumn("source", F.lit(name)))
    entries = F.array(*[F.struct(F.lit(name).alias("source"), F.lit(state).alias("_absent")) for name, state in zip(CATALOGUE, states)])
    grid = plants.select("plant_id", F.inline(entries))
    measures = ["first_bucket", "last_bucket", "expected_records", "collected_records", "missing_records", "completeness_pct",
                "days_since_last_data", "freshness", "irregular_minutes"]
    if found:
        measured = functools.reduce(DataFrame.unionByName, found).select("plant_id", "source", *measures)
    else:
        empty = source_completeness(plants.select("plant_id", F.lit(None).cast("timestamp_ntz").alias("utc")), "utc", 60, as_of_utc)
        measured = empty.withColumn("source", F.lit(None).cast("string")).select("plant_id", "source", *measures)
    there = F.col("collected_records").isNotNull()
    out = grid.join(measured, ["plant_id", "source"], "left").withColumns({
        "status": F.when(there, AVAILABLE).otherwise(F.col("_absent")),
        "freshness": F.when(there, F.col("freshness")).when(F.col("_absent") == MISSING, "Missing").otherwise("Unavailable"),
    })
    return source_roles(out.select("plant_id", "source", "status", *measures))


def source_roles(completeness: DataFrame) -> DataFrame:
    """Role of each source per plant; meters are promoted when the model source is partial or weak.

    Input has one row per plant and source: plant_id, source, completeness_pct. Where it has a status,
    only available meters are promoted.
    """
    model = completeness.where(F.col("source") == config.FIVE_MIN).select(
        "plant_id", F.col("completeness_pct").alias("model_pct"))
    partial, weak = F.col("model_pct") < 95, F.col("model_pct") < 70
    meter = F.col("source").isin(config.HOURLY_METER, config.BILLING_METER)
    if "status" in completeness.columns:
        meter = meter & (F.col("status") == AVAILABLE)
    base = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])[F.col("source")]
    return completeness.join(model, "plant_id", "left").withColumn(
        "role",
        F.when((F.col("source") == config.FIVE_MIN) & partial, "Primary model source (partial)")
        .when(meter & weak, "Fallback candidate + confirmation")
        .when(meter & partial, "Confirmation / fallback candidate").otherwise(base)).drop("model_pct")


def daylight_availability(hourly: DataFrame, min_elevation: float = config.MIN_SUN_ELEVATION) -> DataFrame:
    """Share of daylight hours that have a usable target."""
    daylight = F.col("elevation") > min_elevation
    return with_solar_position(hourly).groupBy("plant_id").agg(
        F.count_if(daylight).alias("total_hours"),
        F.count_if(daylight & F.col("data_available")).alias("available_hours"),
    ).withColumn("availability_pct", ratio(F.col("available_hours"), F.col("total_hours")) * 100)


def quality_summary(hourly: DataFrame, agreement: DataFrame, plants: DataFrame,
                    known_issue_plants: tuple[str, ...] = ("Plant E",)) -> DataFrame:
    """Target completeness and billing agreement per plant, with warnings."""
    daylight = F.col("elevation") > config.MIN_SUN_ELEVATION
    usable = F.col("data_available")
    hours = with_solar_position(hourly).groupBy("plant_id").agg(
        F.count(F.lit(1)).alias("total_hourly_targets"),
        F.count_if(usable).alias("usable_hourly_targets"),
        F.count_if(daylight).alias("daylight_modeling_hours"),
        F.count_if(daylight & usable).alias("usable_daylight_modeling_hours"),
        F.sum("records_collected").alias("five_min_records_collected"),
        F.sum("expected_records").alias("five_min_records_expected"))
    five, billing = F.col(config.FIVE_MIN), F.col(config.BILLING_METER)
    billed = agreement.where(five.isNotNull() & billing.isNotNull()).groupBy("plant_id").agg(
        guarded_corr(five, billing).alias("billing_meter_to_5min_overlap_corr"),
        ratio(F.sum(five), F.sum(billing)).alias("five_min_total_div_billing_meter_total"))
    pct = lambda a, b: ratio(F.col(a), F.col(b)) * 100
    out = hours.join(billed, "plant_id", "left").join(plants.select("plant_id", "plant_name"), "plant_id").withColumns({
        "usable_hourly_targets_pct": pct("usable_hourly_targets", "total_hourly_targets"),
        "usable_daylight_modeling_hours_pct": pct("usable_daylight_modeling_hours", "daylight_modeling_hours"),
        "five_min_record_completeness_pct": pct("five_min_records_collected", "five_min_records_expected"),
    })
    billing_ratio = F.col("five_min_total_div_billing_meter_total")
    return out.withColumn("warnings", labels.joined_warnings(
        F.when(F.col("usable_daylight_modeling_hours_pct") < 60, "Low usable daylight coverage"),
        F.when(F.col("plant_name").isin(*known_issue_plants), "Known source-data issue"),
        F.when((billing_ratio < 0.8) | (billing_ratio > 1.2),
               "Billing-meter total differs from 5-minute inverter total")))


def quality_overview(availability: DataFrame, summaries: DataFrame, plants: DataFrame) -> DataFrame:
    """Data-quality score per plant from daylight coverage and source agreement."""
    names = {"Hourly inverter": "hourly", "Daily inverter": "daily", "Hourly meter": "meter", "Billing meter": "billing"}
    pick = lambda label, c: F.max(F.when(F.col("source") == label, F.col(c)))
    wide = summaries.groupBy("plant_id").agg(*[
        pick(label, c).alias(f"{short}_{alias}")
        for label, short in names.items()
        for c, alias in [("correlation", "corr"), ("source_to_5min_total", "ratio"), ("matching_days_pct", "match")]
    ])
    pair = lambda s: weighted_score([
        (score_correlation(F.col(f"{s}_corr")), 0.5), (score_closeness(F.col(f"{s}_ratio")), 0.5)])
    source = weighted_score([(F.col("hourly_match"), 0.20), (pair("daily"), 0.35), (pair("billing"), 0.45)])
    base = plants.select("plant_id", "plant_name").join(
        availability.select("plant_id", "availability_pct"), "plant_id", "left").join(wide, "plant_id", "left")
    scored = base.withColumn("source_agreement_score", source).withColumn(
        "data_quality_score",
        weighted_score([(F.col("availability_pct"), 0.55), (F.col("source_agreement_score"), 0.45)]))
    return scored.select(
        "plant_id", "plant_name", "data_quality_score",
        labels.quality_band(F.col("data_quality_score")).alias("data_quality_band"),
        F.col("availability_pct").alias("usable_daylight_pct"), "source_agreement_score",
        F.col("hourly_match").alias("hourly_inverter_match_pct"),
        F.col("daily_ratio").alias("daily_inverter_ratio"), F.col("daily_corr").alias("daily_inverter_corr"),
        F.col("meter_ratio").alias("hourly_meter_ratio"), F.col("meter_corr").alias("hourly_meter_corr"),
        F.col("billing_ratio").alias("billing_meter_ratio"), F.col("billing_corr").alias("billing_meter_corr"),
        labels.joined_warnings(
            F.when(F.col("availability_pct") < 60, "Low daylight coverage"),
            F.when(F.col("source_agreement_score") < 60, "Weak source agreement"),
            F.when((F.col("billing_ratio") < 0.8) | (F.col("billing_ratio") > 1.2),
                   "Meter total differs from inverter")).alias("warnings"),
    ).orderBy(F.desc_nulls_last("data_quality_score"), "plant_id")


def quality_cards(plants: DataFrame, overview: DataFrame | None, summary: DataFrame | None) -> DataFrame:
    """Compact quality per plant: the overview, else the clean summary, else a request to rebuild."""
    out = plants.select("plant_id", "plant_name")
    empty = {"band": None, "pct": None, "warnings": None}
    if overview is not None:
        out = out.join(overview.select("plant_id", F.col("data_quality_band").alias("o_band"),
                                       F.col("usable_daylight_pct").alias("o_pct"),
                                       F.col("warnings").alias("o_warnings"), F.lit(True).alias("o_there")),
                       "plant_id", "left")
    else:
        out = out.withColumns({f"o_{k}": F.lit(v).cast("string") for k, v in empty.items()} | {"o_there": F.lit(None).cast("boolean")})
    if summary is not None:
        pct = F.col("usable_daylight_modeling_hours_pct")
        band = F.when(pct >= 85, "Good").when(pct >= 60, "Usable").otherwise("Poor")
        out = out.join(summary.select("plant_id", band.alias("s_band"), pct.alias("s_pct"),
                                      F.col("warnings").alias("s_warnings"), F.lit(True).alias("s_there")),
                       "plant_id", "left")
    else:
        out = out.withColumns({f"s_{k}": F.lit(v).cast("string") for k, v in empty.items()} | {"s_there": F.lit(None).cast("boolean")})

    def choose(name: str, default: str) -> Column:
        return F.when(F.col("o_there"), F.col(f"o_{name}")).when(F.col("s_there"), F.col(f"s_{name}")).otherwise(default)

    pct = F.when(F.col("o_there"), F.col("o_pct").cast("double")).when(F.col("s_there"), F.col("s_pct").cast("double"))
    shown = F.when(pct.isNull(), "n/a").otherwise(F.format_string("%.1f%%", F.bround(pct, 1)))
    return out.select("plant_id", "plant_name", choose("band", "Needs rebuild").alias("band"),
                      shown.alias("completeness"), choose("warnings", "Run the clean build").alias("warnings"))


def completeness_grid(daily: DataFrame, value: str = "completeness_pct") -> DataFrame:
    """Completeness by week (rows) and weekday (seven fixed columns)."""
    names = ["mon", "tue", "wed", "thu", "fri", "sat", "sun"]
    return daily.groupBy("plant_id", times.week_start("date").alias("week_start")).agg(*[
        F.max(F.when(F.weekday("date") == i, F.col(value))).alias(name) for i, name in enumerate(names)])


def fleet_summary(overview: DataFrame, models: DataFrame) -> DataFrame:
    """Quality overview next to the best-model summary."""
    return overview.select("plant_id", "plant_name", "data_quality_band", "usable_daylight_pct", "warnings").join(
        models.select("plant_id", "best_model", "r2", "wape", "reliability"), "plant_id", "left")


def plant_quality_issues(availability: DataFrame, models: DataFrame) -> DataFrame:
    """Visible reliability issues per plant as a list of texts."""
    out = availability.join(models.select("plant_id", "r2", "wape"), "plant_id", "full")
    pct, r2, wape = F.col("availability_pct"), F.col("r2"), F.col("wape")
    issues = F.array_compact(F.array(
        F.when(pct < config.MIN_AVAILABILITY_PCT, F.format_string(
            "Only %.1f%% of daylight/modeling hours have enough 5-minute records.", pct)),
        F.when(r2 < config.MIN_TEST_R2, F.format_string(
            "Model test R² is %.3f, worse than a simple mean baseline.", r2)),
        F.when(wape > config.MAX_TEST_WAPE_PCT, F.format_string("Model WAPE is high at %.1f%%.", wape))))
    return out.select("plant_id", "availability_pct", "available_hours", "total_hours", "r2", "wape",
                      issues.alias("issues"))
