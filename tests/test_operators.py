"""Edge rules on small hand-written frames."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from heliospark import config
from heliospark.functions import labels, numbers, times
from heliospark.functions.solar import ineichen_ghi, with_clearsky, with_solar_position
from heliospark.models import ensembles, linear
from heliospark.models.fleet import best_models, comparison, train_fleet
from heliospark.operators import cleaning, completeness, daily, features, hourly, kpi, outlook, splits
from heliospark.sources import intermediate, sinks, tables

A = 900001
DAY = dt.datetime(2024, 1, 1)


def at(hours: float) -> dt.datetime:
    return DAY + dt.timedelta(hours=hours)


def series(spark, values, step_hours=1.0, plant=A):
    rows = [(plant, at(i * step_hours), None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "plant_id long, generation_date timestamp_ntz, generation_kwh double")


def column(df, name, order="generation_date"):
    return [row[name] for row in df.orderBy(order).collect()]


def raw_log(spark, rows):
    return spark.createDataFrame(rows, "plant_id long, generation_date string, generation_amount string, ingest_seq long")


# --- parsing -----------------------------------------------------------------

@pytest.mark.parametrize("text, expected", [
    ("2024-01-01 05:00:00", dt.datetime(2024, 1, 1, 11)),
    ("2024-01-01 05:00:00 UTC", dt.datetime(2024, 1, 1, 11)),
    ("2024-01-01 05:00:00 +0000 UTC", dt.datetime(2024, 1, 1, 11)),
    ("2024-01-01T05:00:00Z", dt.datetime(2024, 1, 1, 11)),
    ("2024-01-01 05:00:00+06:00", dt.datetime(2024, 1, 1, 5)),
    ("2024-01-01 05:00:00.25", dt.datetime(2024, 1, 1, 11, 0, 0, 250000)),
    ("2024-01-01", dt.datetime(2024, 1, 1, 6)),
    ("soon", None), ("", None), (None, None),
])
def test_utc_to_local_reads_every_spelling(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(times.utc_to_local(df, "t").alias("v")).first().v == expected


def test_utc_to_local_of_typed_columns(spark):
    df = spark.sql("SELECT TIMESTAMP'2024-01-01 05:00:00' AS i, TIMESTAMP_NTZ'2024-01-01 05:00:00' AS n")
    row = df.select(times.utc_to_local(df, "i").alias("i"), times.utc_to_local(df, "n").alias("n")).first()
    assert row.i == row.n == dt.datetime(2024, 1, 1, 11)


@pytest.mark.parametrize("text, expected", [("1,234.5", 1234.5), ("-7", -7.0), ("n/a", None), ("NaN", None), (None, None)])
def test_numeric_amount(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(numbers.numeric_amount("t").alias("v")).first().v == expected


# --- cleaning ----------------------------------------------------------------

def test_clean_generation_keeps_the_last_valid_copy(spark, fleet):
    stamp = "2024-01-01 00:00:00"
    df = raw_log(spark, [(A, stamp, "1,000", 1), (A, stamp, "2,000", 2), (A, stamp, "-5", 3), (A, stamp, "n/a", 4),
                         (A, "never", "9", 5), (123, stamp, "9", 6)])
    rows = cleaning.clean_generation(df, fleet).collect()
    assert len(rows) == 1
    assert rows[0].generation_kwh == 2.0 and rows[0].duplicate_rows_removed_for_same_plant_timestamp == 1
    audit = cleaning.audit_rows(df, fleet).collect()
    assert len(audit) == 1 and audit[0].generation_kwh is None


def test_dedup_last_survives_a_key_with_most_rows(spark):
    df = spark.range(20000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"), F.col("id").alias("seq"),
                                   (F.col("id") * 2).alias("v"))
    out = cleaning.dedup_last(df, ["k"], ["seq"])
    assert out.where("k = 1").first().v == 2 * 19999 if 19999 % 3 == 0 else out.where("k = 1").first().v == 2 * 19998
    assert out.count() == df.select("k").distinct().count()


# --- hourly targets ----------------------------------------------------------

def test_nine_of_twelve_records_are_too_few_and_ten_suffice(spark, fleet):
    rows = [(A, at(h) + dt.timedelta(minutes=5 * i), 1.0) for h, n in ((0, 9), (1, 10), (3, 12)) for i in range(n)]
    df = spark.createDataFrame(rows, "plant_id long, generation_date timestamp_ntz, generation_kwh double")
    out = hourly.hourly_targets(df, fleet)
    assert column(out, "data_completeness_pct") == pytest.approx([75.0, 83.333333, 0.0, 100.0])
    assert column(out, "generation_kwh") == [None, 10.0, None, 12.0]
    assert column(out, "generation_kwh_raw") == [9.0, 10.0, None, 12.0]
    assert column(out, "missing_records") == [3, 2, 12, 0]


def test_hourly_grid_has_no_holes_and_counts_every_row(spark, fleet):
    rows = [(A + i % 2, at((i * 7919 % 5000) / 12), 0.5) for i in range(400)]
    df = spark.createDataFrame(rows, "plant_id long, generation_date timestamp_ntz, generation_kwh double").distinct()
    out = hourly.hourly_targets(df, fleet).cache()
    assert out.agg(F.sum("records_collected")).first()[0] == df.count()
    for plant in (A, A + 1):
        hours = column(out.where(F.col("plant_id") == plant), "generation_date")
        assert all(b - a == dt.timedelta(hours=1) for a, b in zip(hours, hours[1:]))


def test_diagnostics_flags(spark, fleet):
    five, log = [], []
    for h, (n, total, logged) in enumerate([(12, 12.0, 12.0), (12, 12.0, 13.0), (12, 12.0, 20.0), (12, 12.0, None), (3, 3.0, 11.0), (3, 3.0, None), (12, 0.0, 0.0)]):
        stamp = dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
        five += [(A, str(stamp + dt.timedelta(minutes=5 * i)), str(total / n * 1000), h * 100 + i) for i in range(n)]
        if logged is not None:
            log.append((A, str(stamp), str(logged * 1000), h))
    out = hourly.hourly_source_diagnostics(raw_log(spark, five), raw_log(spark, log), fleet)
    assert column(out, "target_quality_flag") == ["confirmed_5min", "moderate_difference", "large_difference", "5min_primary",
                                                  "hourly_fallback", "missing", "confirmed_5min"]
    assert column(out, "target_quality_score") == [3, 2, 1, 3, 2, 0, 3]
    assert column(out, "generation_kwh_final")[4:6] == [11.0, None]


# --- daily sources -----------------------------------------------------------

def meter_oracle(rows):
    """Sequential differences per meter in (time, reading) order."""
    out, last = {}, {}
    for plant, meter, stamp, reading in sorted(rows):
        key, previous = (plant, stamp.date()), last.get((plant, meter))
        total, n = out.get(key, (None, 0))
        if previous is not None and reading >= previous:
            total, n = (total or 0.0) + (reading - previous) / 1000, n + 1
        out[key] = (total, n)
        last[plant, meter] = reading
    return out


@pytest.mark.parametrize("chunk", [5, 60, 1440])
def test_meter_differences_cross_chunks_ties_and_a_hot_meter(spark, fleet, chunk):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(1200):
        meter = "hot" if i % 3 == 0 else f"m{i % 5}"
        local = DAY + dt.timedelta(minutes=int(rng.integers(0, 4 * 1440)))
        rows.append((A, meter, local, float(rng.integers(0, 5000))))
    rows += [(A, "hot", DAY + dt.timedelta(hours=30), 777.0)] * 400
    raw = [(p, m, str(t - dt.timedelta(hours=6)), str(r)) for p, m, t, r in rows]
    df = spark.createDataFrame(raw, "plant_id long, meter_id string, date string, meter_reading string")
    got = {(r.plant_id, r.date): (r.kwh, r.records) for r in daily.daily_meter(df, fleet, config.BILLING_METER, chunk).collect()}
    want = meter_oracle(rows)
    assert got.keys() == want.keys()
    for key, (kwh, n) in want.items():
        assert got[key][1] == n and got[key][0] == (pytest.approx(kwh) if kwh is not None else None)


def test_agreement_flag_boundaries_and_closest_reference(spark, fleet):
    cells = [(100.0, 104.9, None), (100.0, 120.0, None), (100.0, 121.0, None), (100.0, None, None), (0.005, 9.0, None), (100.0, 300.0, 101.0)]
    rows = [(A, (DAY + dt.timedelta(days=i)).date(), *c) for i, c in enumerate(cells)]
    df = spark.createDataFrame(rows, "plant_id long, date date, five_min_kwh double, daily_inverter_kwh double, billing_meter_kwh double")
    out = daily.daily_agreement(df, fleet)
    assert column(out, "source_agreement_flag", "date") == [
        "close_agreement", "moderate_difference", "large_difference", "no_reference_overlap", "no_reference_overlap", "close_agreement"]


def test_weak_days_use_the_plant_threshold(spark, fleet):
    rows = [(p, DAY.date(), 10.0, 1.5) for p in (A, A + 3)] + [(A + 3, at(24).date(), 0.5, 9.0), (A, at(48).date(), 10.0, 2.5)]
    df = spark.createDataFrame(rows, "plant_id long, date date, five_min_kwh double, daily_inverter_kwh_ratio_to_5min double")
    assert sorted((r.plant_id, r.date) for r in daily.weak_days(df, fleet).collect()) == [(A, at(48).date()), (A + 3, DAY.date())]


def test_constant_sources_have_no_correlation(spark):
    rows = [(A, (DAY + dt.timedelta(days=i)).date(), 5.0, 5.0) for i in range(3)]
    df = spark.createDataFrame(rows, "plant_id long, date date, five_min_kwh double, billing_meter_kwh double")
    row = daily.source_summaries(df).first()
    assert row.correlation is None and row.matching_days_pct == 100.0 and row.source == "Billing meter"


# --- completeness and audit --------------------------------------------------

def test_daily_completeness_status(spark):
    rows = [(A, DAY + dt.timedelta(minutes=5 * i), 1.0) for i in range(288)]
    rows += [(A, at(48) + dt.timedelta(minutes=5 * i), 0.0) for i in range(288)] + [(A, at(72) + dt.timedelta(minutes=7), 1.0), (A, at(73), 1.0)]
    df = spark.createDataFrame(rows, "plant_id long, generation_date timestamp_ntz, generation_kwh double")
    out = completeness.daily_completeness(df)
    assert column(out, "status", "date") == ["Complete", "No Production Data", "No Production Data", "Partial Data"]
    assert column(out, "records_collected", "date") == [288, 0, 288, 1]
    assert column(out, "completeness_pct", "date")[3] == 0.3


def test_audit_finds_injected_defects(spark):
    rows = [(A, at(32) + dt.timedelta(minutes=5 * i), 1.0) for i in range(24)] + [(A, at(37), -1.0), (A, at(44), 5.0)]
    df = spark.createDataFrame(rows, "plant_id long, generation_date timestamp_ntz, generation_kwh double")
    audited = completeness.audit(df, F.lit(at(24 * 20)).cast("timestamp_ntz"))
    row = audited.first()
    assert (row.timestamp_gaps, row.largest_gap_hours, row.negative_values, row.nighttime_production) == (2, 7.0, 1, 1)
    assert row.data_freshness == "STALE" and row.total_expected == 12 * 12 + 1
    assert {(r.type, r["count"]) for r in completeness.audit_issues(audited).collect()} == {
        ("Coverage Gap", 18), ("Timestamp Gaps", 2), ("Negative Values", 1), ("Nighttime Production", 1)}


def test_scores_skip_missing_parts_and_stay_in_range(spark):
    df = spark.createDataFrame([(2.5, -0.4), (1.0, 1.0), (None, None)], "ratio double, corr double")
    rows = df.select(numbers.score_closeness(F.col("ratio")).alias("c"), numbers.score_correlation(F.col("corr")).alias("k"),
                     numbers.weighted_score([(F.col("ratio"), 0.5), (F.lit(None).cast("double"), 0.5)]).alias("w")).collect()
    assert [tuple(r) for r in rows] == [(0.0, 0.0, 2.5), (100.0, 100.0, 1.0), (None, None, None)]


def test_interpretation_texts(spark):
    df = spark.createDataFrame([(1.049,), (1.5,), (0.4,), (None,)], "r double")
    assert [r.t for r in df.select(labels.control_interpretation(F.col("r")).alias("t")).collect()] == [
        "Close agreement", "Candidate is 50% higher than control", "Candidate is 60% lower than control", "n/a"]


# --- sun ---------------------------------------------------------------------

def test_sun_at_known_moments(spark):
    rows = [(dt.datetime(2024, 6, 20, 11, 58),), (dt.datetime(2024, 3, 20, 0, 0),), (dt.datetime(2024, 12, 21, 12, 0),)]
    df = with_solar_position(spark.createDataFrame(rows, "generation_date timestamp_ntz"))
    noon, midnight, winter = df.collect()
    assert noon.elevation == pytest.approx(90 - abs(config.LATITUDE - 23.44), abs=0.7)
    assert midnight.elevation < -60
    assert winter.elevation == pytest.approx(90 - (config.LATITUDE + 23.44), abs=0.5) and 170 < winter.azimuth < 195


def test_azimuth_rises_through_the_day_and_clearsky_is_dark_at_night(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 10, h),) for h in range(24)], "generation_date timestamp_ntz")
    rows = with_clearsky(with_solar_position(df), F.lit(100.0)).orderBy("generation_date").collect()
    day = [r.azimuth for r in rows if r.elevation > 0]
    assert day == sorted(day)
    assert all((r.ghi == 0.0) == (r.elevation <= 0) for r in rows)
    lit = with_solar_position(df).select(ineichen_ghi(F.col("generation_date"), F.col("elevation"), [4.0] * 12).alias("g")).collect()
    assert 500 < max(r.g for r in lit) < 1000 and min(r.g for r in lit) == 0.0


# --- windows -----------------------------------------------------------------

def test_interpolation_fills_inside_and_at_both_ends(spark):
    df = series(spark, [None, None, 1, None, None, 4, None])
    assert column(features.interpolate_linear(df, ["generation_kwh"]), "generation_kwh") == [1, 1, 1, 2, 3, 4, 4]
    ahead = features.interpolate_linear(df, ["generation_kwh"], both_ends=False)
    assert column(ahead, "generation_kwh") == [None, None, 1, 2, 3, 4, 4]


def test_rolling_needs_twenty_four_values(spark):
    df = series(spark, [None] * 3 + list(range(30))).withColumn("temp", F.lit(1.0))
    out = column(features.add_rolling(df), "production_7d_mean")
    assert out[25] is None and out[26] == pytest.approx(np.mean(range(24)))


def test_lags_count_rows_or_hours(spark):
    df = series(spark, range(30)).where(F.hour("generation_date") != 3)
    assert column(features.add_lags(df), "production_lag_24h")[24] == 0.0
    by_time = features.add_lags(df, time_aligned=True).where(F.col("generation_date") == at(26)).first()
    assert by_time.production_lag_24h == 2.0


def test_impute_goes_forward_then_backward_then_zero(spark):
    df = series(spark, [None, 2, None, 5]).withColumn("none", F.lit(None).cast("double"))
    out = features.impute_features(df, ["generation_kwh", "none"])
    assert column(out, "generation_kwh") == [2, 2, 2, 5] and column(out, "none") == [0] * 4


def test_trend_ignores_empty_days(spark):
    out = features.daily_trend(series(spark, [4, 0, 8], 24))
    assert column(out, "rolling_avg_7d", "date") == [4.0, 4.0, 6.0]


def test_upsampling_uses_only_full_hours(spark):
    rows = [(A, at(0), 0.0, "Clear"), (A, at(3), 6.0, "Rain"), (A, at(6.5), 9.0, "Fog")]
    df = spark.createDataFrame(rows, "plant_id long, generation_date timestamp_ntz, temp double, sky string")
    out = outlook.upsample_hourly(df)
    assert column(out, "temp") == [0, 2, 4, 6, 6, 6, 6]
    assert column(out, "sky") == ["Clear"] * 3 + ["Rain"] * 4


def test_hour_matched_lags(spark):
    history = series(spark, [h % 24 for h in range(24 * 8)])
    ahead = spark.createDataFrame([(A, at(24 * 8 + 5)), (A + 1, at(5))], "plant_id long, generation_date timestamp_ntz")
    rows = {r.plant_id: r for r in outlook.hour_matched_lags(ahead, history).collect()}
    assert (rows[A].production_lag_24h, rows[A].production_lag_168h, rows[A].production_7d_mean) == (5.0, 5.0, 12.0)
    assert (rows[A + 1].production_lag_24h, rows[A + 1].production_7d_mean) == (0.0, 0.0)


# --- splits ------------------------------------------------------------------

def test_split_by_date_and_by_position(spark, fleet):
    df = series(spark, range(240))
    dated = splits.split_train_test(df, split_date=dt.date(2024, 1, 6), min_test=50)
    assert dated.where("split = 'test'").agg(F.min("generation_date")).first()[0] == at(120)
    placed = splits.split_train_test(df, fleet)
    assert placed.where("split = 'train'").count() == 192


def test_folds_expand(spark):
    out = splits.time_series_folds(series(spark, range(10)))
    assert column(out, "fold") == [0, 0, 0, 0, 1, 1, 2, 2, 3, 3]
    train, test = splits.fold_sides(out, 2)
    assert train.count() == 6 and test.count() == 2


# --- KPIs --------------------------------------------------------------------

def test_daily_metrics_of_an_unpredicted_day(spark):
    df = series(spark, [None, None]).withColumn("ml_predicted_kwh", F.lit(0.0))
    row = kpi.daily_metrics(df).first()
    assert (row.actual_total, row.performance_ratio, row.has_anomaly, row.num_hours) == (0.0, 0.0, True, 2)
    assert kpi.underperforming_days(df).count() == 0


def test_anomalies_only_among_the_latest_dates(spark):
    df = series(spark, [1] * 100, 24).withColumn("ml_predicted_kwh", F.lit(10.0))
    df = df.withColumn("generation_kwh", F.when(F.col("generation_date") == at(24 * 99), 0.0).otherwise(F.col("generation_kwh")))
    row = kpi.anomaly_review(df).first()
    assert row.underperformance_days == 90 and row.total_deficit_kwh == pytest.approx(89 * 9.0)
    assert kpi.anomaly_days(df).where("status = 'Missing Data'").count() == 1


def test_calendar_stops_at_the_given_day(spark, fleet):
    out = kpi.production_calendar(series(spark, [3], 1), fleet, 2024, F.lit(dt.date(2024, 2, 10)))
    assert out.count() == 41 * 5 and out.agg(F.sum("production")).first()[0] == 3.0


# --- models ------------------------------------------------------------------

def synthetic(spark, plants=2, n=600):
    rng = np.random.default_rng(1)
    rows = []
    for p in range(plants):
        x = rng.normal(size=(n, 2)) * [5, 1] + [3, 40]
        y = x @ [2.0 + p, -1.0] + 60 + rng.normal(size=n)
        rows += [(A + p, DAY + dt.timedelta(hours=i), float(y[i]), float(x[i, 0]), float(x[i, 1])) for i in range(n)]
    return spark.createDataFrame(rows, "plant_id long, generation_date timestamp_ntz, generation_kwh double, a double, b double")


def closed_form(pdf, alpha=100.0):
    x, y = pdf[["a", "b"]].to_numpy(), pdf["generation_kwh"].to_numpy()
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + alpha * np.eye(2), xc.T @ yc)
    return w, y.mean() - x.mean(0) @ w


def test_fleet_ridge_and_single_ridge_equal_the_closed_form(spark):
    df = synthetic(spark).cache()
    for row in linear.fit_fleet_ridge(df, ["a", "b"]).collect():
        w, intercept = closed_form(df.where(F.col("plant_id") == row.plant_id).toPandas())
        assert row.coefficients == pytest.approx(w, rel=1e-8) and row.intercept == pytest.approx(intercept, rel=1e-8)
    one = df.where(F.col("plant_id") == A)
    model = ensembles.fit(one, "ridge", ["a", "b"]).stages[-1]
    w, intercept = closed_form(one.toPandas())
    assert list(model.coefficients) == pytest.approx(w, rel=1e-6) and model.intercept == pytest.approx(intercept, rel=1e-6)


def test_train_fleet_ranks_saves_and_isolates_failures(spark, fleet, tmp_path):
    df = synthetic(spark)
    only_test = df.where("plant_id = 900001").limit(1).withColumn("plant_id", F.lit(A + 2).cast("long")).withColumn(
        "generation_date", F.lit(dt.datetime(2025, 7, 1)).cast("timestamp_ntz"))
    small = {"forest": {"numTrees": 5, "maxDepth": 4}, "boosting": {"maxIter": 3, "maxDepth": 3}, "subsampled_boosting": {"maxIter": 3, "maxDepth": 3}}
    run = train_fleet(df.unionByName(only_test), fleet, ["a", "b"], params=small, min_test=0, split_date=dt.date(2024, 1, 20))
    assert A + 2 in run.failures and A not in run.failures
    table = comparison(run)
    assert table.where(F.col("plant_id") == A).count() == 4
    assert table.where("model = 'Ridge Regression' AND plant_id = 900001").first().r2 > 0.9
    assert {plant for plant, _ in run.models} == {row.plant_id for row in table.select("plant_id").distinct().collect()}
    assert A + 2 not in best_models(run) and set(best_models(run)) == {plant for plant, _ in run.models}
    sinks.save_run(run.models, table, str(tmp_path / "run"), fleet, ["a", "b"])
    again = sinks.load_model(str(tmp_path / "run"), A, "ridge")
    assert ensembles.predict(again, df).count() == df.count()
    assert sinks.load_features(spark, str(tmp_path / "run")) == ["a", "b"]
    assert sinks.load_registry(spark, str(tmp_path / "run")).count() == table.count()
    sinks.save_run({}, table.where(F.col("plant_id") == A).limit(1), str(tmp_path / "run"))
    kept = sinks.load_registry(spark, str(tmp_path / "run"))
    assert kept.where(F.col("plant_id") == A).count() == 1
    assert kept.where(F.col("plant_id") != A).count() == table.where(F.col("plant_id") != A).count()


def test_tuning_prefers_the_better_alpha(spark):
    _, best, trials = ensembles.tune(synthetic(spark, 1), "ridge", ["a", "b"], {"alpha": [0.1, 1e6]})
    assert best == {"alpha": 0.1} and len(trials) == 2
    assert len(ensembles.grid_points(config.BOUNDED_GRIDS["forest"], 8)) == 8


# --- tables ------------------------------------------------------------------

def test_clean_tables_round_trip(spark, fleet, tmp_path):
    rows = hourly.hourly_targets(series(spark, [1, 2, 3]), fleet, 1)
    sinks.write_clean({"hourly_model_targets": rows, "plants_clean": fleet}, str(tmp_path))
    back = sinks.read_clean(spark, str(tmp_path), "hourly_model_targets")
    assert back.count() == 3 and set(back.columns) == set(rows.columns)
    sinks.write_clean({"plants_clean": fleet.select("plant_id", "plant_name")}, str(tmp_path / "csv"), "csv")
    again = tables.read_table(spark, str(tmp_path / "csv" / "plants_clean"), "plant_id long, plant_name string", fmt="csv")
    assert again.count() == 5 and dict(again.dtypes)["plant_id"] == "bigint"


def test_csv_scan_binds_columns_by_name(spark, tmp_path):
    path = tmp_path / "log.csv"
    path.write_text("generation_amount,extra,plant_id\n\"1,000\",x,900001\n")
    row = tables.read_table(spark, str(path), "plant_id long, generation_date string, generation_amount string").first()
    assert (row.plant_id, row.generation_amount) == (A, "1,000")
    assert tables.optional_table(spark, str(path), tables.SCHEMAS["generation_log"], ["generation_date"]) is None
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, str(tmp_path / "none.csv"), "a long")


def test_materialized_tables_live_in_the_named_folder(spark):
    df = intermediate.materialize(spark.range(10).withColumn("p", F.col("id") % 2), "numbers", ["p"])
    assert df.columns == ["id", "p"] and df.count() == 10
    assert intermediate.shared_folder(spark) in df.inputFiles()[0]


def test_missing_and_unavailable_sources_are_not_promoted(spark, fleet):
    """All five sources are listed for every plant; a weak model source promotes only meters that are there."""
    from heliospark import config
    from heliospark.operators import completeness
    plants = [r.plant_id for r in fleet.select("plant_id").orderBy("plant_id").collect()]
    log = spark.createDataFrame([(plants[0], "2024-01-01 00:00:00"), (plants[0], "2024-01-01 05:00:00")], "plant_id long, generation_date string")
    meter = spark.createDataFrame([(plants[0], "2024-01-01 00:00:00"), (plants[1], "not a time")], "plant_id long, date string")
    as_of = F.expr("TIMESTAMP_NTZ'2024-01-03 00:00:00'")
    got = {(r.plant_id, r.source): r for r in completeness.source_status(
        {config.FIVE_MIN: log, config.HOURLY_METER: meter, config.DAILY_INVERTER: log.drop("generation_date"), config.BILLING_METER: None}, fleet, as_of).collect()}
    assert len(got) == 5 * len(plants)
    first = {s: got[plants[0], s] for s in completeness.CATALOGUE}
    assert {s: r.status for s, r in first.items()} == {
        config.FIVE_MIN: "Available", config.HOURLY_INVERTER: "Missing file", config.DAILY_INVERTER: "Unavailable: required columns not found",
        config.HOURLY_METER: "Available", config.BILLING_METER: "Missing file"}
    assert first[config.FIVE_MIN].role == "Primary model source (partial)" and first[config.FIVE_MIN].expected_records == 61
    assert first[config.HOURLY_METER].role == "Fallback candidate + confirmation"
    assert first[config.BILLING_METER].role == "Aggregate meter check" and first[config.BILLING_METER].freshness == "Missing"
    second = got[plants[1], config.HOURLY_METER]
    assert (second.status, second.freshness, second.completeness_pct) == ("Unavailable: no rows for selected plant", "Unavailable", None)
    nothing = completeness.source_status({}, fleet, as_of).collect()
    assert len(nothing) == 5 * len(plants) and {r.status for r in nothing} == {"Missing file"}


def test_diagnosis_without_an_hourly_log(spark, fleet):
    plant = fleet.first().plant_id
    five = spark.createDataFrame([(plant, f"2024-01-01 00:{m:02d}:00", "12", m) for m in range(0, 60, 5)],
                                 "plant_id long, generation_date string, generation_amount string, ingest_seq long")
    row, = hourly.hourly_source_diagnostics(five, None, fleet).collect()
    assert (row.target_quality_flag, row.target_is_fallback, row.generation_kwh_hourly, row.hourly_records) == ("5min_primary", False, None, None)


def test_source_agreement_filter_does_not_parse_again(spark):
    """Weak days are a written table: no test for null dates reaches the scan of a log, where it would parse each text again."""
    fleet = spark.createDataFrame([(1, "One", None), (2, "Two", 5.0)], "plant_id long, plant_name string, max_ratio_difference double")
    logs = [spark.createDataFrame([(p, f"2024-01-{d:02d} 12:00:00", str(a * f)) for p in (1, 2) for d, a in ((1, 900_000), (2, 800_000)) for f in (fs[d - 1],)],
                                  "plant_id long, generation_date string, generation_amount string") for fs in ((1, 1), (1, 3))]
    parts = [daily.daily_log_rows(df, fleet, s, 1000.0) for df, s in zip(logs, (config.FIVE_MIN, config.DAILY_INVERTER))]
    empty = {s: F.lit(None).cast("double") for s in config.DAILY_SOURCES[1:] if s != config.DAILY_INVERTER}
    agreement = daily.daily_agreement(daily.align_daily_sources(parts, [config.FIVE_MIN, config.DAILY_INVERTER]).withColumns(empty), fleet)
    hours = spark.createDataFrame([(p, dt.datetime(2024, 1, d, 3)) for p in (1, 2) for d in (1, 2)] + [(1, None)], "plant_id long, generation_date timestamp_ntz")
    kept = daily.filter_source_agreement(hours, agreement, fleet)
    assert "regexp" not in kept._jdf.queryExecution().optimizedPlan().toString().lower()
    assert sorted((r.plant_id, r.generation_date.day if r.generation_date else 0) for r in kept.collect()) == [(1, 0), (1, 1), (2, 1), (2, 2)]
