"""Plans that must not exchange facts, and clean builds that break off."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from heliospark.models import evaluation
from heliospark.operators import features, kpi
from heliospark.sources import sinks


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def facts(spark, tmp_path_factory):
    """Hours of 40 plants as a written table."""
    path = str(tmp_path_factory.mktemp("facts") / "rows")
    rows = spark.range(40 * 200).selectExpr(
        "id % 40 AS plant_id", "TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, CAST(id / 40 AS INT)) AS generation_date",
        "CAST(id % 97 AS DOUBLE) AS generation_kwh", "CAST(id % 89 AS DOUBLE) AS ml_predicted_kwh")
    rows.write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("operator", [evaluation.residual_anomalies, lambda df: kpi.since_last(df, 2), kpi.latest_usable_day], ids=["residuals", "since_last", "usable_day"])
def test_a_value_per_plant_reaches_facts_without_an_exchange(facts, operator):
    plan = _plan(operator(facts))
    assert "hashpartitioning" not in plan and "BroadcastHashJoin" in plan


def test_time_aligned_lags_need_one_exchange_and_no_join(facts):
    out = features.add_lags(facts, time_aligned=True)
    plan = _plan(out)
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
    past = facts.select("plant_id", (F.col("generation_date") + F.expr("INTERVAL 24 HOURS")).alias("generation_date"), F.col("generation_kwh").alias("want"))
    assert out.join(past, ["plant_id", "generation_date"], "left").where("NOT production_lag_24h <=> want").count() == 0
    holes = facts.where("hour(generation_date) <> 5")
    assert features.add_lags(holes, time_aligned=True).where("hour(generation_date) = 5 OR production_lag_24h IS NOT NULL").count() == holes.where("generation_date >= '2024-01-02'").count()


def test_seasons_scan_facts_once(facts):
    out = kpi.seasonal(facts)
    assert _plan(out).count("FileScan") == 1
    assert out.where("plant_id = 7").count() == 4 and out.where("plant_id = 7 AND total_kwh IS NOT NULL").count() == 1


def test_a_build_that_breaks_off_leaves_the_one_before(spark, tmp_path):
    folder = str(tmp_path / "clean")
    assert sinks.read_version(spark, folder, "plants_clean") is None
    day = dt.datetime(2024, 1, 1)
    good = {"plants_clean": spark.createDataFrame([(1, "a")], "plant_id long, plant_name string"),
            "hourly_model_targets": spark.createDataFrame([(1, day, 2.0)], "plant_id long, generation_date timestamp_ntz, generation_kwh double")}
    sinks.write_version(good, folder)
    newer = {"plants_clean": good["plants_clean"].withColumn("plant_name", F.lit("b")),
             "hourly_model_targets": good["hourly_model_targets"].withColumn("generation_kwh", F.raise_error(F.lit("lost")).cast("double"))}
    with pytest.raises(Exception, match="lost"):
        sinks.write_version(newer, folder)
    assert sinks.read_version(spark, folder, "plants_clean").first().plant_name == "a"
    assert sinks.read_version(spark, folder, "hourly_model_targets").count() == 1
    sinks.write_version({"plants_clean": newer["plants_clean"]}, folder)
    assert sinks.read_version(spark, folder, "plants_clean").first().plant_name == "b"
    assert sinks.read_version(spark, folder, "hourly_model_targets") is None


def test_plants_with_other_last_days_get_their_own_outlook(spark):
    """Starts within, between, before and beyond the months of the weather; too few buckets after it mean a replay."""
    from heliospark.operators import outlook
    hours = [dt.datetime(2024, 1, 28) + dt.timedelta(hours=h) for h in range(24 * 8)] + [dt.datetime(2024, 4, 1) + dt.timedelta(hours=h) for h in range(24 * 6)]
    weather = spark.createDataFrame([(t, float(i), None if t.hour // 3 == 2 and t.month == 1 else 1.0, 1.0, 1.0, 1.0) for i, t in enumerate(hours)],
                                    "timestamp timestamp_ntz, temp double, pressure double, humidity double, clouds_all double, wind_speed double")
    last = {1: dt.datetime(2024, 1, 29, 17), 2: dt.datetime(2024, 2, 2, 3), 3: dt.datetime(2024, 3, 10), 4: dt.datetime(2024, 4, 6, 1), 5: dt.datetime(2023, 5, 1), 6: dt.datetime(2024, 4, 5, 1), 7: dt.datetime(2024, 1, 29, 2)}
    history = spark.createDataFrame([(p, t) for p, t in last.items()] + [(1, dt.datetime(2024, 1, 5))], "plant_id long, generation_date timestamp_ntz")
    got = outlook.outlook_for_plants(weather, history, F.expr("TIMESTAMP_NTZ'2024-02-01 00:00:00'")).collect()
    buckets = sorted({t.replace(hour=t.hour // 3 * 3) for t in hours if not (t.hour // 3 == 2 and t.month == 1)})
    for plant, t in last.items():
        start = dt.datetime(t.year, t.month, t.day) + dt.timedelta(days=1)
        ahead = [b for b in buckets if b >= start][:40]
        replay = len(ahead) < 8
        want = [b for b in buckets if b <= dt.datetime(2024, 2, 1)][-40:] if replay else ahead
        mine = sorted((r.generation_date, r.is_replay) for r in got if r.plant_id == plant)
        assert mine == [(b, replay) for b in want], plant
