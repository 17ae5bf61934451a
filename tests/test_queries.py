"""Registered queries against their SQL twins on the smallest fixture, and plan hygiene."""

import pytest

from catalog import REGISTRY
from compare import compare

HEAVY = {"random_forest", "gradient_boosting", "subsampled_boosting", "tree_importances", "train_fleet",
         "forecast_totals", "quality_cards_fallback", "score_bands", "clean_build_summary",
         "score_history_forest", "forecast_forest", "score_history_best", "forecast_best", "tune_trees_bounded", "tune_trees_wide"}
PYTHON_TASKS = {"fleet_ridge", "fleet_ridge_all_features", "ranked_coefficients", "score_history", "forecast_ridge"}


@pytest.mark.parametrize("name", [n for n in REGISTRY if n not in HEAVY])
def test_matches_sql(spark, duck, directory, name):
    verdict, _, _ = compare(spark, duck, REGISTRY[name], directory)
    assert verdict in ("ok", "rows only")


@pytest.mark.parametrize("name", ["hourly_targets", "daily_meter", "build_features", "audit", "daily_agreement"])
def test_plan_stays_in_the_jvm(spark, directory, name):
    plan = REGISTRY[name].run(spark, directory)._jdf.queryExecution().executedPlan().toString()
    for operator in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan


def test_columns_and_filters_reach_the_scan(spark, directory):
    plan = REGISTRY["daily_meter"].run(spark, directory)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_type,error)" in plan
    assert "props" not in plan.split("ReadSchema")[1]


def test_every_sql_text_is_complete():
    for item in REGISTRY.values():
        assert item.sql is None or "SELECT" in item.sql


@pytest.mark.parametrize("partitions", ["1", "64"])
@pytest.mark.parametrize("name", ["hourly_targets", "daily_meter", "timestamp_gaps"])
def test_result_does_not_depend_on_partitioning(spark, duck, directory, name, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert compare(spark, duck, REGISTRY[name], directory)[0] == "ok"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_result_does_not_depend_on_the_session_time_zone(spark, duck, directory):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for name in ("utc_to_local", "hourly_targets", "solar_position", "flatten_forecast"):
            assert compare(spark, duck, REGISTRY[name], directory)[0] == "ok"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
