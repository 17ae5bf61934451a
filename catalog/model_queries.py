"""Features, splits, models, scoring."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.bindings import Fixture
from catalog.oracle_tables import CONFIGURED, POSITION_SQL, RIDGE_SUM
from catalog.registry import query
from heliospark import config
from heliospark.functions import labels
from heliospark.models import ensembles, evaluation, fleet, linear, trees
from heliospark.operators import completeness, features, splits
from heliospark.plans import dashboard, training
from heliospark.sources import sinks
from heliospark.sources.intermediate import materialize, shared_folder

_WEATHER = "temp visibility rain_1h clouds_all"


def merged(x: Fixture) -> DataFrame:
    weather = x.weather.select(*training.WEATHER_INPUTS)
    return features.merge_weather(x.hourly.select("plant_id", "plant_name", "generation_date", "generation_kwh"), weather)


def training_features(x: Fixture) -> DataFrame:
    return training.training_frame(_targets(x), x.weather, x.agreement, x.fleet)


def _targets(x: Fixture) -> DataFrame:
    return x.hourly.select("plant_id", "plant_name", "generation_date", "generation_kwh")


def training_rows(x: Fixture) -> DataFrame:
    """Both sides of the split, filled, written once."""
    return materialize(fleet.training_rows(training_features(x), x.fleet, config.ALL_FEATURES), "training-rows")


def ridge_coefficients(x: Fixture) -> DataFrame:
    """The ridge of every plant on its train side, over all features, written as a run leaves it for scoring."""
    rows = fleet.training_rows(training_features(x), x.fleet, config.ALL_FEATURES)
    return materialize(linear.fit_fleet_ridge(rows.where("split = 'train'"), config.ALL_FEATURES), "ridge-coefficients")


@query("merge_weather", "J2 W6", f"SELECT plant_id, generation_date, generation_kwh, {_WEATHER.replace(' ', ', ')} FROM merged",
       f"generation_kwh {_WEATHER}")
def merge_weather(x: Fixture):
    return merged(x).drop("plant_name")


@query("temporal_features", "F4", """
SELECT plant_id, generation_date, hour, day_of_year, month, day_of_week, hour_sin, hour_cos, day_sin, day_cos FROM feat""",
       "hour_sin hour_cos day_sin day_cos")
def temporal_features(x: Fixture):
    return features.add_temporal(x.hourly.select("plant_id", "generation_date"))


@query("weather_features", "F5", """
SELECT plant_id, generation_date, cloud_impact, has_rain, temp_squared, effective_irradiance, elevation_x_cloud FROM feat""",
       "cloud_impact temp_squared effective_irradiance elevation_x_cloud")
def weather_features(x: Fixture):
    df = features.add_weather_features(features.add_solar(merged(x), x.fleet))
    return df.select("plant_id", "generation_date", "cloud_impact", "has_rain", "temp_squared", "effective_irradiance", "elevation_x_cloud")


@query("weather_features_unknown_clouds", "F5", """
SELECT generation_date, 1 - clouds / 100 AS cloud_impact, CASE WHEN rain > 0 THEN 1 ELSE 0 END AS has_rain FROM (
  SELECT generation_date, CASE WHEN clouds_all <= 60 THEN clouds_all END AS clouds, CASE WHEN rain_1h > 0 THEN rain_1h END AS rain FROM weather)""",
       "cloud_impact")
def weather_features_unknown(x: Fixture):
    df = x.weather.select("generation_date", "temp", F.expr("IF(clouds_all <= 60, clouds_all, NULL)").alias("clouds_all"),
                          F.expr("IF(rain_1h > 0, rain_1h, NULL)").alias("rain_1h"), F.lit(1.0).alias("ghi"), F.lit(1.0).alias("elevation"))
    return features.add_weather_features(df).select("generation_date", "cloud_impact", "has_rain")


@query("lag_features", "W1", "SELECT plant_id, generation_date, production_lag_24h, production_lag_168h FROM feat",
       "production_lag_24h production_lag_168h")
def lag_features(x: Fixture):
    return features.add_lags(x.hourly).select("plant_id", "generation_date", "production_lag_24h", "production_lag_168h")


@query("lag_features_by_time", "W1", """
SELECT h.plant_id, h.generation_date, a.generation_kwh AS production_lag_24h, b.generation_kwh AS production_lag_168h
FROM (SELECT * FROM feat_day) h LEFT JOIN feat_day a ON a.plant_id = h.plant_id AND a.generation_date = h.generation_date - INTERVAL '24 hours'
LEFT JOIN feat_day b ON b.plant_id = h.plant_id AND b.generation_date = h.generation_date - INTERVAL '168 hours'""",
       "production_lag_24h production_lag_168h")
def lag_features_by_time(x: Fixture):
    rows = features.build_features(merged(x), x.fleet).select("plant_id", "generation_date", "generation_kwh")
    return features.add_lags(rows, time_aligned=True).drop("generation_kwh")


@query("rolling_features", "W2", "SELECT plant_id, generation_date, production_7d_mean, temp_7d_mean FROM feat",
       "production_7d_mean temp_7d_mean")
def rolling_features(x: Fixture):
    return features.add_rolling(merged(x)).select("plant_id", "generation_date", "production_7d_mean", "temp_7d_mean")


@query("rolling_features_past_only", "W2", """
SELECT plant_id, generation_date, CASE WHEN count(generation_kwh) OVER w >= 24 THEN avg(generation_kwh) OVER w END AS production_7d_mean FROM hourly
WINDOW w AS (PARTITION BY plant_id ORDER BY generation_date ROWS BETWEEN 168 PRECEDING AND 1 PRECEDING)""", "production_7d_mean")
def rolling_features_past(x: Fixture):
    df = x.hourly.withColumn("temp", F.lit(1.0))
    return features.add_rolling(df, exclude_current=True).select("plant_id", "generation_date", "production_7d_mean")


_FILL = "last_value({0} IGNORE NULLS) OVER (PARTITION BY plant_id ORDER BY generation_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), " \
        "first_value({0} IGNORE NULLS) OVER (PARTITION BY plant_id ORDER BY generation_date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0"


@query("impute_features", "W8", f"""
SELECT plant_id, generation_date, coalesce({_FILL.format('generation_kwh')}) AS generation_kwh, coalesce({_FILL.format('production_lag_168h')}) AS production_lag_168h
FROM feat""", "generation_kwh production_lag_168h")
def impute_features(x: Fixture):
    df = features.add_lags(x.hourly).select("plant_id", "generation_date", "generation_kwh", "production_lag_168h")
    return features.impute_features(df, ["generation_kwh", "production_lag_168h"])


@query("filter_daytime", "P5", "SELECT plant_id, generation_date FROM hourly_sun WHERE elevation > 5")
def filter_daytime(x: Fixture):
    from heliospark.functions.solar import with_solar_position
    return features.filter_daytime(with_solar_position(x.hourly)).select("plant_id", "generation_date")


@query("filter_daytime_by_clock", "P7", "SELECT plant_id, generation_date FROM hourly WHERE hour(generation_date) BETWEEN 6 AND 18")
def filter_daytime_by_clock(x: Fixture):
    return features.filter_daytime(x.hourly).select("plant_id", "generation_date")


@query("drop_null_target", "P9", "SELECT plant_id, generation_date, generation_kwh FROM hourly WHERE generation_kwh IS NOT NULL", "generation_kwh")
def drop_null_target(x: Fixture):
    return features.drop_null_target(x.hourly).select("plant_id", "generation_date", "generation_kwh")


_DOUBLE_FEATURES = [c for c in config.ALL_FEATURES if c not in ("hour", "month", "day_of_week", "day_of_year", "has_rain")]


@query("build_features", "M1 P8 U3", f"""
SELECT plant_id, generation_date, generation_kwh, clearsky_expected_kwh, {', '.join(config.ALL_FEATURES)} FROM feat_day""",
       "generation_kwh clearsky_expected_kwh " + " ".join(_DOUBLE_FEATURES))
def build_features(x: Fixture):
    df = features.build_features(merged(x), x.fleet)
    return df.select("plant_id", "generation_date", "generation_kwh", "clearsky_expected_kwh", *features.feature_columns(df))


@query("training_frame", "M7 J6", f"SELECT plant_id, generation_date, generation_kwh, {', '.join(config.ALL_FEATURES)} FROM tfeat_day",
       "generation_kwh " + " ".join(_DOUBLE_FEATURES))
def training_frame(x: Fixture):
    return training_features(x).select("plant_id", "generation_date", "generation_kwh", *config.ALL_FEATURES)


@query("split_configured", "W13", POSITION_SQL.format(
    min_test=500, wanted=CONFIGURED, source="feat_day"))
def split_configured(x: Fixture):
    """Configured dates leave no test rows here, so every plant is cut by position."""
    rows = features.build_features(merged(x), x.fleet).select("plant_id", "generation_date")
    return splits.split_train_test(rows, x.fleet)


@query("split_explicit_date", "W13", POSITION_SQL.format(min_test=50, wanted="TIMESTAMP '2024-01-20'", source="hourly"))
def split_explicit_date(x: Fixture):
    return splits.split_train_test(x.hourly.select("plant_id", "generation_date"), split_date=dt.date(2024, 1, 20), min_test=50)


_DAYS = "(SELECT DISTINCT plant_id, CAST(CAST(generation_date AS DATE) AS TIMESTAMP) AS generation_date FROM history)"


def _days(x: Fixture) -> DataFrame:
    day = F.col("generation_date").cast("date").cast("timestamp_ntz")
    return x.history.select("plant_id", day.alias("generation_date")).distinct()


@query("split_relative", "W13", POSITION_SQL.format(
    min_test=50, wanted="max(generation_date) OVER (PARTITION BY plant_id) - INTERVAL '3 months'", source=_DAYS))
def split_relative(x: Fixture):
    return splits.split_train_test(_days(x), min_test=50)


@query("time_series_folds", "W14", f"""
SELECT plant_id, generation_date, CAST(CASE WHEN rn > n - size THEN 3 WHEN rn > n - 2 * size THEN 2 WHEN rn > n - 3 * size THEN 1 ELSE 0 END AS INTEGER) AS fold
FROM (SELECT *, n // 4 AS size FROM (SELECT *, count(*) OVER (PARTITION BY plant_id) AS n, row_number() OVER (PARTITION BY plant_id ORDER BY generation_date) AS rn FROM {_DAYS}))""")
def time_series_folds(x: Fixture):
    return splits.time_series_folds(_days(x))


_COEFFICIENTS_SQL = " UNION ALL ".join(
    f"SELECT plant_id, n, intercept, '{c}' AS feature, w[{i + 1}] AS coefficient FROM ridge_fit" for i, c in enumerate(config.ALL_FEATURES))


@query("fleet_ridge", "M2 M7", _COEFFICIENTS_SQL, "intercept coefficient")
def fleet_ridge(x: Fixture):
    """All features of every plant; the twin solves the normal equations by elimination."""
    pairs = F.arrays_zip(F.array(*map(F.lit, config.ALL_FEATURES)).alias("feature"), F.col("coefficients").alias("coefficient"))
    return ridge_coefficients(x).select("plant_id", "n", "intercept", F.inline(pairs))


@query("ridge_single_fit", "M2", """
SELECT w AS coefficient, my - w * mx AS intercept FROM (SELECT covar_pop(clearsky_expected_kwh, generation_kwh) * n / (var_pop(clearsky_expected_kwh) * n + 100) AS w, mx, my FROM (
  SELECT clearsky_expected_kwh, generation_kwh, count(*) OVER () AS n, avg(clearsky_expected_kwh) OVER () AS mx, avg(generation_kwh) OVER () AS my
  FROM history WHERE generation_kwh IS NOT NULL) GROUP BY n, mx, my)""", "coefficient intercept")
def ridge_single_fit(x: Fixture):
    rows = x.history.where("generation_kwh IS NOT NULL")
    model = ensembles.fit(rows, "ridge", ["clearsky_expected_kwh"]).stages[-1]
    return x.spark.createDataFrame([(float(model.coefficients[0]), float(model.intercept))], "coefficient double, intercept double")


@query("fleet_ridge_all_features", "M2 M7 M15")
def fleet_ridge_all_features(x: Fixture):
    rows = fleet.training_rows(training_features(x), x.fleet, config.ALL_FEATURES)
    fitted = linear.fit_fleet_ridge(rows.where("split = 'train'"), config.ALL_FEATURES)
    return linear.ranked_coefficients(fitted, config.ALL_FEATURES)


@query("ranked_coefficients", "M15 L4", f"""
SELECT plant_id, feature, coefficient, abs(coefficient) AS abs_coefficient, CAST(row_number() OVER (PARTITION BY plant_id ORDER BY abs(coefficient) DESC, feature) AS INTEGER) AS rank
FROM ({_COEFFICIENTS_SQL})""", "coefficient abs_coefficient")
def ranked_coefficients(x: Fixture):
    return linear.ranked_coefficients(ridge_coefficients(x), config.ALL_FEATURES)


def _scored_sql(lacking: str) -> str:
    return f"""
SELECT f.plant_id, f.generation_date, f.generation_kwh, round(greatest(0, {RIDGE_SUM}), 3) AS ml_predicted_kwh
FROM score_rows f JOIN ridge_fit r ON r.plant_id = f.plant_id WHERE f.plant_id NOT IN ({lacking})
UNION ALL SELECT plant_id, generation_date, generation_kwh, round(generation_kwh, 3) FROM hourly WHERE plant_id IN ({lacking})"""


def _shown(scored: DataFrame) -> DataFrame:
    """Predictions to three digits, which both solvers agree on."""
    return scored.select("plant_id", "generation_date", "generation_kwh", F.round("ml_predicted_kwh", 3).alias("ml_predicted_kwh"))


_UNTRAINED = "SELECT plant_id FROM hourly EXCEPT SELECT plant_id FROM ridge_fit"


def scored_history(x: Fixture) -> DataFrame:
    x = x.with_clean_tables()
    return dashboard.score_history(_targets(x), x.weather, x.fleet, ridge_coefficients(x), config.ALL_FEATURES)


@query("score_history", "M11 F13", _scored_sql(_UNTRAINED), "generation_kwh ml_predicted_kwh")
def score_history(x: Fixture):
    return _shown(scored_history(x))


@query("score_history_without_model", "M11", "SELECT plant_id, generation_date, generation_kwh AS ml_predicted_kwh FROM hourly", "ml_predicted_kwh")
def score_without_model(x: Fixture):
    return dashboard.score_history(x.hourly, x.weather, x.fleet).select("plant_id", "generation_date", "ml_predicted_kwh")


@query("score_history_missing_models", "M11", _scored_sql("900002, 900004"), "generation_kwh ml_predicted_kwh")
def score_history_missing_models(x: Fixture):
    """Two plants have no model yet: all their hours stay, with the actual value."""
    x = x.with_clean_tables()
    fitted = ridge_coefficients(x).where("plant_id NOT IN (900002, 900004)")
    return _shown(dashboard.score_history(_targets(x), x.weather, x.fleet, fitted, config.ALL_FEATURES))


_PREDICTIONS_SQL = """
SELECT plant_id, 'level' AS model, CASE WHEN generation_date < TIMESTAMP '1999-01-01' THEN 'train' ELSE 'test' END AS split, generation_kwh AS y, ml_predicted_kwh AS p FROM history
UNION ALL SELECT plant_id, 'sky', CASE WHEN generation_date < TIMESTAMP '1999-01-01' THEN 'train' ELSE 'test' END, generation_kwh, clearsky_expected_kwh FROM history"""
_METRICS_SQL = f"""
SELECT plant_id, model, split, count(y - p) AS n, avg(abs(y - p)) AS mae, sqrt(avg((y - p) * (y - p))) AS rmse,
  1 - sum((y - p) * (y - p)) / nullif(var_pop(y) * count(y - p), 0) AS r2, sum(abs(y - p)) / nullif(sum(abs(y)), 0) * 100 AS wape
FROM ({_PREDICTIONS_SQL}) WHERE y IS NOT NULL AND p IS NOT NULL GROUP BY 1, 2, 3"""


def metrics(x: Fixture) -> DataFrame:
    long = x.history.selectExpr(
        "plant_id", "IF(generation_date < TIMESTAMP_NTZ'1999-01-01', 'train', 'test') AS split", "generation_kwh",
        "stack(2, 'level', ml_predicted_kwh, 'sky', clearsky_expected_kwh) AS (model, prediction)")
    return evaluation.regression_metrics(long)


@query("regression_metrics", "M8", _METRICS_SQL, "mae rmse r2 wape")
def regression_metrics(x: Fixture):
    return metrics(x)


_RANK_SQL = f"SELECT *, CAST(row_number() OVER (PARTITION BY plant_id ORDER BY r2 DESC NULLS LAST, model) AS INTEGER) AS rank FROM ({_METRICS_SQL}) WHERE split = 'test'"


@query("rank_models", "M9", _RANK_SQL, "mae rmse r2 wape")
def rank_models(x: Fixture):
    return evaluation.rank_models(metrics(x).where("split = 'test'"))


_FLEET_MODELS_SQL = f"""
SELECT f.plant_id, f.plant_name, mae, rmse, r2, wape, coalesce(model, 'n/a') AS best_model,
  CASE WHEN r2 IS NULL AND wape IS NULL THEN 'Unknown' WHEN r2 < 0 OR wape > 70 THEN 'Review' ELSE 'Usable' END AS reliability
FROM fleet f LEFT JOIN (SELECT * FROM ({_RANK_SQL}) WHERE rank = 1 AND plant_id <> 900004) b ON b.plant_id = f.plant_id"""


def fleet_models(x: Fixture) -> DataFrame:
    """One plant has no registry rows yet."""
    return evaluation.fleet_model_summary(x.fleet, metrics(x).where("split = 'test' AND plant_id <> 900004"))


@query("fleet_model_summary", "M10 F11", _FLEET_MODELS_SQL, "mae rmse r2 wape")
def fleet_model_summary(x: Fixture):
    return fleet_models(x)


@query("compare_runs", "J9", f"""
WITH a AS (SELECT plant_id, model, r2, wape, mae FROM ({_RANK_SQL}) WHERE rank = 1),
b AS (SELECT plant_id, model, r2, wape, mae FROM (SELECT *, row_number() OVER (PARTITION BY plant_id ORDER BY r2 DESC NULLS LAST, model) AS rank FROM ({_METRICS_SQL})
  WHERE split = 'train' AND plant_id <> 900002) WHERE rank = 1)
SELECT a.plant_id, b.model AS before_best_model, b.r2 AS before_r2, b.wape AS before_wape, b.mae AS before_mae, a.model AS after_best_model, a.r2 AS after_r2,
  a.wape AS after_wape, a.mae AS after_mae, a.r2 - b.r2 AS r2_delta, a.wape - b.wape AS wape_delta FROM b RIGHT JOIN a ON a.plant_id = b.plant_id""",
       "before_r2 before_wape before_mae after_r2 after_wape after_mae r2_delta wape_delta")
def compare_runs(x: Fixture):
    """Train-side metrics stand for the earlier run, in which one plant is missing."""
    m = metrics(x)
    return evaluation.compare_runs(m.where("split = 'train' AND plant_id <> 900002"), m.where("split = 'test'"))


@query("fleet_summary", "J8", f"""
SELECT o.plant_id, o.plant_name, band AS data_quality_band, availability_pct AS usable_daylight_pct, warnings, best_model, r2, wape, reliability
FROM overview o LEFT JOIN ({_FLEET_MODELS_SQL}) m ON m.plant_id = o.plant_id""", "usable_daylight_pct r2 wape")
def fleet_summary(x: Fixture):
    from catalog.quality_queries import overview
    return completeness.fleet_summary(overview(x), fleet_models(x))


@query("plant_quality_issues", "M16 A7", f"""
SELECT coalesce(a.plant_id, m.plant_id) AS plant_id, availability_pct, available_hours, total_hours, r2, wape, concat_ws(' | ',
  CASE WHEN availability_pct < 60 THEN 'Only ' || printf('%.1f', availability_pct) || '% of daylight/modeling hours have enough 5-minute records.' END,
  CASE WHEN r2 < 0 THEN 'Model test R² is ' || printf('%.3f', r2) || ', worse than a simple mean baseline.' END,
  CASE WHEN wape > 70 THEN 'Model WAPE is high at ' || printf('%.1f', wape) || '%.' END) AS issues
FROM availability a FULL JOIN ({_FLEET_MODELS_SQL}) m ON m.plant_id = a.plant_id""", "availability_pct r2 wape")
def plant_quality_issues(x: Fixture):
    sky_only = evaluation.fleet_model_summary(x.fleet, metrics(x).where("split = 'test' AND plant_id <> 900004"))
    df = completeness.plant_quality_issues(completeness.daylight_availability(x.hourly), sky_only)
    return df.withColumn("issues", F.concat_ws(" | ", "issues"))


@query("reliability_flags", "F11", f"""
SELECT plant_id, model, split, CASE WHEN r2 IS NULL AND wape IS NULL THEN 'Unknown' WHEN r2 < 0 OR wape > 70 THEN 'Review' ELSE 'Usable' END AS reliability
FROM ({_METRICS_SQL})""")
def reliability_flags(x: Fixture):
    return metrics(x).select("plant_id", "model", "split", labels.reliability(F.col("r2"), F.col("wape")).alias("reliability"))


@query("residual_anomalies", "M13", """
SELECT h.plant_id, generation_date, residual, threshold FROM (SELECT *, generation_kwh - ml_predicted_kwh AS residual FROM history) h
JOIN (SELECT plant_id, stddev_samp(generation_kwh - ml_predicted_kwh) * 2 AS threshold FROM history GROUP BY 1) t ON t.plant_id = h.plant_id
WHERE residual < -threshold""", "residual threshold")
def residual_anomalies(x: Fixture):
    return evaluation.residual_anomalies(x.history).select("plant_id", "generation_date", "residual", "threshold")


def _saved(x: Fixture) -> str:
    """A folder with the ridge models of the fleet and the registry of their metrics, as a run leaves them."""
    folder = f"{shared_folder(x.spark)}/run-{uuid.uuid4().hex}"
    sinks.save_fleet(trees.ridge_models(ridge_coefficients(x)), metrics(x).where("split = 'test'"), folder, x.fleet, config.ALL_FEATURES)
    return folder


@query("registry_round_trip", "S7", f"SELECT * FROM ({_METRICS_SQL}) WHERE split = 'test'", "mae rmse r2 wape")
def registry_round_trip(x: Fixture):
    """Metrics of a run as saved in and read back from its registry."""
    return sinks.load_registry(x.spark, _saved(x))


@query("score_saved_run", "S7 M11", _scored_sql(_UNTRAINED), "generation_kwh ml_predicted_kwh")
def score_saved_run(x: Fixture):
    """History scored by the models and feature list that a saved run holds."""
    x = x.with_clean_tables()
    folder = _saved(x)
    return _shown(dashboard.score_history(_targets(x), x.weather, x.fleet, columns=sinks.load_features(x.spark, folder),
                                          fleet_models=sinks.load_fleet(x.spark, folder)))


def trained(x: Fixture, *kinds: str) -> fleet.FleetTables:
    """Every plant with the library's full settings."""
    return fleet.train_fleet_tables(training_features(x), x.fleet, config.ALL_FEATURES, kinds or fleet.ALL_MODELS)


def _tree_metrics(x: Fixture, kind: str) -> DataFrame:
    return trained(x, kind).metrics.drop("training_time")


@query("random_forest", "M3")
def random_forest(x: Fixture):
    return _tree_metrics(x, "forest")


@query("gradient_boosting", "M4")
def gradient_boosting(x: Fixture):
    return _tree_metrics(x, "boosting")


@query("subsampled_boosting", "M5")
def subsampled_boosting(x: Fixture):
    return _tree_metrics(x, "subsampled_boosting")


@query("tree_importances", "M15 L4")
def tree_importances(x: Fixture):
    return trees.tree_importances(trained(x, "forest", "boosting", "subsampled_boosting").models, config.ALL_FEATURES)


def folded_rows(x: Fixture) -> DataFrame:
    """Train sides with the fold that tests each row."""
    rows = fleet.training_rows(training_features(x), x.fleet, config.ALL_FEATURES).where("split = 'train'").drop("split")
    return materialize(splits.time_series_folds(rows), "folds")


@query("tune_ridge", "M6 W14", f"""
SELECT plant_id, alpha, mae, CAST(row_number() OVER (PARTITION BY plant_id ORDER BY mae, alpha) AS INTEGER) AS rank FROM (
  SELECT plant_id, alpha, round(avg(error), 4) AS mae FROM (
    SELECT f.plant_id, alpha, f.fold, avg(abs(generation_kwh - ({RIDGE_SUM}))) AS error
    FROM fold_rows f JOIN fold_fit r ON r.plant_id = f.plant_id AND r.test = f.fold GROUP BY 1, 2, 3) GROUP BY 1, 2)""", "alpha mae")
def tune_ridge(x: Fixture):
    """Every alpha of the grid for every plant, over three expanding folds."""
    return linear.tune_fleet_ridge(folded_rows(x), config.ALL_FEATURES, config.RIDGE_GRID["alpha"]).withColumn("mae", F.round("mae", 4))


def _searched(x: Fixture, grids: dict, n_iter: int) -> DataFrame:
    rows, found = folded_rows(x), []
    for kind in ("forest", "boosting", "subsampled_boosting"):
        trials = ensembles.grid_points(grids[kind], n_iter)
        named = F.element_at(F.array(*(F.lit(str(t)) for t in trials)), F.col("trial") + 1)
        found.append(trees.tune_fleet_trees(rows, config.ALL_FEATURES, kind, trials).select("plant_id", F.lit(kind).alias("kind"), named.alias("params"), "mae", "rank"))
    return found[0].unionByName(found[1]).unionByName(found[2])


@query("tune_trees_bounded", "M6 W14")
def tune_trees_bounded(x: Fixture):
    """Eight draws from the bounded grid of every tree kind, for every plant."""
    return _searched(x, config.BOUNDED_GRIDS, config.BOUNDED_SEARCH_ITERATIONS)


@query("tune_trees_wide", "M6 W14")
def tune_trees_wide(x: Fixture):
    """Twenty draws from the wide grid of every tree kind, for every plant."""
    return _searched(x, config.WIDE_GRIDS, config.WIDE_SEARCH_ITERATIONS)


@query("train_fleet", "M7 M8 M9 L4")
def train_fleet(x: Fixture):
    """All four kinds per plant at full size, ranked on the test side."""
    return evaluation.rank_models(trained(x).comparison).drop("training_time")


def best_fleet_models(x: Fixture) -> DataFrame:
    return materialize(fleet.best_of_fleet(trained(x)), "best-models")


def _scored_by(x: Fixture, models: DataFrame) -> DataFrame:
    scored = dashboard.score_history(_targets(x), x.weather, x.fleet, columns=config.ALL_FEATURES, fleet_models=models)
    return scored.select("plant_id", "generation_date", "generation_kwh", "ml_predicted_kwh")


@query("score_history_forest", "M11 M3")
def score_history_forest(x: Fixture):
    """History scored by every plant's forest."""
    x = x.with_clean_tables()
    return _scored_by(x, trained(x, "forest").models)


@query("score_history_best", "M11 M9")
def score_history_best(x: Fixture):
    """History scored by every plant's best model on its test side."""
    x = x.with_clean_tables()
    return _scored_by(x, best_fleet_models(x))
