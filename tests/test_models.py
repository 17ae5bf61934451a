"""Fleet models against plain computations: trees, boosting, ridge, tuning, scoring, saved runs."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from heliospark import config
from heliospark.models import fleet as fleets
from heliospark.models import linear, trees
from heliospark.sources import sinks

NAMES = ["a", "b", "c"]


def _data(n: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=n), rng.integers(0, 5, n), np.full(n, 3.0)])
    return x, 4 * (x[:, 0] > 0.3) + x[:, 1] + rng.normal(scale=0.1, size=n)


def _frame(spark, plants: int, n: int):
    parts = []
    for p in range(plants):
        x, y = _data(n, p)
        hours = [dt.datetime(2024, 1, 1) + dt.timedelta(hours=h) for h in range(n)]
        parts.append(pd.DataFrame({"plant_id": p, "generation_date": hours, "generation_kwh": y, **{c: x[:, i] for i, c in enumerate(NAMES)}}))
    df = spark.createDataFrame(pd.concat(parts), "plant_id long, generation_date timestamp_ntz, generation_kwh double, a double, b double, c double")
    return df.repartition(5)


def _plain_tree(bins, pull, weight, depth, min_split, min_leaf, penalty):
    """Leaf value of each row by the rules, one node at a time."""
    out = np.zeros(len(bins))

    def score(rows):
        return pull[rows].sum() ** 2 / max(weight[rows].sum() + penalty, 1e-300)

    def split(rows, at):
        best = None
        if at < depth and weight[rows].sum() >= max(min_split, 2 * min_leaf):
            for f in range(bins.shape[1]):
                for b in range(int(bins[rows, f].max())):
                    left = bins[rows, f] <= b
                    l, r = rows[left], rows[~left]
                    if min(weight[l].sum(), weight[r].sum()) < max(min_leaf, 1e-9):
                        continue
                    gain = score(l) + score(r) - score(rows)
                    if gain > 1e-10 + 1e-12 * score(rows) and (best is None or gain > best[0] + 1e-9):
                        best = gain, l, r
        if best is None:
            out[rows] = pull[rows].sum() / max(weight[rows].sum() + penalty, 1e-300)
        else:
            split(best[1], at + 1)
            split(best[2], at + 1)
    split(np.arange(len(bins)), 0)
    return out


@pytest.mark.parametrize("depth,min_split,min_leaf,penalty", [(20, 10, 5, 0.0), (7, 2, 1, 1.0), (2, 2, 1, 0.0), (0, 2, 1, 0.0)])
def test_grown_tree_equals_a_plain_one(depth, min_split, min_leaf, penalty):
    x, y = _data(150, 7)
    bins = trees.binned(x, [trees.edges_of(x[:, f]) for f in range(3)])
    weight = np.bincount(np.random.default_rng(1).integers(0, 150, 150), minlength=150).astype(float)
    tree, node, gains = trees.grow(bins, y, weight, range(3), depth, min_split, min_leaf, penalty)
    want = _plain_tree(bins, y * weight, weight, depth, min_split, min_leaf, penalty)
    led = weight > 0
    assert np.allclose(tree["value"][node][led], want[led])
    assert gains[2] == 0 and (gains.sum() > 0) == (depth > 0)


def test_histograms_in_parts_give_the_same_tree(monkeypatch):
    x, y = _data(400, 3)
    bins = trees.binned(x, [trees.edges_of(x[:, f]) for f in range(3)])
    whole = trees.grow(bins, y, np.ones(400), range(3), 12, 2, 1, 0.0)
    monkeypatch.setattr(trees, "NODES", 3)
    parts = trees.grow(bins, y, np.ones(400), range(3), 12, 2, 1, 0.0)
    assert all((whole[0][k] == parts[0][k]).all() for k in whole[0]) and (whole[1] == parts[1]).all()


@pytest.mark.parametrize("columns", [[0, 1, 2], [0, 2]])
def test_histograms_by_column_give_the_same_tree(monkeypatch, columns):
    """Many rows are summed column by column, few in one call: trees are equal to the last bit."""
    x, y = _data(400, 5)
    bins = trees.binned(x, [trees.edges_of(x[:, f]) for f in range(3)])
    weight = np.bincount(np.random.default_rng(2).integers(0, 400, 400), minlength=400).astype(float)
    found = []
    for few in (0, 1_000):
        monkeypatch.setattr(trees, "FEW", few)
        found.append(trees.grow(bins, y, weight, columns, 12, 2, 1, 1.0))
    (a, node_a, gains_a), (b, node_b, gains_b) = found
    assert len(a["feature"]) > 20 and all((a[k] == b[k]).all() for k in a) and (node_a == node_b).all() and (gains_a == gains_b).all()


def test_boosting_equals_a_plain_one():
    x, y = _data(120, 5)
    params = trees.settings("boosting", {"maxIter": 6, "maxDepth": 3})
    bins, now = trees.binned(x, [trees.edges_of(x[:, f]) for f in range(3)]), np.full(120, y.mean())
    for _ in range(6):
        now = now + 0.1 * _plain_tree(bins, y - now, np.ones(120), 3, 10, 1, 0.0)
    assert np.allclose(trees.walk(x, trees.fit_plant("boosting", x, y, 1, params)), now)


def test_subsampled_boosting_draws_rows_and_features():
    x, y = _data(200, 6)
    params = trees.settings("subsampled_boosting", {"maxIter": 30})
    model = trees.fit_plant("subsampled_boosting", x, y, 1, params)
    assert model == trees.fit_plant("subsampled_boosting", x, y, 1, params)
    assert model["value"] != trees.fit_plant("subsampled_boosting", x, y, 2, params)["value"]
    assert np.abs(trees.walk(x, model) - y).mean() < 0.25 * np.abs(y - y.mean()).mean()


def test_many_plants_train_in_one_job_and_score(spark):
    """Sixty plants; models and predictions equal those fitted one by one, and a plant without rows fails alone."""
    df = _frame(spark, 60, 60)
    broken = df.where("plant_id = 3").withColumns({"plant_id": F.lit(900).cast("long"), "a": F.lit(None).cast("double")})
    kinds = {"forest": {"numTrees": 30}, "boosting": {"maxIter": 5}}
    models = trees.fit_fleet_trees(df.unionByName(broken), NAMES, kinds).cache()
    assert models.where("error IS NOT NULL").select("plant_id").distinct().collect() == [(900,)]
    assert models.where("error IS NULL").count() == 60 * 3
    scored = trees.score_models(df.unionByName(broken), models, NAMES).toPandas()
    assert len(scored) == 60 * 60 * 2 + 60
    assert scored[scored.plant_id == 900].prediction.isna().all()
    for plant in (0, 17, 59):
        x, y = _data(60, plant)
        for kind, params in kinds.items():
            used = trees.settings(kind, params)
            want = sum(trees.walk(x, trees.fit_plant(kind, x, y, plant, used, b)) for b in range(2 if kind == "forest" else 1))
            got = scored[(scored.plant_id == plant) & (scored.kind == kind)].sort_values("generation_date").prediction.to_numpy(float)
            assert np.allclose(got, want)
    ranked = trees.tree_importances(models, NAMES).where("plant_id = 5 AND kind = 'forest'").orderBy("rank").collect()
    assert abs(sum(r.importance for r in ranked) - 1) < 1e-9 and ranked[-1].feature == "c"
    models.unpersist()


def test_fleet_ridge_equals_direct_solves_on_badly_scaled_features(spark):
    """Visibility in the thousands beside sines, a constant, and rows with holes."""
    rng = np.random.default_rng(9)
    rows, want = [], {}
    for plant in range(3):
        x = np.column_stack([rng.normal(9000, 600, 80), np.sin(rng.normal(size=80)), np.full(80, 7.0), rng.normal(size=80) * 1e-3])
        y = x @ [1e-3, 2.0, 5.0, 100.0] + rng.normal(size=80)
        centred, level = x - x.mean(0), y - y.mean()
        w = np.linalg.solve(centred.T @ centred + 100 * np.eye(4), centred.T @ level)
        want[plant] = (*w, y.mean() - x.mean(0) @ w)
        rows += [(plant, float(v), *map(float, r)) for v, r in zip(y, x)] + [(plant, 1.0, None, 1.0, 7.0, 1.0)]
    df = spark.createDataFrame(rows, "plant_id long, generation_kwh double, p double, q double, r double, s double").repartition(7)
    for got in linear.fit_fleet_ridge(df, ["p", "q", "r", "s"]).collect():
        assert got.n == 80 and got.coefficients[2] == 0
        assert np.allclose([*got.coefficients, got.intercept], want[got.plant_id], rtol=1e-9, atol=1e-12)


def test_fleet_run_ranks_saves_and_scores_again(spark, tmp_path):
    df = _frame(spark, 3, 120)
    plants = spark.createDataFrame([(p, dt.date(2024, 1, 4), True) for p in range(3)], "plant_id long, split_date date, reliable boolean")
    run = fleets.train_fleet_tables(df, plants, NAMES, params={"forest": {"numTrees": 30}, "boosting": {"maxIter": 20}, "subsampled_boosting": {"maxIter": 20}}, min_test=10)
    assert run.failures.count() == 0
    metrics = run.comparison.toPandas()
    assert len(metrics) == 12 and set(metrics.model) == set(config.MODEL_LABELS.values())
    best = fleets.best_of_fleet(run)
    winners = metrics.sort_values("r2", ascending=False).groupby("plant_id").first().model
    kinds = {r.plant_id: config.MODEL_LABELS[r.kind] for r in best.collect()}
    assert kinds == winners.to_dict()
    sinks.save_fleet(run.models, run.comparison, str(tmp_path / "run"), plants, NAMES)
    again = trees.score_models(df, sinks.load_fleet(spark, str(tmp_path / "run")), sinks.load_features(spark, str(tmp_path / "run")))
    now = trees.score_models(df, run.models, NAMES)
    assert again.exceptAll(now).count() == 0 and again.count() == 120 * 3 * 4


def test_searches_equal_fits_fold_by_fold(spark):
    from heliospark.operators.splits import time_series_folds
    folded = time_series_folds(_frame(spark, 2, 80)).cache()
    trials = [{"numTrees": 30, "maxDepth": 4}, {"numTrees": 10, "minInstancesToSplit": 40}]
    got = {(r.plant_id, r.trial): r.mae for r in trees.tune_fleet_trees(folded, NAMES, "forest", trials).collect()}
    alphas = {(r.plant_id, r.alpha): r.mae for r in linear.tune_fleet_ridge(folded, NAMES, [1.0, 100.0]).collect()}
    for plant in range(2):
        x, y = _data(80, plant)
        for number, params in enumerate(trials):
            used, errors = trees.settings("forest", params), []
            for k in (20, 40, 60):
                guess = sum(trees.walk(x[k:k + 20], trees.fit_plant("forest", x[:k], y[:k], plant, used, b)) for b in range(2 if number == 0 else 1))
                errors.append(np.abs(guess - y[k:k + 20]).mean())
            assert abs(got[plant, number] - np.mean(errors)) < 1e-9
        for alpha in (1.0, 100.0):
            errors = []
            for k in (20, 40, 60):
                centred = x[:k] - x[:k].mean(0)
                w = np.linalg.solve(centred.T @ centred + alpha * np.eye(3), centred.T @ (y[:k] - y[:k].mean()))
                errors.append(np.abs(y[:k].mean() + (x[k:k + 20] - x[:k].mean(0)) @ w - y[k:k + 20]).mean())
            assert abs(alphas[plant, alpha] - np.mean(errors)) < 1e-9
    folded.unpersist()
