"""Regression trees for a whole fleet: forests and boosted trees of every plant in one job, kept as tables.

Training rows are hourly, so one plant has 8,784 a year at most: fifty years of 24 features in one byte each are 10 MB. Work is
dealt by plant, kind and, for forests, block of trees, and a task holds one plant's binned rows. Trees grow level by level from
histograms of gradients and weights for each node, feature and bin. A model is rows of flattened nodes, not a driver object:
thousands of plants train, are saved, joined to their hours and scored without a loop on the driver.
"""

from __future__ import annotations

import time
import traceback
from collections.abc import Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliospark import config

BINS = 64
BLOCK = 25  # trees of a forest that one task grows
CHUNK = 5_000  # rows that walk through trees at once
NODES = 1_000  # nodes whose histograms are held at once
FEW = 200  # rows whose columns are summed in one call
_TINY = 1e-300

MODEL_SCHEMA = ("plant_id long, kind string, block int, trees int, n long, base double, coefficients array<double>, roots array<int>, feature array<int>, "
                "threshold array<double>, left array<int>, value array<double>, gains array<double>, seconds double, error string")
_MODEL_COLUMNS = [field.split(" ")[0] for field in MODEL_SCHEMA.split(", ")]


def settings(kind: str, params: dict[str, Any] | None = None) -> dict[str, Any]:
    """Configured settings of a kind of tree model, with parameters overriding them."""
    merged = {**config.FLEET_TREES[kind], **(params or {})}
    merged["trees"] = merged.pop("numTrees", None) or merged.pop("maxIter", None)
    merged.pop("maxIter", None)
    merged["columns"] = float(merged.pop("featureSubsetStrategy", 1.0))
    return merged


def edges_of(x: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Limits between bins: between all neighbouring values if these are few, else at quantiles."""
    values = np.unique(x)
    middles = (values[1:] + values[:-1]) / 2
    if len(values) <= bins:
        return middles
    return np.unique(np.quantile(x, np.arange(1, bins) / bins, method="higher"))


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.column_stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)]).astype(np.uint8, order="F")


def _histograms(bins, columns, rows, node, k, weight, pull):
    """Sums of weights and of gradients for each node, column and bin; rows are added in their order."""
    size, w, g = (k, len(columns), BINS), weight[rows], pull[rows]
    if len(rows) <= FEW:
        key = ((node[:, None] * len(columns) + np.arange(len(columns))) * BINS + bins[rows][:, columns]).ravel()
        return tuple(np.bincount(key, np.repeat(v, len(columns)), np.prod(size)).reshape(size) for v in (w, g))
    lw, lg, first = np.empty(size), np.empty(size), node * BINS
    for i, column in enumerate(columns):  # one column's sums fit the processor's caches
        key = first + bins[:, column][rows]
        lw[:, i], lg[:, i] = (np.bincount(key, v, k * BINS).reshape(k, BINS) for v in (w, g))
    return lw, lg


def _best_splits(bins, columns, rows, local, some, k, weight, pull, total_w, total_g, whole, min_leaf, penalty):
    """Feature (-1: none), bin and gain of the best split of some nodes, from one histogram over all their rows and columns.

    Gains are taken only at bins that hold rows of the node: an empty bin splits as the one before it does.
    """
    place = np.full(k, -1)
    place[some] = np.arange(len(some))
    mine = np.flatnonzero((place[local] >= 0) & (weight[rows] > 0))
    lw, lg = _histograms(bins, columns, rows[mine], place[local[mine]], len(some), weight, pull)
    full = np.flatnonzero(lw)
    lw, lg = lw.cumsum(2).ravel()[full], lg.cumsum(2).ravel()[full]
    of = full // (len(columns) * BINS)
    rw, rg = total_w[some][of] - lw, total_g[some][of] - lg
    least = max(min_leaf, 1e-9)
    gain = lg ** 2 / np.maximum(lw + penalty, _TINY) + rg ** 2 / np.maximum(rw + penalty, _TINY) - whole[some][of]
    gain = np.where((lw >= least) & (rw >= least), gain, -np.inf)
    first = np.searchsorted(of, np.arange(len(some)))  # a node that may split holds rows
    top = np.maximum.reduceat(gain, first)
    tops = np.flatnonzero(gain == top[of])
    at = full[tops[np.searchsorted(of[tops], np.arange(len(some)))]] % (len(columns) * BINS)
    good = top > 1e-10 + 1e-12 * whole[some]
    return np.where(good, columns[at // BINS], -1), at % BINS, np.where(good, top, 0.0)


def grow(bins: np.ndarray, gradient: np.ndarray, weight: np.ndarray, columns: Sequence[int], depth: int, min_split: float,
         min_leaf: float, penalty: float) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """One tree by histograms: flattened nodes, the node of each row, and the gain by feature.

    A node's value is gradient / (weight + penalty); a split gains what it adds to gradient^2 / (weight + penalty). Ties go
    to the first feature and the least bin. Rows of weight 0 are led through the tree without a say.
    """
    feature, split, left, value = [-1], [0], [0], [0.0]
    node, level, gains = np.zeros(len(bins), np.int64), np.array([0]), np.zeros(bins.shape[1])
    pull, columns = gradient * weight, np.asarray(columns)
    for at in range(depth + 1):
        k, place = len(level), np.full(len(feature), -1)
        place[level] = np.arange(k)
        rows = np.flatnonzero(place[node] >= 0)
        local = place[node[rows]]
        total_w, total_g = np.bincount(local, weight[rows], k), np.bincount(local, pull[rows], k)
        whole = total_g ** 2 / np.maximum(total_w + penalty, _TINY)
        for i, v in zip(level.tolist(), (total_g / np.maximum(total_w + penalty, _TINY)).tolist()):
            value[i] = v
        able = np.flatnonzero((total_w >= max(min_split, 2 * min_leaf)) & (at < depth))
        best_f, best_b, best = np.full(k, -1), np.zeros(k, np.int64), np.zeros(k)
        for some in (able[i:i + NODES] for i in range(0, len(able), NODES)):
            best_f[some], best_b[some], best[some] = _best_splits(bins, columns, rows, local, some, k, weight, pull, total_w, total_g, whole, min_leaf, penalty)
        chosen = np.flatnonzero(best_f >= 0)
        if not len(chosen):
            break
        np.add.at(gains, best_f[chosen], best[chosen])
        first = len(feature) + 2 * np.arange(len(chosen))
        for i, f, b, child in zip(level[chosen].tolist(), best_f[chosen].tolist(), best_b[chosen].tolist(), first.tolist()):
            feature[i], split[i], left[i] = f, b, child
        for column, empty in ((feature, -1), (split, 0), (left, 0), (value, 0.0)):
            column.extend([empty] * 2 * len(chosen))
        child = np.full(k, -1)
        child[chosen] = first
        moves = np.flatnonzero(child[local] >= 0)
        here = local[moves]
        node[rows[moves]] = child[here] + (bins[rows[moves], best_f[here]] > best_b[here])
        level = np.sort(np.concatenate([first, first + 1]))
    return {"feature": np.array(feature), "split": np.array(split), "left": np.array(left), "value": np.array(value)}, node, gains


def _limits(tree: dict[str, np.ndarray], edges: list[np.ndarray]) -> np.ndarray:
    return np.array([edges[f][b] if f >= 0 else 0.0 for f, b in zip(tree["feature"], tree["split"])])


def _flattened(trees: list[tuple[dict, np.ndarray]]) -> dict[str, list]:
    sizes = np.array([len(t["feature"]) for t, _ in trees])
    first = np.cumsum(sizes) - sizes
    return {"roots": first.tolist(), "feature": np.concatenate([t["feature"] for t, _ in trees]).tolist(),
            "threshold": np.concatenate([limits for _, limits in trees]).tolist(),
            "left": np.concatenate([t["left"] + (t["feature"] >= 0) * at for (t, _), at in zip(trees, first)]).tolist(),
            "value": np.concatenate([t["value"] for t, _ in trees]).tolist()}


def fit_plant(kind: str, x: np.ndarray, y: np.ndarray, plant: int, params: dict[str, Any], block: int = 0) -> dict[str, Any]:
    """A boosted model, or one block of a forest, of one plant; draws depend on the seed, the plant and the tree only."""
    if not len(y):
        raise ValueError("no complete row to train on")
    edges = [edges_of(x[:, f]) for f in range(x.shape[1])]
    bins, n, names = binned(x, edges), len(y), range(x.shape[1])
    limits = {"depth": params["maxDepth"], "min_split": params["minInstancesToSplit"], "min_leaf": params["minInstancesPerNode"], "penalty": params["penalty"]}
    trees, gains = [], np.zeros(x.shape[1])
    if kind == "forest":
        base = 0.0
        for number in range(block * BLOCK, min(params["trees"], (block + 1) * BLOCK)):
            drawn = np.random.default_rng([config.SEED, plant, number]).integers(0, n, n)
            tree, _, gain = grow(bins, y, np.bincount(drawn, minlength=n).astype(float), names, **limits)
            trees.append((tree, _limits(tree, edges)))
            tree["value"] = tree["value"] / params["trees"]
            gains += gain / gain.sum() if gain.sum() else 0.0
    else:
        base = float(y.mean())
        now = np.full(n, base)
        for number in range(params["trees"]):
            random = np.random.default_rng([config.SEED, plant, number])
            weight, columns = np.ones(n), names
            if params["subsamplingRate"] < 1:
                weight = np.zeros(n)
                weight[random.choice(n, max(1, int(n * params["subsamplingRate"])), replace=False)] = 1
            if params["columns"] < 1:
                columns = np.sort(random.choice(x.shape[1], max(1, int(x.shape[1] * params["columns"])), replace=False)).tolist()
            tree, node, gain = grow(bins, y - now, weight, columns, **limits)
            tree["value"] = tree["value"] * params["stepSize"]
            now += tree["value"][node]
            trees.append((tree, _limits(tree, edges)))
            gains += gain
    return {"base": base, "trees": len(trees), "n": n, "gains": gains.tolist(), **_flattened(trees)}


def walk(x: np.ndarray, model: dict[str, Any]) -> np.ndarray:
    """Sum of the leaves that each row reaches, with the model's base."""
    roots, feature, left = (np.asarray(model[c], np.int64) for c in ("roots", "feature", "left"))
    threshold, value, out = np.asarray(model["threshold"]), np.asarray(model["value"]), np.full(len(x), float(model["base"]))
    for s in range(0, len(x), CHUNK):
        part = x[s:s + CHUNK]
        at, each = np.tile(roots, (len(part), 1)), np.arange(len(part))[:, None]
        while (inner := feature[at] >= 0).any():
            right = part[each, np.maximum(feature[at], 0)] > threshold[at]
            at = np.where(inner, left[at] + right, at)
        out[s:s + CHUNK] += value[at].sum(1)
    return out


def _blocks(kind: str, params: dict[str, Any]) -> int:
    return -(-params["trees"] // BLOCK) if kind == "forest" else 1


def _spread(dealt: DataFrame, *keys: str) -> DataFrame:
    """Few rows, much work: a number of tasks of its own, which adaptive execution does not merge by size."""
    spark = dealt.sparkSession
    return dealt.repartition(4 * max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism), *keys)


def fit_fleet_trees(rows: DataFrame, features: Sequence[str], kinds: dict[str, dict | None], target: str = "generation_kwh") -> DataFrame:
    """Tree models of every plant, in one job: rows of ``MODEL_SCHEMA``.

    ``kinds`` names the kinds, each with parameters or none. Rows with a missing value are left out. A plant whose
    fit fails gets a row with ``error`` and no trees and does not stop the others.
    """
    features, wanted = list(features), {kind: settings(kind, params) for kind, params in kinds.items()}
    jobs = [(kind, block) for kind, params in wanted.items() for block in range(_blocks(kind, params))]
    work = F.explode(F.array(*(F.struct(F.lit(kind).alias("kind"), F.lit(block).alias("block")) for kind, block in jobs)))

    def fit(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        plant, kind, block = int(key[0]), key[1], int(key[2])
        start, out = time.perf_counter(), dict.fromkeys(_MODEL_COLUMNS)
        try:
            group = group.dropna(subset=[*features, target]).sort_values("generation_date", kind="stable")
            out |= fit_plant(kind, group[features].to_numpy(float), group[target].to_numpy(float), plant, wanted[kind], block)
        except Exception:  # noqa: BLE001 - one plant must not stop the fleet
            out["error"] = traceback.format_exc(limit=1)
        out |= {"plant_id": plant, "kind": kind, "block": block, "seconds": time.perf_counter() - start}
        return pd.DataFrame([out], columns=_MODEL_COLUMNS)

    values = [F.col(c).cast("double").alias(c) for c in [*features, target]]
    dealt = rows.select("plant_id", "generation_date", *values).withColumn("work", work).select("*", "work.*").drop("work")
    dealt = _spread(dealt, "plant_id", "kind", "block")
    return dealt.groupBy("plant_id", "kind", "block").applyInPandas(fit, MODEL_SCHEMA)


def ridge_models(coefficients: DataFrame) -> DataFrame:
    """Fleet ridge coefficients as rows of ``MODEL_SCHEMA``."""
    found = {"kind": F.lit("ridge"), "block": F.lit(0), "trees": F.lit(0), "n": F.col("n"), "base": F.col("intercept"), "coefficients": F.col("coefficients"), "plant_id": F.col("plant_id")}
    types = {field.split(" ")[0]: field.split(" ")[1] for field in MODEL_SCHEMA.split(", ")}
    return coefficients.select(*(found.get(c, F.lit(None)).cast(types[c]).alias(c) for c in _MODEL_COLUMNS))


def score_models(rows: DataFrame, models: DataFrame, features: Sequence[str], output: str = "prediction") -> DataFrame:
    """Every row with each of its plant's models: the columns of ``rows``, ``kind`` and a prediction.

    Rows of a plant without a usable model come once, without kind and prediction. Models meet their plant's rows in one
    join by plant; a plant's hours are bounded by the calendar. A row with a missing feature has no ridge prediction.
    """
    features, columns = list(features), [c for c in rows.columns if c not in ("kind", output)]
    names = [f.name for f in rows.schema.fields if f.name in columns]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name in columns) + f", kind string, `{output}` double"

    def score(group: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(group):
            return pd.DataFrame({c: [] for c in [*names, "kind", output]})
        x, parts = group[features].to_numpy(float), []
        for kind, blocks in held.groupby("kind", sort=True):
            total = np.zeros(len(group))
            for model in blocks.to_dict("records"):
                total += model["base"] + x @ np.asarray(model["coefficients"], float) if kind == "ridge" else walk(x, model)
            parts.append(group[names].assign(kind=kind, **{output: np.where(np.isnan(total), None, total)}))
        return pd.concat(parts) if parts else group[names].assign(kind=None, **{output: None})
    good = models.groupBy("plant_id", "kind").agg(F.count("error").alias("bad")).where("bad = 0").select("plant_id", "kind")
    usable = models.join(good, ["plant_id", "kind"], "left_semi").drop("error", "seconds", "gains")
    return rows.select(*names).groupBy("plant_id").cogroup(usable.groupBy("plant_id")).applyInPandas(score, schema)


def tree_importances(models: DataFrame, features: Sequence[str]) -> DataFrame:
    """Share of each feature in the gains of a plant's trees, strongest first: plant_id, kind, feature, importance, rank."""
    from pyspark.sql import Window
    long = models.where("gains IS NOT NULL").select("plant_id", "kind", F.posexplode("gains").alias("pos", "gain"))
    summed = long.groupBy("plant_id", "kind", "pos").agg(F.sum("gain").alias("gain"))
    whole = summed.groupBy("plant_id", "kind").agg(F.sum("gain").alias("whole"))
    shares = summed.join(whole, ["plant_id", "kind"]).select(
        "plant_id", "kind", F.get(F.array(*map(F.lit, features)), F.col("pos")).alias("feature"), F.try_divide("gain", "whole").alias("importance"))
    return shares.withColumn("rank", F.row_number().over(Window.partitionBy("plant_id", "kind").orderBy(F.desc("importance"), "feature")))


def tune_fleet_trees(folded: DataFrame, features: Sequence[str], kind: str, trials: Sequence[dict[str, Any]], splits: int = config.CV_SPLITS,
                     target: str = "generation_kwh") -> DataFrame:
    """Mean absolute error of each trial over expanding folds, per plant: plant_id, trial, mae, rank (best first).

    Rows carry their ``fold`` (``time_series_folds``). Every plant, trial and fold is fitted by its own task, in one job.
    """
    features, wanted = list(features), [settings(kind, t) for t in trials]

    def judge(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        plant, trial, test = (int(k) for k in key)
        group = group.sort_values("generation_date", kind="stable")
        x, y, late = group[features].to_numpy(float), group[target].to_numpy(float), group["fold"].to_numpy() == test
        if late.all() or not late.any():  # too few rows for this fold
            return pd.DataFrame({"plant_id": [], "trial": [], "test": [], "error": []})
        guess = sum(walk(x[late], fit_plant(kind, x[~late], y[~late], plant, wanted[trial], b)) for b in range(_blocks(kind, wanted[trial])))
        return pd.DataFrame({"plant_id": [plant], "trial": [trial], "test": [test], "error": [float(np.abs(guess - y[late]).mean())]})

    def numbers(first: int, stop: int):
        return F.explode(F.array(*map(F.lit, range(first, stop))))
    dealt = folded.withColumn("trial", numbers(0, len(trials))).withColumn("test", numbers(1, splits + 1)).where("fold <= test").dropna(subset=[*features, target])
    errors = _spread(dealt, "plant_id", "trial", "test").groupBy("plant_id", "trial", "test").applyInPandas(judge, "plant_id long, trial int, test int, error double")
    return ranked_trials(errors.groupBy("plant_id", "trial").agg(F.avg("error").alias("mae")))


def ranked_trials(trials: DataFrame) -> DataFrame:
    from pyspark.sql import Window
    return trials.withColumn("rank", F.row_number().over(Window.partitionBy("plant_id").orderBy("mae", "trial")))
