"""Ridge regression: one distributed MLlib fit, or every plant of a fleet in a single pass."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heliospark import config

_FLUSH_KEYS = 4096
_MERGE = 64  # triangles of a plant are merged in this many shares first


def ridge_estimator(df: DataFrame, alpha: float = config.RIDGE_ALPHA, target: str = "generation_kwh") -> LinearRegression:
    """An MLlib estimator that minimises squared error plus ``alpha`` times the squared coefficients.

    MLlib averages the loss over rows and scales the target by its deviation, so the penalty is
    rescaled accordingly. The intercept is not penalised and features are not standardised.
    """
    n, spread = df.agg(F.count(target), F.stddev_pop(target)).first()
    return LinearRegression(
        labelCol=target, solver="normal", elasticNetParam=0.0, standardization=False,
        regParam=alpha * (spread or 1.0) / max(n, 1))


def _columns(rows: pd.DataFrame, features: list[str], target: str) -> np.ndarray:
    """A column of ones, the features and the target; rows with a missing value are left out."""
    z = np.column_stack([np.ones(len(rows)), rows[[*features, target]].to_numpy(float)])
    return z[~np.isnan(z).any(axis=1)]


def _triangle(z: np.ndarray) -> np.ndarray:
    """The triangular factor of a matrix, square also where it has few rows."""
    r = np.linalg.qr(z, mode="r")
    return np.vstack([r, np.zeros((z.shape[1] - len(r), z.shape[1]))])


def _factors(df: DataFrame, keys: list[str], features: list[str], target: str) -> DataFrame:
    """Triangular factors of the rows of each key: one for each task and key, then one for each key and ``_MERGE`` share of the tasks."""
    size, schema = len(features) + 2, ", ".join(f"{k} long" for k in keys)

    def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        share, held = TaskContext.get().partitionId() % _MERGE, {}
        for batch in batches:
            for key, rows in batch.groupby(keys):
                z = _columns(rows, features, target)
                held[key] = _triangle(np.vstack([held[key], z]) if key in held else z)
            if len(held) >= _FLUSH_KEYS:
                yield emit(held, share)
                held = {}
        if held:
            yield emit(held, share)

    def emit(held: dict, share: int) -> pd.DataFrame:
        return pd.DataFrame({**{k: [key[i] for key in held] for i, k in enumerate(keys)}, "share": share, "factor": [r.ravel() for r in held.values()]})

    def merge(found: pd.DataFrame) -> pd.DataFrame:
        r = _triangle(np.vstack([np.reshape(f, (size, size)) for f in found["factor"]]))
        return found.iloc[:1].assign(factor=[r.ravel()])
    rows = df.select(*[F.col(k).cast("long").alias(k) for k in keys], *[F.col(c).cast("double").alias(c) for c in [*features, target]])
    parts = rows.mapInPandas(local, f"{schema}, share int, factor array<double>")
    return parts.groupBy(*keys, "share").applyInPandas(merge, f"{schema}, share int, factor array<double>")


def solve_ridge(r: np.ndarray, alphas: Sequence[float]) -> tuple[int, list[tuple[float, np.ndarray]]]:
    """Rows, and intercept and weights for every alpha, from the triangular factor of (1, features, target).

    Below its first row the factor is that of the centred columns, so the intercept goes unpunished; one singular value
    decomposition serves all alphas, and squares of the condition number never appear.
    """
    n, mean = int(round(r[0, 0] ** 2)), r[0] / r[0, 0]
    varies = np.linalg.norm(r[1:, 1:-1], axis=0) > 1e-12 * np.abs(r[0, 1:-1])  # a constant feature has no weight
    u, s, v = np.linalg.svd(r[1:, 1:-1] * varies, full_matrices=False)
    along, found = u.T @ r[1:, -1], []
    for alpha in alphas:
        weights = np.where(varies, v.T @ (s / np.maximum(s * s + alpha, 1e-300) * along), 0.0)
        found.append((float(mean[-1] - mean[1:-1] @ weights), weights))
    return n, found


def fit_fleet_ridge(df: DataFrame, features: Sequence[str], alpha: float = config.RIDGE_ALPHA,
                    target: str = "generation_kwh") -> DataFrame:
    """Ridge coefficients of every plant: plant_id, n, intercept, coefficients.

    A tree of QR factorisations: each task reduces its rows to one small triangle per plant it meets, triangles are merged
    in two steps, and the last is solved. The number of plants is not limited by the driver, nor is the size of any one
    plant. Rows with a missing value are left out; a plant without other rows has no coefficients.
    """
    features = list(features)
    size = len(features) + 2

    def solve(parts: pd.DataFrame) -> pd.DataFrame:
        r = _triangle(np.vstack([np.reshape(f, (size, size)) for f in parts["factor"]]))
        if not r[0, 0]:
            return pd.DataFrame({c: [] for c in ("plant_id", "n", "intercept", "coefficients")})
        n, [(intercept, weights)] = solve_ridge(r, [alpha])
        return pd.DataFrame({"plant_id": [parts["plant_id"].iloc[0]], "n": [n], "intercept": [intercept], "coefficients": [weights.tolist()]})
    return _factors(df, ["plant_id"], features, target).groupBy("plant_id").applyInPandas(
        solve, "plant_id long, n long, intercept double, coefficients array<double>")


def tune_fleet_ridge(folded: DataFrame, features: Sequence[str], alphas: Sequence[float], splits: int = config.CV_SPLITS,
                     target: str = "generation_kwh") -> DataFrame:
    """Mean absolute error of every alpha over expanding folds, per plant: plant_id, alpha, mae, rank (best first).

    One scan reduces the rows of each plant and fold to a triangle; the triangles of the folds before a test fold, put
    together, train for it. The coefficients of all alphas then meet the rows of their test fold.
    """
    features, alphas = list(features), [float(a) for a in alphas]
    size = len(features) + 2

    def solve(parts: pd.DataFrame) -> pd.DataFrame:
        rows, stack = [], np.zeros((0, size))
        triangles = [(fold, np.reshape(f, (size, size))) for fold, f in zip(parts["fold"], parts["factor"])]
        for test in range(1, splits + 1):
            stack = _triangle(np.vstack([np.zeros((1, size)), *(t for fold, t in triangles if fold < test)]))
            if stack[0, 0]:
                _, found = solve_ridge(stack, alphas)
                rows += [(parts["plant_id"].iloc[0], test, a, intercept, w.tolist()) for a, (intercept, w) in zip(alphas, found)]
        return pd.DataFrame(rows, columns=["plant_id", "fold", "alpha", "intercept", "coefficients"])
    fitted = _factors(folded, ["plant_id", "fold"], features, target).groupBy("plant_id").applyInPandas(
        solve, "plant_id long, fold long, alpha double, intercept double, coefficients array<double>")
    error = F.abs(F.col(target) - linear_prediction(features))
    scored = folded.where("fold > 0").dropna(subset=[*features, target]).join(fitted, ["plant_id", "fold"])
    errors = scored.groupBy("plant_id", "alpha", "fold").agg(F.avg(error).alias("error"))
    mean = errors.groupBy("plant_id", "alpha").agg(F.avg("error").alias("mae"))
    return mean.withColumn("rank", F.row_number().over(Window.partitionBy("plant_id").orderBy("mae", "alpha")))


def linear_prediction(features: Sequence[str], coefficients: str = "coefficients", intercept: str = "intercept") -> Column:
    terms = [F.col(coefficients)[i] * F.col(c).cast("double") for i, c in enumerate(features)]
    return sum(terms, F.col(intercept))


def score_fleet_ridge(df: DataFrame, coefficients: DataFrame, features: Sequence[str],
                      output: str = "ml_predicted_kwh") -> DataFrame:
    """Non-negative predictions from per-plant coefficients; rows of unknown plants keep NULL."""
    raw = linear_prediction(features)
    scored = df.join(coefficients.select("plant_id", "intercept", "coefficients"), "plant_id", "left")
    return scored.withColumn(output, F.when(raw.isNotNull(), F.greatest(raw, F.lit(0.0)))).drop("intercept", "coefficients")


def ranked_coefficients(coefficients: DataFrame, features: Sequence[str], top: int | None = None) -> DataFrame:
    """Coefficients per plant by magnitude, all or the ``top`` ones."""
    from heliospark.operators.kpi import top_by_magnitude
    names = F.array(*[F.lit(f) for f in features])
    long = coefficients.select("plant_id", F.posexplode("coefficients").alias("pos", "coefficient")).withColumn(
        "feature", F.get(names, F.col("pos"))).drop("pos")
    return top_by_magnitude(long, "coefficient", "abs_coefficient", top or len(features))
