"""Numeric expressions: tolerant parsing, guarded statistics, scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def numeric_amount(name: str) -> Column:
    """A number that may carry thousands commas; anything unreadable is NULL."""
    return F.expr(f"nullif(try_cast(replace(CAST(`{name}` AS STRING), ',', '') AS DOUBLE), DOUBLE('NaN'))")


def numeric(name: str) -> Column:
    return F.expr(f"nullif(try_cast(`{name}` AS DOUBLE), DOUBLE('NaN'))")


def ratio(numerator: Column, denominator: Column) -> Column:
    """NULL when the denominator is zero or missing."""
    return F.try_divide(numerator, denominator)


def sum_or_zero(c: Column | str) -> Column:
    return F.coalesce(F.sum(_col(c)), F.lit(0.0))


def guarded_corr(x: Column | str, y: Column | str) -> Column:
    """Pearson correlation over pairs where both are present; NULL when either side is constant."""
    x, y = _col(x), _col(y)
    spread = F.stddev_samp(F.when(y.isNotNull(), x)) * F.stddev_samp(F.when(x.isNotNull(), y))
    return F.try_divide(F.covar_samp(x, y), spread)


def non_negative(c: Column | str) -> Column:
    c = _col(c)
    return F.when(c.isNotNull(), F.greatest(c, F.lit(0.0)))


def score_closeness(c: Column) -> Column:
    """100 at a ratio of exactly one, falling by one point per percent of distance."""
    return F.when(c.isNotNull(), F.greatest(F.lit(0.0), 100 - F.abs(c - 1) * 100))


def score_correlation(c: Column) -> Column:
    return F.when(c.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(100.0), c * 100)))


def weighted_score(parts: list[tuple[Column, float]]) -> Column:
    """Weighted mean over the components that are present; NULL when none is."""
    total = sum((F.coalesce(score * weight, F.lit(0.0)) for score, weight in parts), F.lit(0.0))
    weight = sum((F.when(score.isNotNull(), F.lit(w)).otherwise(F.lit(0.0)) for score, w in parts), F.lit(0.0))
    return F.try_divide(total, weight)


def performance_ratio(actual: Column, predicted: Column) -> Column:
    """Actual over predicted in percent, 0 where nothing was predicted."""
    return F.when(predicted > 0, actual / predicted * 100).otherwise(F.lit(0.0))
