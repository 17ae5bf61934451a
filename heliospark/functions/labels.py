"""Bands, flags and texts derived from KPI values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from heliospark import config


def _ladder(c: Column, steps: list[tuple[Column, str]], last: str, missing: str | None) -> Column:
    expr = F.when(c.isNull(), F.lit(missing))
    for test, label in steps:
        expr = expr.when(test, label)
    return expr.otherwise(last)


def audit_freshness(days: Column) -> Column:
    return _ladder(days, [(days == 0, "CURRENT"), (days <= 7, "RECENT"), (days <= 30, "STALE")], "VERY STALE", None)


def source_freshness(days: Column) -> Column:
    return _ladder(days, [(days <= 7, "CURRENT"), (days <= 30, "RECENT"), (days <= 90, "STALE")], "VERY STALE", None)


def completeness_band(pct: Column, missing: str | None = None) -> Column:
    return _ladder(pct, [(pct >= 85, "good"), (pct >= 60, "fair")], "poor", missing)


def r2_band(r2: Column) -> Column:
    return _ladder(r2, [(r2 >= 0.5, "good"), (r2 >= 0, "fair")], "poor", None)


def wape_band(wape: Column) -> Column:
    return _ladder(wape, [(wape <= 50, "good"), (wape <= 70, "fair")], "poor", None)


def ratio_band(r: Column) -> Column:
    gap = F.abs(r - 1)
    return _ladder(r, [(gap <= 0.05, "close"), (gap <= 0.20, "moderate"), (gap <= 0.50, "wide")], "far", "missing")


def percentage_band(pct: Column) -> Column:
    return _ladder(pct, [(pct >= 90, "high"), (pct >= 70, "medium"), (pct >= 50, "low")], "very low", "missing")


def quality_band(score: Column) -> Column:
    return _ladder(score, [(score >= 80, "Good"), (score >= 65, "Usable"), (score >= 50, "Caution")], "Poor", "Unknown")


def reliability(r2: Column, wape: Column) -> Column:
    review = (r2 < config.MIN_TEST_R2) | (wape > config.MAX_TEST_WAPE_PCT)
    return F.when(r2.isNull() & wape.isNull(), "Unknown").when(F.coalesce(review, F.lit(False)), "Review").otherwise("Usable")


def agreement_flag(distance: Column) -> Column:
    return _ladder(distance, [(distance <= 0.05, "close_agreement"), (distance <= 0.20, "moderate_difference")],
                   "large_difference", "no_reference_overlap")


def control_interpretation(r: Column) -> Column:
    """Plain-language reading of a candidate/control ratio."""
    pct = (r - 1) * 100
    whole = F.bround(F.abs(pct), 0).cast("long")
    return (F.when(r.isNull(), "n/a")
            .when(F.abs(pct) <= 5, "Close agreement")
            .when(pct > 0, F.format_string("Candidate is %d%% higher than control", whole))
            .otherwise(F.format_string("Candidate is %d%% lower than control", whole)))


def joined_warnings(*warnings: Column) -> Column:
    """Present warnings joined by ``; ``, or ``None`` as text when there are none."""
    text = F.concat_ws("; ", *warnings)
    return F.when(text == "", "None").otherwise(text)


def season(month: Column) -> Column:
    expr = None
    for name in config.SEASON_ORDER:
        test = month.isin(config.SEASON_MONTHS[name])
        expr = F.when(test, name) if expr is None else expr.when(test, name)
    return expr
