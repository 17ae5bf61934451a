"""Registered queries over the fixture tables and their SQL twins."""

from catalog import cleaning_queries, forecast_queries, kpi_queries, model_queries, quality_queries  # noqa: F401
from catalog.registry import REGISTRY

__all__ = ["REGISTRY"]
