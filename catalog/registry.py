"""Registration of queries with their SQL twins, and the output conventions both sides share."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog.bindings import Fixture
from catalog.oracle_tables import with_tables

DIGITS = 6


@dataclass(frozen=True)
class Entry:
    name: str
    rows: str  # inventory rows covered
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def tidy(df: DataFrame) -> DataFrame:
    """Round doubles. The tiny offset keeps exact decimal ties from depending on summation order."""
    rounded = {f.name: F.round(F.col(f"`{f.name}`") + 1e-9, DIGITS) for f in df.schema.fields
               if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.withColumns(rounded) if rounded else df


def tidy_sql(body: str, doubles: str) -> str:
    replaced = ", ".join(f"round(CAST({c} AS DOUBLE) + 1e-9, {DIGITS}) AS {c}" for c in doubles.split())
    inner = f"SELECT * REPLACE ({replaced}) FROM ({body}) q" if replaced else f"SELECT * FROM ({body}) q"
    return with_tables(inner)


def query(name: str, rows: str, sql: str | None = None, doubles: str = ""):
    """Register a function of a Fixture under a query name."""
    def register(build: Callable[[Fixture], DataFrame]):
        def run(spark: SparkSession, directory: str) -> DataFrame:
            return tidy(build(Fixture(spark, directory)))
        REGISTRY[name] = Entry(name, rows, run, tidy_sql(sql, doubles) if sql else None)
        return build
    return register
