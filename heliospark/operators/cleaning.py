"""Plant selection, names, deduplication and cleaning of the interval log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heliospark import config
from heliospark.functions.numbers import numeric_amount
from heliospark.functions.times import utc_to_local


def select_plants(df: DataFrame, plants: DataFrame) -> DataFrame:
    """Keep rows of configured plants. The planner broadcasts the id set when its size allows."""
    return df.join(plants.select("plant_id"), "plant_id", "left_semi")


def with_plant_name(df: DataFrame, plants: DataFrame) -> DataFrame:
    return df.join(plants.select("plant_id", "plant_name"), "plant_id", "left")


def clean_plants(df: DataFrame, fleet: DataFrame) -> DataFrame:
    """Configured plants in display order, with their current names and a default address."""
    dim = fleet.select("plant_id", F.col("plant_name").alias("_name"), F.col("ordinal").alias("_ordinal"))
    joined = df.join(dim, "plant_id").withColumns({
        "plant_name": F.coalesce("_name", "plant_name"),
        "plant_address": F.coalesce("plant_address", F.lit(config.DEFAULT_ADDRESS)),
        "selected_for_dashboard": F.lit(True),
    })
    return joined.orderBy("_ordinal").drop("_name", "_ordinal")


def normalize_names(df: DataFrame, column: str = "plant_name", aliases: dict[str, str] | None = None) -> DataFrame:
    """Replace legacy labels by current ones; other labels stay."""
    aliases = config.NAME_ALIASES if aliases is None else aliases
    pairs = config.inline_table(df.sparkSession, ["_alias", "_label"], list(aliases.items()))
    return (df.join(pairs, F.col(column) == F.col("_alias"), "left")
            .withColumn(column, F.coalesce("_label", column)).drop("_alias", "_label"))


def dedup_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the last row per key by an explicit order.

    An aggregate rather than a window: copies are reduced before the shuffle, so a key with a huge
    number of copies never has to be gathered.
    """
    rest = [c for c in df.columns if c not in keys]
    packed = F.max_by(F.struct(*rest), F.struct(*order)).alias("_last")
    out = df.groupBy(*keys).agg(packed)
    return out.select(*keys, *[F.col("_last")[c].alias(c) for c in rest]).select(*df.columns)


def parse_generation(df: DataFrame, plants: DataFrame, tz: str = config.TIMEZONE) -> DataFrame:
    """Configured plants with typed local time and amount: plant_id, generation_date, amount, ingest_seq."""
    return select_plants(df, plants).select(
        "plant_id",
        utc_to_local(df, "generation_date", tz).alias("generation_date"),
        numeric_amount("generation_amount").alias("amount"),
        "ingest_seq",
    )


def last_amounts(df: DataFrame, plants: DataFrame, usable: Column, tz: str = config.TIMEZONE) -> DataFrame:
    """The last usable amount per plant and timestamp: plant_id, generation_date, amount, copies.

    Unusable rows are left out inside the aggregate. A filter in front of it would be pushed to the
    scan and parse every text twice. Only fixed-width values enter the aggregate, so it stays a hash
    aggregate with map-side combine, and copies of one timestamp are reduced before the shuffle.
    """
    valid = usable & F.col("generation_date").isNotNull()
    rows = parse_generation(df, plants, tz).withColumn("_seq", F.when(valid, F.col("ingest_seq")))
    last = rows.groupBy("plant_id", "generation_date").agg(
        F.max_by("amount", "_seq").alias("amount"), F.count("_seq").alias("copies"))
    return last.where(F.col("copies") > 0)


def clean_generation(df: DataFrame, plants: DataFrame, tz: str = config.TIMEZONE) -> DataFrame:
    """Clean the interval log: readable, non-negative, one row per plant and timestamp, Wh and kWh."""
    last = last_amounts(df, plants, F.col("amount") >= 0, tz)
    return with_plant_name(last, plants).select(
        "plant_id", "plant_name", "generation_date", F.col("amount").alias("generation_amount_wh"),
        (F.col("amount") / 1000).alias("generation_kwh"), F.lit(False).alias("is_negative_generation"),
        (F.col("copies") - 1).alias("duplicate_rows_removed_for_same_plant_timestamp"))


def audit_rows(df: DataFrame, plants: DataFrame, tz: str = config.TIMEZONE) -> DataFrame:
    """Deduplicated rows for auditing: negatives and unreadable amounts are kept."""
    last = last_amounts(df, plants, F.lit(True), tz)
    return last.select("plant_id", "generation_date", (F.col("amount") / 1000).alias("generation_kwh"))


def duplicate_audit(df: DataFrame, plants: DataFrame, tz: str = config.TIMEZONE) -> DataFrame:
    """Per plant: rows, members of duplicated timestamps, rows a deduplication removes."""
    copies = parse_generation(df, plants, tz).groupBy("plant_id", "generation_date").agg(
        F.count("generation_date").alias("n")).where(F.col("n") > 0)
    return copies.groupBy("plant_id").agg(
        F.sum("n").alias("total_rows"),
        F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("duplicated_rows"),
        F.sum(F.col("n") - 1).alias("rows_removed"))
