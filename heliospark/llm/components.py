"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliospark.llm.shared import keep

_MAX_ROUNDS = 60
_ROWS = 200_000  # links in a file of a round


def _both(links: DataFrame) -> DataFrame:
    return links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Point the larger (or the smaller and own) neighbours of every node at its least neighbour."""
    around = _both(links) if large else links
    least = around.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    moved = around.join(least, "a")
    if large:
        out = moved.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """Label every linked node with the least node it can reach.

    ``links`` has two integer columns ``a`` and ``b``; order, repeats and self links do not matter. Returns ``node``
    and ``label``; a node without a smaller one to reach is its own label and absent. Rows with a null are ignored. Every round is written
    to the shared folder, so a lost executor repeats one round at most; neighbour lists are never gathered.
    """
    ordered = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current, before = keep(ordered, "links"), None
    parts = int(links.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for _ in range(_MAX_ROUNDS):
        state = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return current.select(F.col("a").alias("node"), F.col("b").alias("label"))
        before = state
        moved = _star(_star(current, True), False)
        current = keep(moved if state[0] > parts * _ROWS else moved.coalesce(max(1, -(-state[0] // _ROWS))), "links")
    raise RuntimeError("components did not settle")
