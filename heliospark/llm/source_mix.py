"""Mixing sources to target weights by systematic sampling, with DataFrame functions only.

Every document of a source has the same expected number of copies, target / source size. Their prefix sum within the
source plus one random offset crosses an integer each time a copy is taken, so reruns agree and no document gets more
than ceil(expected) copies. Documents are summed in the order of their size: then what a source takes stays within about
one largest document of its target. A document's place in its source comes from one range-sorted table of sizes (texts do
not move): place in its partition, plus the counts of the partitions before. A source that holds most rows is spread over
many partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heliospark.llm.shared import WORD, keep, only

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
SEED = 42
_BLANKS = " \t\n\x0b\x0c\r"


def word_count() -> F.Column:
    """Number of words of ``text``: each becomes one letter, blanks go."""
    marks = F.translate(F.regexp_replace("text", WORD, "x"), _BLANKS, "")
    return F.coalesce(F.length(marks), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Targets in words of each source (``source``, ``source_size`` -> ``target``), water-filled under their limits.

    Sources by code point, null last, weigh ``weights`` in turn. The limit of a source is ``most`` times its size; what
    exceeds it is dealt to the others by weight. In the order of limit / weight the filled sources come first, so the
    level follows from prefix sums over one row per source.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("weight", weight).withColumn("limit", F.col("source_size") * F.lit(float(most)))
    by_level = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").isNull(), "source")
    before, whole = by_level.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    rows = (rows.withColumn("goal", F.sum("source_size").over(whole) * F.lit(float(share)))
            .withColumn("filled", F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
            .withColumn("open", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
            .withColumn("level", (F.col("goal") - F.col("filled")) / F.col("open")))
    # a source is filled if the level met at its place reaches its limit; the first that is not sets the level for the rest
    rows = rows.withColumn("place", F.row_number().over(by_level))
    level = F.min(F.when(F.col("level") * F.col("weight") < F.col("limit"), F.struct("place", "level"))).over(whole)["level"]
    return rows.select("source", "source_size", F.least("limit", F.coalesce(level, F.lit(float("inf"))) * F.col("weight")).alias("target"))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED) -> DataFrame:
    """How often the mix takes each document.

    ``docs`` needs ``doc_id``, ``text`` and ``source``. Returns ``doc_id``, ``tkey`` (hash of the text), ``size`` in
    words (0 for null, empty and blank texts), ``source``, ``source_size``, ``target`` (words its source should give),
    ``copies`` and ``taken`` (size * copies). Null is a source of its own, after the others. A source without words has
    target 0 and gives no copy. Ties in size are ordered by doc_id, then by the text's hash; rows equal in all of these
    are interchangeable. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    narrow = docs.select("doc_id", F.xxhash64("text").alias("tkey"), "source", word_count().alias("size"))
    order = [F.col("source").isNull(), "source", "size", "doc_id", "tkey"]
    placed = keep(narrow.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                  .withColumn("place", F.monotonically_increasing_id()), "places")
    placed = placed.withColumn("part", F.shiftright("place", 33)).withColumn("row", F.col("place").bitwiseAND((1 << 33) - 1))

    counts = placed.groupBy("part").agg(F.count("*").alias("rows"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", F.coalesce(F.sum("rows").over(ahead), F.lit(0)).alias("offset"))
    sources = placed.groupBy("source").agg(F.sum("size").alias("source_size"), F.min("place").alias("first"))
    starts = (sources.withColumn("part", F.shiftright("first", 33)).join(offsets, "part")
              .select("source", (F.col("offset") + F.col("first").bitwiseAND((1 << 33) - 1)).alias("start")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    goals = (targets(sources.select("source", "source_size"), weights, share, most).withColumn("rate", rate)
             .withColumnRenamed("source", "s").join(starts.withColumnRenamed("source", "s2"), F.col("s").eqNullSafe(F.col("s2"))).drop("s2"))

    offset = F.pmod(F.xxhash64(F.lit(seed)), F.lit(1 << 32)) / F.lit(float(1 << 32))
    nth = F.col("offset") + F.col("row") - F.col("start")
    crossed = lambda n: F.floor(n * F.col("rate") + offset)
    out = placed.join(offsets, "part").join(goals, F.col("source").eqNullSafe(F.col("s")))
    out = out.withColumn("copies", (crossed(nth + 1) - crossed(nth)).cast("long"))
    return out.select("doc_id", "tkey", "size", "source", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def repeated(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The mix itself: every document as often as ``mixed`` (a result of mix over ``docs``) says, with all columns of ``docs``.

    Rows equal in doc_id, text and source share their copies; which of their other columns a copy shows is not defined.
    """
    times = keep(mixed.groupBy("doc_id", "tkey", "source").agg(F.count("*").alias("rows"), F.sum("copies").cast("int").alias("__copies")).where("__copies > 0"), "copies")
    found = only(docs, times, also=("source",)).withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
    return found.select(*(F.col(f"`{c}`") for c in docs.columns))
