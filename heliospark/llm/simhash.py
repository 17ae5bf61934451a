"""SimHash fingerprints of whole texts and search within a Hamming radius, with DataFrame functions only.

Terms are pairs of neighbouring words, weighted by how often they occur in the text; each votes on 128 signed bits with
its hash. The votes of a bit follow from a count of ones. Two counts share one long, so a document's votes are 64 sums
that a hash aggregate adds up inside the task that explodes its words: terms never reach a shuffle, only one row of sums
for each document does.

The search cuts a fingerprint into radius + 2 blocks; two fingerprints within the radius agree in at least two. There is
one table for each pair of blocks, keyed by both (the permutation that puts them first): 28 tables with keys of 32 bits for
a radius of 6. Equal fingerprints count as one.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heliospark.llm.shared import keep, text_key

BITS = 128
BUCKET = 256  # span of doc_ids that share a window
RADIUS = 6
_PAIR = (1 << 32) | 1


def fingerprints(texts: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Fingerprint the column ``body`` of each row: returns the ``key`` columns, ``high`` and ``low`` (64 bits each).

    ``key`` tells rows apart; rows equal in it give one row. Blanks are space and the characters 9 to 13; equal words in
    the same order give equal fingerprints. Null, empty and blank texts share the fingerprint of an empty word.
    """
    words = F.split(F.coalesce(F.btrim("body", F.lit(" \t\n\x0b\x0c\r")), F.lit("")), r"[\x20\x09-\x0D]+")
    rows = texts.select(*key, words.alias("w")).select(*key, F.inline(F.arrays_zip(F.col("w").alias("a"), F.slice("w", 2, F.size("w")).alias("b"))))
    high = F.xxhash64("a", "b")
    rows = rows.select(*key, high.alias("h1"), F.xxhash64(high, F.lit(1)).alias("h2"))
    votes = [F.sum(F.shiftrightunsigned(h, bit).bitwiseAND(F.lit(_PAIR))).alias(f"{h}_{bit}") for h in ("h1", "h2") for bit in range(32)]
    sums = rows.groupBy(*key).agg(F.count("*").alias("terms"), *votes)

    def signs(h: str) -> Column:
        bits = F.lit(0).cast("long")
        for bit in range(32):
            ones = F.col(f"{h}_{bit}")
            for count, at in ((ones.bitwiseAND(F.lit((1 << 32) - 1)), bit), (F.shiftrightunsigned(ones, 32), bit + 32)):
                bits = bits.bitwiseOR(F.shiftleft((count * 2 > F.col("terms")).cast("long"), at))
        return bits
    return sums.select(*key, signs("h1").alias("high"), signs("h2").alias("low"))


def as_text(high: str = "high", low: str = "low") -> Column:
    return F.lower(F.concat(F.lpad(F.hex(high), 16, "0"), F.lpad(F.hex(low), 16, "0")))


def distance(high1, low1, high2, low2) -> Column:
    return F.bit_count(F.col(high1).bitwiseXOR(F.col(high2))) + F.bit_count(F.col(low1).bitwiseXOR(F.col(low2)))


def likeness(high1: str, low1: str, high2: str, low2: str) -> Column:
    """Share of agreeing bits."""
    return 1 - distance(high1, low1, high2, low2) / F.lit(float(BITS))


def with_next(rows: DataFrame, columns: dict[str, str], order: tuple[str, ...] = ("doc_id", "tkey")) -> DataFrame:
    """Add to each row columns of the next row by descending ``order`` (after the last: the first).

    ``columns`` maps new names to columns. Rows meet in windows over short spans of the first order column. The first row
    of a span is also sent to the span above, so no row looks beyond its window; who is above follows from one narrow row
    per span, dealt to tasks by range; only one row per range of spans meets in one window. A null in the first order column comes last. A lone row is its own next.
    """
    lead_key = F.coalesce(order[0], F.lit(-(1 << 63)))
    rows = rows.withColumn("__bucket", F.shiftright(lead_key, BUCKET.bit_length() - 1))
    best = rows.groupBy("__bucket").agg(F.max(F.struct(lead_key.alias("k"), *(F.coalesce(c, F.lit(-(1 << 63))).alias(c) for c in order[1:]))).alias("head"))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    best = keep(best.repartitionByRange(parts, "__bucket").withColumn("__over", F.spark_partition_id()), "spans")
    within = Window.partitionBy("__over").orderBy("__bucket")
    overs = best.groupBy("__over").agg(F.min("__bucket").alias("lowest"))
    line = Window.orderBy("__over")
    overs = overs.select("__over", F.coalesce(F.lead("lowest").over(line), F.first("lowest").over(line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("beyond"))
    sent = (best.withColumn("above", F.lead("__bucket").over(within)).join(overs, "__over")
            .select(F.col("head"), F.coalesce("above", "beyond").alias("__to")))
    sent = keep(sent.select("__to", F.col("head.k").alias("__k"), *(F.col(f"head.{c}").alias(f"__{c}") for c in order[1:])), "sent")  # its size is known then: texts move only if it is large
    match = lead_key == F.col("__k")
    for c in order[1:]:
        match &= F.coalesce(c, F.lit(-(1 << 63))) == F.col(f"__{c}")
    heads = (rows.join(sent, match).withColumn("__bucket", F.col("__to")).select(*rows.columns)
             .dropDuplicates(["__bucket"]).withColumn("__real", F.lit(False)))
    both = rows.withColumn("__real", F.lit(True)).union(heads)
    w = Window.partitionBy("__bucket").orderBy(F.col("__real").desc(), *(F.col(c).desc_nulls_last() for c in order))
    return (both.withColumns({new: F.lead(F.struct(old)).over(w)[old] for new, old in columns.items()})
            .where("__real").drop("__real", "__bucket"))


def edited(rows: DataFrame) -> DataFrame:
    """Add ``n_chars`` and ``edited``: the last third of each text replaced by as many first characters of the next text."""
    third = F.floor(F.col("n_chars") / 3).cast("int")
    rows = with_next(rows.withColumn("text", F.coalesce("text", F.lit(""))).withColumn("n_chars", F.length("text").cast("long")), {"__next": "text"})
    return rows.withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - third).cast("int")),
                                              F.substring(F.col("__next"), F.lit(1), third))).drop("__next")


def within_radius(queries: DataFrame, prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """All fingerprints of ``prints`` within ``radius`` bits of those in ``queries`` (both distinct ``high``, ``low``).

    Returns ``high``, ``low`` of the query, ``near_high``, ``near_low`` and ``bits``, equal ones included. A pair is
    returned by the first two blocks in which it agrees, hence once. Rows with a null are not found.
    """
    n = radius + 2
    bounds = [BITS * i // n for i in range(n + 1)]

    def blocks(high: Column, low: Column) -> list[Column]:
        ones = lambda width: F.lit(-1 if width == 64 else (1 << width) - 1).cast("long")
        out = []
        for a, b in zip(bounds, bounds[1:]):
            if b <= 64:
                out.append(F.shiftrightunsigned(high, 64 - b).bitwiseAND(ones(b - a)))
            elif a >= 64:
                out.append(F.shiftrightunsigned(low, BITS - b).bitwiseAND(ones(b - a)))
            else:
                out.append(F.shiftleft(high.bitwiseAND(ones(64 - a)), b - 64).bitwiseOR(F.shiftrightunsigned(low, BITS - b)))
        return out

    def tables(frame: DataFrame, prefix: str) -> DataFrame:
        cut = blocks(F.col("high"), F.col("low"))
        keys = [F.struct(F.lit(1 << i | 1 << j).alias("table"), F.xxhash64(cut[i], cut[j]).alias("value")) for j in range(n) for i in range(j)]
        return frame.where("high IS NOT NULL AND low IS NOT NULL").select(
            F.col("high").alias(f"{prefix}high"), F.col("low").alias(f"{prefix}low"), F.inline(F.array(*keys)))

    met = tables(queries, "").join(tables(prints, "near_"), ["table", "value"])
    met = met.withColumn("bits", distance("high", "low", "near_high", "near_low")).where(F.col("bits") <= radius)
    unlike = blocks(F.col("high").bitwiseXOR(F.col("near_high")), F.col("low").bitwiseXOR(F.col("near_low")))
    met = met.withColumn("agree", functools.reduce(Column.bitwiseOR, (F.when(x == 0, 1 << i).otherwise(0) for i, x in enumerate(unlike))))
    lowest = lambda bits: F.col(bits).bitwiseAND(-F.col(bits))
    met = met.withColumn("rest", F.col("agree").bitwiseXOR(lowest("agree")))
    return met.where(lowest("agree").bitwiseOR(lowest("rest")) == F.col("table")).select("high", "low", "near_high", "near_low", "bits")


def fingerprint_report(docs: DataFrame, radius: int = RADIUS, query_step: int = 50) -> DataFrame:
    """Fingerprints of all texts and of their edited versions, and how alike they are.

    ``docs`` needs ``doc_id`` and ``text``. Returns ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint`` (hex), ``near_edited``, ``near_next`` (0 to 1) and ``within_radius``: for doc_ids divisible by
    ``query_step`` the number of other rows whose fingerprint lies within ``radius`` bits, else null. A null text counts
    as empty. Rows sharing a doc_id are ordered by their text's hash; a null doc_id comes last. Repeated rows are each
    returned; an empty table gives an empty result.
    """
    rows = edited(docs.select(F.col("doc_id").cast("long"), "text", text_key().alias("tkey")))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    key = ("doc_id", "tkey", "row", "n_chars", "edited_sha256", "is_edited")
    bodies = rows.select("doc_id", "tkey", "row", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                         F.posexplode(F.array("text", "edited")).alias("is_edited", "body"))
    prints = keep(fingerprints(bodies, key), "prints")
    is_own = F.col("is_edited") == 0
    value = lambda own, c: F.max(F.when(is_own if own else ~is_own, F.col(c)))
    pairs = prints.groupBy("doc_id", "tkey", "row", "n_chars", "edited_sha256").agg(
        value(True, "high").alias("high"), value(True, "low").alias("low"), value(False, "high").alias("edited_high"), value(False, "low").alias("edited_low"))
    pairs = keep(with_next(pairs, {"next_high": "high", "next_low": "low"}), "pairs")
    sizes = pairs.groupBy("high", "low").agg(F.count("*").alias("rows"))
    queries = pairs.where(F.col("doc_id") % query_step == 0).select("high", "low").distinct()
    near = within_radius(queries, sizes, radius).join(sizes.select(F.col("high").alias("near_high"), F.col("low").alias("near_low"), "rows"), ["near_high", "near_low"])
    near = near.groupBy("high", "low").agg(F.sum("rows").alias("near_rows"))
    out = pairs.join(near, ["high", "low"], "left")
    return out.select("doc_id", "n_chars", "edited_sha256", as_text().alias("fingerprint"), as_text("edited_high", "edited_low").alias("edited_fingerprint"),
                      likeness("high", "low", "edited_high", "edited_low").alias("near_edited"), likeness("high", "low", "next_high", "next_low").alias("near_next"),
                      F.when(F.col("doc_id") % query_step == 0, F.col("near_rows") - 1).alias("within_radius"))
