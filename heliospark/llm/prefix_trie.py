"""Prefix trie of conversations, grouped by digests of fixed-length blocks of turns.

A conversation's prefix is the exclusive-or of one 2 x 64-bit value per turn, made from the turn's place, role and text, so
prefixes come from running sums that split long conversations over tasks. Conversations are grouped by whole blocks of
``BLOCK`` turns first: those that share a prefix and go on with one and the same block stay one group, and the turns inside
that block are nodes as they stand. Only where a prefix goes on in several ways are the turns of its blocks compared, one row
per distinct block instead of one per conversation.

A node belongs to the smallest conversation that passes it, so a conversation's own nodes are the end of its path, a chain,
which hangs below one node of another chain. Sums over subtrees are taken over chains first, doubling the distance of each
round (a logarithm of rounds), and then along chains as running sums from their ends.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heliospark.llm.runs import by_range, running
from heliospark.llm.shared import keep

BLOCK = 4
SHARED_TURNS = 9  # a conversation borrows fewer turns than this
FAMILY = 5
NODE = ("depth", "p1", "p2")


def _lane(digest: Column, at: int) -> Column:
    """60 bits of a hexadecimal digest."""
    return F.conv(F.substring(digest, at, 15), 16, 10).cast("long")


def _turns(conversations: DataFrame) -> DataFrame:
    """Turns as fixed-width rows: the text goes into a digest where it is read."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), digest.alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"))
    return rows.select("conv_id", "turn", "role", _lane(F.col("digest"), 1).alias("a"), _lane(F.col("digest"), 16).alias("b"), "bytes")


def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members (conv_id, total: rebuilt turns) and rebuilt turns (conv_id, depth, total, f1, f2, bytes)."""
    numbered = running(keep(_turns(conversations), "trie-turns"), "conv_id", ["turn", "role", "a", "b"], name="trie-numbered")
    sizes = numbered.groupBy("conv_id").agg(F.max("position").alias("n"))
    borrowed = F.crc32(F.col("conv_id").cast("string")) % SHARED_TURNS
    sizes = sizes.withColumns({"h": borrowed, "family": F.col("conv_id") - F.col("conv_id") % FAMILY})
    heads = sizes.select(F.col("conv_id").alias("family"), F.col("n").alias("head"))
    members = sizes.join(heads, "family", "left").withColumn("taken", F.least("h", F.coalesce("head", F.lit(0))))
    members = keep(members.withColumn("total", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
                   .select("conv_id", "family", "h", "taken", "total"), "trie-members")
    first = numbered.where(f"conv_id % {FAMILY} = 0 AND position < {SHARED_TURNS}").select(F.col("conv_id").alias("family"), "position", "a", "b", "bytes")
    shared = first.join(members.where("taken > 0"), "family").where("position <= taken").withColumn("depth", F.col("position"))
    own = numbered.join(members, "conv_id").where("position > h").withColumn("depth", F.col("taken") + F.col("position") - F.col("h"))
    names = ["conv_id", "depth", "total", F.xxhash64("a", "b", "depth").alias("f1"), F.xxhash64("b", "a", "depth").alias("f2"), "bytes"]
    return members.select("conv_id", "total"), keep(shared.select(*names).union(own.select(*names)), "trie-rebuilt")


def _nodes(members: DataFrame, turns: DataFrame, block: int) -> DataFrame:
    """Every node: depth, prefix (p1, p2), prefix before its last turn (b1, b2), bytes, owner (its smallest member), last (depth at which the owner ends), n_convs."""
    prefix = [F.col("run_f1").alias("p1"), F.col("run_f2").alias("p2"), F.expr("run_f1 ^ f1").alias("b1"), F.expr("run_f2 ^ f2").alias("b2")]
    turn = F.struct("depth", *prefix, "bytes")
    blocks = turns.groupBy("conv_id", "total", F.floor((F.col("depth") - 1) / block).alias("k")).agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    blocks = blocks.withColumns({"before": F.struct(F.col("turns")[0]["b1"], F.col("turns")[0]["b2"]),
                                 "after": F.struct(F.element_at("turns", -1)["p1"], F.element_at("turns", -1)["p2"]), "n": F.size("turns")})
    groups = keep(blocks.groupBy("k", "before", "after", "n").agg(
        F.count("*").alias("n_convs"), F.min_by(F.struct("conv_id", "total", "turns"), "conv_id").alias("top")), "trie-blocks")
    ways = groups.groupBy("k", "before").agg(F.count("*").alias("ways"))
    several = groups.join(ways.where("ways > 1"), ["k", "before"], "left_semi")
    single = groups.join(ways.where("ways = 1"), ["k", "before"], "left_semi")
    chosen = ["turn.*", F.col("top.conv_id").alias("owner"), F.col("top.total").alias("last"), "n_convs"]
    alone = single.withColumn("turn", F.explode("top.turns")).select(*chosen)
    refined = several.withColumn("turn", F.explode("top.turns")).select(*chosen).groupBy("depth", "p1", "p2", "b1", "b2").agg(
        F.max("bytes").alias("bytes"), F.min("owner").alias("owner"), F.min_by("last", "owner").alias("last"), F.sum("n_convs").alias("n_convs"))
    zero = [F.lit(0).cast("long").alias(c) for c in ("depth", "p1", "p2", "b1", "b2", "bytes")]
    root = members.agg(F.min("conv_id").alias("owner"), F.min_by("total", "conv_id").alias("last"), F.count("*").alias("n_convs")).where("n_convs > 0")
    return keep(alone.unionByName(refined).unionByName(root.select(*zero, "owner", "last", "n_convs")), "trie-nodes")


def _joined(batches):
    """Runs of equal (depth, p1, p2) in sorted rows: hashed where a run surely lies in this task, else their joined ids in pieces."""
    key, ids, size, first, pieces = None, [], 0, True, 0

    def flush(sure):
        nonlocal ids, size, pieces
        text = ",".join(ids)
        ids, size, pieces = [], 0, pieces + 1
        return (*key, pieces, text, None) if not sure else (*key, pieces, None, hashlib.sha256(text.encode()).hexdigest())

    def out(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(),) * 4 + (pa.string(),) * 2)],
                                          names=[*NODE, "piece", "ids", "sha"])
    for batch in batches:
        rows = []
        for *at, text in zip(*(batch.column(c).to_pylist() for c in (*NODE, "conv_id"))):
            if at != key:
                if key is not None:
                    rows.append(flush(sure=not first and not pieces))
                    first = False
                key, pieces = at, 0
            ids.append(str(text))
            size += len(ids[-1]) + 1
            if size > 1 << 20:
                rows.append(flush(sure=False))
        if rows:
            yield out(rows)
    if key is not None:
        yield out([flush(sure=False)])


def _ends(members: DataFrame, turns: DataFrame) -> DataFrame:
    """Digest of the conversations that end at a node: depth, p1, p2, ends_sha256.

    Ids are joined in order by tasks that hold ranges of (node, id); only runs at the border of a task, or long ones, go on
    as pieces of a megabyte, which one task per node hashes one after the other.
    """
    zero = [F.lit(0).cast("long").alias(c) for c in NODE]
    ends = turns.where("depth = total").select("depth", F.col("run_f1").alias("p1"), F.col("run_f2").alias("p2"), "conv_id")
    ends = keep(ends.union(members.where("total = 0").select(*zero, "conv_id")), "trie-ends")

    def local(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        for batch in _joined(batches):
            yield batch.append_column("part", pa.array([part] * batch.num_rows, pa.int32()))
    joined = keep(by_range(ends, "depth", ["p1", "p2", "conv_id"]).mapInArrow(
        local, "depth long, p1 long, p2 long, piece long, ids string, sha string, part int"), "trie-joined")
    pieces = joined.where("sha IS NULL").repartition(*NODE).sortWithinPartitions(*NODE, "part", "piece")
    hashed = pieces.mapInArrow(_hashed, "depth long, p1 long, p2 long, ends_sha256 string")
    return joined.where("sha IS NOT NULL").select(*NODE, F.col("sha").alias("ends_sha256")).union(hashed)


def _hashed(batches):
    key, state = None, None

    def out(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(),) * 3 + (pa.string(),))], names=[*NODE, "ends_sha256"])
    for batch in batches:
        rows = []
        for *at, ids in zip(*(batch.column(c).to_pylist() for c in (*NODE, "ids"))):
            if at != key:
                if key is not None:
                    rows.append((*key, state.hexdigest()))
                key, state = at, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
        if rows:
            yield out(rows)
    if key is not None:
        yield out([(*key, state.hexdigest())])


def _chain_totals(chains: DataFrame) -> DataFrame:
    """chain, saved and leaves, summed over the chain and all below it; rounds double the distance covered."""
    state = keep(chains.select("chain", F.col("parent").alias("up"), "saved", "leaves"), "trie-chains")
    while not state.where("up IS NOT NULL").isEmpty():
        more = state.where("up IS NOT NULL").groupBy(F.col("up").alias("chain")).agg(F.sum("saved").alias("more"), F.sum("leaves").alias("below"))
        jumps = state.where("up IS NOT NULL").select(F.col("chain").alias("up"), F.col("up").alias("next"))
        grown = state.join(more, "chain", "left").join(jumps, "up", "left")
        state = keep(grown.select("chain", F.col("next").alias("up"), (F.col("saved") + F.coalesce("more", F.lit(0))).alias("saved"),
                                  (F.col("leaves") + F.coalesce("below", F.lit(0))).alias("leaves")), "trie-chains")
    return state.select("chain", "saved", "leaves")


def prefix_trie(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """The trie of rebuilt conversations, one row per node.

    A conversation's turns are taken by turn, null first, ties by role and then by a digest of the text; null role or text
    is empty. Conversation c takes the first h turns of conversation c - c % 5 (as SQL counts, towards zero), all if fewer,
    none if absent, then its own after its first h; h is crc32 of its decimal id, modulo 9. Returns ``conv_id`` (smallest
    member), ``depth``, ``parent_conv_id`` (null for the root), ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``,
    ``ends_sha256``. Repeated rows are turns of their own. Rows without a conv_id are left out; other columns do not
    matter; without conversations there is no node. The turns of a conversation and the members of a node may be any number.
    """
    members, rebuilt = rebuilt_turns(conversations)
    turns = running(rebuilt, "conv_id", ["depth"], xors=("f1", "f2"), name="trie-prefixes")
    nodes = _nodes(members, turns, block)

    own = nodes.withColumn("saved", (F.col("n_convs") - 1) * F.col("bytes"))
    chains = keep(own.groupBy(F.col("owner").alias("chain")).agg(
        F.min_by(F.struct("depth", "b1", "b2"), "depth").alias("top"), F.max("last").alias("last"), F.sum("saved").alias("saved")), "trie-heads")
    above = nodes.select(F.col("depth").alias("at"), F.col("p1").alias("b1"), F.col("p2").alias("b2"), F.col("owner").alias("parent"))
    below = chains.where("top.depth > 0").select("chain", "last", "saved", (F.col("top.depth") - 1).alias("at"), "top.b1", "top.b2")
    hung = below.join(above, ["at", "b1", "b2"]).select("chain", "last", "saved", "parent", "at")
    first = chains.where("top.depth = 0").select("chain", "last", "saved", F.lit(None).cast("long").alias("parent"), F.lit(-1).cast("long").alias("at"))
    hung = keep(hung.union(first), "trie-hung")

    occupied = hung.where("parent IS NOT NULL").select(F.col("parent").alias("chain"), F.col("at").alias("last"), F.lit(0).alias("ends")).distinct()
    leaves = F.coalesce("ends", F.lit(1)).cast("long")
    totals = _chain_totals(hung.join(occupied, ["chain", "last"], "left").withColumn("leaves", leaves))
    whole = hung.select("chain", "parent", "at").join(totals, "chain")
    hanging = whole.where("parent IS NOT NULL").groupBy(F.col("parent").alias("owner"), F.col("at").alias("depth")).agg(
        F.count("*").alias("hanging"), F.sum("saved").alias("hung_saved"), F.sum("leaves").alias("hung_leaves"))
    tops = whole.select(F.col("chain").alias("owner"), (F.col("at") + 1).alias("depth"), F.lit(True).alias("top"), F.col("parent").alias("top_parent"))

    none = F.lit(0).cast("long")
    full = (own.join(hanging, ["owner", "depth"], "left").join(tops, ["owner", "depth"], "left")
            .join(_ends(members, turns), list(NODE), "left"))
    full = keep(full.select(
        "owner", "depth", "n_convs", F.when(F.col("top"), F.col("top_parent")).otherwise(F.col("owner")).alias("parent_conv_id"),
        (F.coalesce("hanging", none) + (F.col("depth") < F.col("last")).cast("long")).alias("n_children"),
        (F.col("saved") + F.coalesce("hung_saved", none)).alias("saved"),
        (F.coalesce("hung_leaves", none) + ((F.col("depth") == F.col("last")) & F.col("hanging").isNull()).cast("long")).alias("leaves"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")), "trie-full")
    summed = running(full, "owner", [F.col("depth").desc()], sums=("saved", "leaves"), name="trie-sums")
    return summed.select(F.col("owner").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", F.col("run_leaves").alias("n_leaves"),
                         F.col("run_saved").alias("saved_tokens"), "ends_sha256")
