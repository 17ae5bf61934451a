"""Removal of long passages that an earlier document already holds, by prefix-partitioned suffix trees over words.

A suffix is a window start; only its first ``span`` words matter, so trees are cut at that depth.

1. Every suffix belongs to the group of the least 16-word hash among its first ``span`` words: its prefix up to that
   place has a variable length and equal suffixes share the group. Consecutive suffixes of one group form a stretch.
2. Groups met in one document only hold no repeat across documents and end here; nothing of their text is shuffled.
3. For the others, the stretches' words travel. Groups that many documents hold get a longer prefix (a second anchor
   in the key). Equal stretches are reduced to their least doc_id before the shuffle, so a passage that a third of all
   documents share costs one row for each map task.
4. Groups are counted, in suffixes of different stretches, before words travel. One beyond ``GROUP_SUFFIXES`` (a passage
   shorter than ``span`` that many documents hold among other words) is split by the longest prefix, ``span`` words: each
   suffix is then a leaf of its own, and its owner a grouped minimum that any number of tasks share.
5. A task sorts its other groups' suffixes word by word; neighbours' common prefixes (LCP) are the subtree's internal nodes.
   A node of depth ``span`` is a repeat, its least doc_id the owner. Overlapping repeats join to maximal ones.
6. Owners return to the occurrences, and words covered by a suffix with a smaller owner go.
"""

from __future__ import annotations

import hashlib
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliospark.llm.shared import chunks, keep, mixed, runs_of, signed, text_key, tidy, word_hashes

SPAN = 50
ANCHOR = 16
LARGE_GROUP = 4096  # documents of a group from which its prefix is extended
GROUP_SUFFIXES = 50_000  # suffixes of a group from which its prefixes are whole windows
TREE_WINDOWS = 150_000  # suffixes sorted at once
STRETCH = 512  # suffixes of a stretch; longer ones, of words that repeat, are cut


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    out, reach = values, 1
    while reach * 2 <= width:
        out = np.minimum(out[:-reach], out[reach:])
        reach *= 2
    if reach < width:
        out = np.minimum(out[:len(out) - (width - reach)], out[width - reach:])
    return out


def _groups(data, offsets, span: int):
    """Both anchors of every suffix, its document's row, and whether it is whole; word positions and bounds."""
    h, bounds, starts = word_hashes(data, offsets, fold=False)
    if len(h) < span:
        none = np.zeros(0, np.uint64)
        return none, none, np.zeros(0, np.int64), np.zeros(0, np.int64), starts, bounds
    anchor = min(ANCHOR, span)
    grams = runs_of(h, anchor)
    near = _sliding_min(grams, span - anchor + 1)
    far = _sliding_min(mixed(grams), span - anchor + 1)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[:len(near)]
    whole = np.flatnonzero(np.arange(len(near)) + span <= bounds[row + 1])
    return near[whole], far[whole], row[whole], whole, starts, bounds


def _anchors(span: int):
    def run(batches):
        for batch in batches:
            doc, key = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("doc_id", "tkey"))
            for first, _, data, offsets in chunks(batch.column("text")):
                near, _, row, _, _, _ = _groups(data, offsets, span)
                if len(near):
                    new = np.ones(len(near), bool)
                    new[1:] = (near[1:] != near[:-1]) | (row[1:] != row[:-1])
                    at = first + row[new]
                    yield pa.RecordBatch.from_arrays([pa.array(signed(near[new])), pa.array(doc[at]), pa.array(key[at])], names=["g", "doc_id", "tkey"])
    return run


def _stretches(span: int):
    """Words of the stretches whose group is shared, one row each."""
    def run(batches):
        for batch in batches:
            doc, key = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("doc_id", "tkey"))
            lists, long_lists = batch.column("shared"), batch.column("extended")
            for first, last, data, offsets in chunks(batch.column("text")):
                near, far, row, at, starts, bounds = _groups(data, offsets, span)
                raw, ends, out = data.tobytes(), np.append(starts, len(data)), []
                cuts = np.searchsorted(row, np.arange(last - first + 1))
                for i in range(last - first):
                    s, e = cuts[i], cuts[i + 1]
                    if s == e:
                        continue
                    n, f, p = signed(near[s:e]), far[s:e], at[s:e]
                    large = np.isin(n, np.asarray(long_lists[first + i].as_py() or [], np.int64))
                    good = large | np.isin(n, np.asarray(lists[first + i].as_py() or [], np.int64))
                    group = np.where(large, signed(mixed(n.view(np.uint64) ^ f)), n)
                    new = np.ones(len(n), bool)
                    new[1:] = (group[1:] != group[:-1]) | (good[1:] != good[:-1])
                    heads = np.flatnonzero(new)
                    for head, b in zip(heads, np.append(heads[1:], len(n))):
                        for a in range(head, b if good[head] else head, STRETCH):
                            z = min(a + STRETCH, b)
                            stop = p[z - 1] + span
                            limit = offsets[i + 1] if stop >= bounds[i + 1] else ends[stop]
                            text = b" ".join(raw[starts[p[a]]:limit].split())
                            digest = hashlib.blake2b(text, digest_size=16).digest()
                            out.append((int(group[a]), digest, text, int(z - a), int(doc[first + i]), int(key[first + i]), int(p[a] - bounds[i])))
                if out:
                    g, d, t, n, i, k, s = zip(*out)
                    yield pa.RecordBatch.from_arrays([pa.array(g, pa.int64()), pa.array(d, pa.binary()), pa.array(t, pa.binary()), pa.array(n, pa.int64()),
                                                      pa.array(i, pa.int64()), pa.array(k, pa.int64()), pa.array(s, pa.int64())],
                                                     names=["g", "stretch", "words", "suffixes", "doc_id", "tkey", "start"])
    return run


def suffix_owners(group: np.ndarray, texts: list[bytes], doc: np.ndarray, span: int) -> list[np.ndarray]:
    """For each stretch the owner (least doc_id) of every suffix, from the sorted suffixes of each group's subtree."""
    ids: dict[bytes, int] = {}
    words = [[ids.setdefault(w, len(ids)) for w in t.split()] for t in texts]
    lengths = np.array([len(w) for w in words])
    flat = np.fromiter((i for w in words for i in w), ">u4", int(lengths.sum()))
    counts = lengths - span + 1
    owner_row = np.repeat(np.arange(len(texts)), counts)
    base = np.repeat(np.cumsum(lengths) - lengths, counts)
    step = np.arange(len(owner_row)) - np.repeat(np.cumsum(counts) - counts, counts)
    suffixes = np.lib.stride_tricks.sliding_window_view(flat, span)[base + step]
    rank = np.unique(group, return_inverse=True)[1].astype(">u4")[owner_row]
    path = np.ascontiguousarray(np.column_stack([rank, suffixes]))
    order = np.argsort(path.view(f"V{path.itemsize * (span + 1)}").ravel(), kind="stable")
    path = path[order]
    differs = path[1:] != path[:-1]
    lcp = np.where(differs.any(1), differs.argmax(1) - 1, span)  # -1: another group
    node = np.flatnonzero(np.append(True, lcp < span))
    least = np.minimum.reduceat(doc[owner_row[order]], node)
    owners = np.empty(len(order), np.int64)
    owners[order] = np.repeat(least, np.diff(np.append(node, len(order))))
    return np.split(owners, np.cumsum(counts)[:-1])


def _trees(span: int):
    @tidy
    def run(batches):
        held: list[pa.Table] = []
        rows = 0

        def build(table):
            texts = table.column("words").to_pylist()
            owners = suffix_owners(table.column("g").to_numpy(), texts, table.column("doc_id").to_numpy(), span)
            return pa.RecordBatch.from_arrays([pa.array(table.column("stretch").to_pylist(), pa.binary()),
                                               pa.array([o.astype("<i8").tobytes() for o in owners], pa.binary())], names=["stretch", "owners"])

        def pieces(table, last):
            """Whole groups of about ``TREE_WINDOWS`` suffixes, and what is left; the last group may go on."""
            g = table.column("g").to_numpy()
            heads = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
            before = np.append(0, np.cumsum(table.column("suffixes").to_numpy()))[heads]
            at = 0
            while at < len(heads) - (not last):
                stop = max(at + 1, int(np.searchsorted(before, before[at] + TREE_WINDOWS, "right")) - 1)
                stop = min(stop, len(heads) - (not last))
                end = heads[stop] if stop < len(heads) else len(g)
                yield table.slice(heads[at], end - heads[at]), end
                at = stop

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(pa.Table.from_batches([batch]))
            rows += pc.sum(batch.column("suffixes")).as_py()
            if rows >= TREE_WINDOWS:
                table, done = pa.concat_tables(held).combine_chunks(), 0
                for piece, done in pieces(table, False):
                    yield build(piece)
                held = [table.slice(done)]
                rows = pc.sum(held[0].column("suffixes")).as_py()
        if rows:
            for piece, _ in pieces(pa.concat_tables(held).combine_chunks(), True):
                yield build(piece)
    return run


def _windows(span: int):
    """Digests of all windows of stretches, with their places in these."""
    names = ["window", "stretch", "place", "doc_id"]

    def batch_of(rows):
        w, s, p, d = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(w, pa.binary()), pa.array(s, pa.binary()), pa.array(p, pa.int64()), pa.array(d, pa.int64())], names=names)

    def run(batches):
        for batch in batches:
            out = []
            for stretch, text, doc in zip(*(batch.column(k).to_pylist() for k in ("stretch", "words", "doc_id"))):
                ends = list(accumulate(len(w) + 1 for w in text.split(b" ")))
                for i in range(len(ends) - span + 1):
                    window = text[ends[i - 1] if i else 0:ends[i + span - 1] - 1]
                    out.append((hashlib.blake2b(window, digest_size=16).digest(), stretch, i, doc))
                if len(out) >= TREE_WINDOWS:
                    yield batch_of(out)
                    out = []
            if out:
                yield batch_of(out)
    return run


def _owner_lists(batches):
    """Owners of a stretch's suffixes: its own least document, but for the places where another stretch has a smaller one."""
    for batch in batches:
        out = []
        for n, doc, places, owners in zip(*(batch.column(k).to_pylist() for k in ("suffixes", "doc_id", "places", "owners"))):
            own = np.full(n, doc, "<i8")
            if places:
                own[places] = owners
            out.append(own.tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("stretch"), pa.array(out, pa.binary())], names=["stretch", "owners"])


def _owners_by_window(distinct: DataFrame, span: int) -> DataFrame:
    """``stretch`` and ``owners`` of groups too large for a tree, from one grouped minimum over their windows."""
    distinct = keep(distinct.select("stretch", "words", "suffixes", "doc_id"), "large")
    windows = keep(distinct.mapInArrow(_windows(span), "window binary, stretch binary, place long, doc_id long"), "windows")
    least = windows.groupBy("window").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("top")).where("owner < top").drop("top")
    found = (windows.join(least, "window").where("owner < doc_id").groupBy("stretch")
             .agg(F.collect_list(F.struct("place", "owner")).alias("s")))
    joined = distinct.join(found, "stretch", "left").select("stretch", "suffixes", "doc_id", F.col("s.place").alias("places"), F.col("s.owner").alias("owners"))
    return joined.mapInArrow(_owner_lists, "stretch binary, owners binary")


def _covered(span: int):
    """Word intervals of an occurrence that suffixes with a smaller owner cover."""
    def run(batches):
        for batch in batches:
            out = []
            for doc, key, start, owners in zip(*(batch.column(k).to_pylist() for k in ("doc_id", "tkey", "start", "owners"))):
                gone = np.flatnonzero(np.frombuffer(owners, "<i8") < doc)
                if len(gone):
                    parts = np.split(gone, np.flatnonzero(np.diff(gone) > span) + 1)
                    out += [(doc, key, start + int(p[0]), start + int(p[-1]) + span) for p in parts]
            columns = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "tkey", "lo", "hi"])
    return run


def repeated_spans(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """Word intervals [lo, hi) of each text to remove: ``doc_id``, ``tkey``, ``lo``, ``hi``; intervals may overlap."""
    keyed = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", text_key().alias("tkey"), "text")
    anchors = keep(keyed.mapInArrow(_anchors(span), "g long, doc_id long, tkey long"), "anchors")
    shared = anchors.groupBy("g").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count("*").alias("size")).where("lo < hi")
    lists = (anchors.join(shared.select("g", "size"), "g").groupBy("doc_id", "tkey").agg(
        F.collect_set(F.when(F.col("size") <= LARGE_GROUP, F.col("g"))).alias("shared"),
        F.collect_set(F.when(F.col("size") > LARGE_GROUP, F.col("g"))).alias("extended")))
    stretches = keep(keyed.join(lists, ["doc_id", "tkey"]).mapInArrow(
        _stretches(span), "g long, stretch binary, words binary, suffixes long, doc_id long, tkey long, start long"), "stretches")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    large = keep(stretches.select("g", "stretch", "suffixes").distinct().groupBy("g").agg(F.sum("suffixes").alias("n"))
                 .where(F.col("n") > GROUP_SUFFIXES).select("g"), "large-groups")

    def distinct(of: DataFrame) -> DataFrame:
        return of.groupBy("g", "stretch", "words", "suffixes").agg(F.min("doc_id").alias("doc_id"))
    trees = (distinct(stretches.join(large, "g", "left_anti")).repartition(parts, "g").sortWithinPartitions("g")
             .mapInArrow(_trees(span), "stretch binary, owners binary"))
    if not large.isEmpty():
        trees = trees.union(_owners_by_window(distinct(stretches.join(large, "g", "left_semi")), span))
    return (stretches.select("stretch", "doc_id", "tkey", "start").join(trees, "stretch")
            .mapInArrow(_covered(span), "doc_id long, tkey long, lo long, hi long"))


def _cut(span: int):
    def run(batches):
        for batch in batches:
            texts, lows, highs = (batch.column(k) for k in ("text", "lows", "highs"))
            counts, removed, digests, kept_texts = [], [], [], []
            for text, lo, hi in zip(texts, lows, highs):
                raw = (text.as_py() or "").encode()
                words = raw.split()
                spans = sorted(zip(lo.as_py() or [], hi.as_py() or []))
                kept, at = [], 0
                for a, b in spans:
                    if a > at:
                        kept += words[at:a]
                    at = max(at, b)
                kept += words[at:]
                joined = b" ".join(kept)
                counts.append(len(words))
                removed.append(len(words) - len(kept))
                digests.append(hashlib.sha256(joined).hexdigest())
                kept_texts.append(joined.decode() if spans else text.as_py())
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in batch.schema.names if c not in ("text", "lows", "highs")] + [
                pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests), pa.array(kept_texts, pa.string())],
                names=[c for c in batch.schema.names if c not in ("text", "lows", "highs")] + ["n_words", "n_removed", "kept_sha256", "kept_text"])
    return run


def remove_repeats(docs: DataFrame, span: int = SPAN, carry: tuple[str, ...] = ()) -> DataFrame:
    """Cut every word covered by a ``span``-word window that also starts in a document with a smaller doc_id.

    ``docs`` needs ``doc_id`` and ``text``; ``carry`` names further columns to return. Returns ``doc_id``, these,
    ``n_words``, ``n_removed``, ``kept_sha256`` (of the kept words joined by one space) and ``kept_text`` (the kept words
    joined by one space where something was cut, else the text as it was, null included). Null texts have no words;
    texts shorter than the window keep all. Rows that share a doc_id do not remove words from each other; a row with a
    null doc_id neither loses words nor makes others lose any. Repeated rows are each returned; an empty table gives an
    empty result.
    """
    spans = repeated_spans(docs, span).distinct().groupBy("doc_id", "tkey").agg(F.collect_list(F.struct("lo", "hi")).alias("s"))
    spans = keep(spans.select("doc_id", "tkey", F.col("s.lo").alias("lows"), F.col("s.hi").alias("highs")), "spans")
    carried = F.struct(F.lit(0).alias("__none"), *carry).alias("carried")
    joined = docs.select("doc_id", carried, "text", text_key().alias("tkey")).join(spans, ["doc_id", "tkey"], "left").select("doc_id", "carried", "text", "lows", "highs")
    types = {f.name: f.dataType.simpleString() for f in joined.schema.fields}
    cut = joined.mapInArrow(_cut(span), f"doc_id {types['doc_id']}, carried {types['carried']}, n_words long, n_removed long, kept_sha256 string, kept_text string")
    return cut.select("doc_id", *(F.col("carried")[c].alias(c) for c in carry), "n_words", "n_removed", "kept_sha256", "kept_text")
