"""Packing of tokenised documents into sequences by cutting-stock column generation.

Every document is cut at multiples of the sequence size; its last piece, shorter than a sequence, is an item. Items are
counted in length classes of ``STEP`` tokens. A linear program over patterns (how many items of each class share a
sequence) needs the fewest sequences; its columns are priced by a knapsack dynamic program on the dual values, from the
one-class patterns on until no column is worth more than a sequence. Whole multiples of each pattern are taken; the
fractions that remain, a few sequences per class, are filled by bounded knapsacks over what is left. Items are ranked
within their class, and a pattern holds a range of ranks of each class, so every item finds its sequence by itself.

Only the histogram (one row per class) reaches the driver and only the ranges of ranks are sent to tasks; neither grows
with the documents.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heliospark.llm.runs import running
from heliospark.llm.shared import keep, small_batches, text_key
from heliospark.llm.token_counts import default_ranks, encoder

SIZE = 2048
STEP = 8
END = 1
GAP = 3e-4  # the program stops this close to a bound on its value, or half a sequence


def knapsack(weights: np.ndarray, values: np.ndarray, size: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of items within ``size``, and how often it holds each item."""
    best, chosen = np.zeros(size + 1), np.full(size + 1, -1)
    fitting = np.searchsorted(weights, np.arange(size + 1), "right")
    for room, n in enumerate(fitting.tolist()):
        best[room] = best[room - 1] if room else 0
        if n:
            worth = best[room - weights[:n]]
            worth += values[:n]
            i = worth.argmax()
            if worth[i] > best[room] + 1e-12:
                best[room], chosen[room] = worth[i], i
    counts, room = np.zeros(len(weights), np.int64), size
    while room > 0:
        if chosen[room] < 0:
            room -= 1
        else:
            counts[chosen[room]] += 1
            room -= weights[chosen[room]]
    return float(best[size]), counts


def column_generation(weights: np.ndarray, demand: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (one per column) and how often to use each, fractions allowed, to hold ``demand`` in the fewest sequences.

    Revised simplex: the basis starts with one-class patterns, a priced pattern enters, the pattern with the least ratio
    leaves. Demands are moved apart by a trifle, which keeps degenerate steps from cycling.
    """
    n = len(weights)
    fit = size // weights
    patterns, inverse = np.diag(fit).astype(np.int64), np.diag(1.0 / fit)
    moved = demand * (1 + 1e-7 * np.random.default_rng(13).random(n))
    used = inverse @ moved
    while True:
        worth, column = knapsack(weights, inverse.sum(axis=0), size)
        total = used.sum()
        bound = max(total / worth, weights @ moved / size)
        if worth <= 1 + 1e-9 or total - bound < max(0.5, GAP * total):
            return patterns, inverse @ demand
        direction = inverse @ column
        rising = direction > 1e-9
        ratios = np.where(rising, used / np.where(rising, direction, 1), np.inf)
        leaves = int(ratios.argmin())
        step = ratios[leaves]
        used = np.maximum(used - step * direction, 0)
        used[leaves] = step
        row = inverse[leaves] / direction[leaves]
        inverse -= np.outer(direction, row)
        inverse[leaves] = row
        patterns[:, leaves] = column


def fullest(weights: np.ndarray, left: np.ndarray, size: int) -> np.ndarray:
    """Items at hand, the largest one among them, that fill a sequence as far as any such choice does."""
    first = int(np.flatnonzero(left)[-1])
    counts = np.zeros(len(weights), np.int64)
    counts[first] = 1
    room = size - int(weights[first])
    have = left - counts
    reached, how = np.zeros(room + 1, bool), [None] * (room + 1)
    reached[0] = True
    for i in np.flatnonzero(have)[::-1]:
        copies, k = min(int(have[i]), room // int(weights[i])), 1
        while copies > 0 and not reached[room]:
            k = min(k, copies)
            shift = k * int(weights[i])
            new = np.zeros(room + 1, bool)
            new[shift:] = reached[:room + 1 - shift]
            new &= ~reached
            for at in np.flatnonzero(new):
                how[at] = i, k
            reached |= new
            copies, k = copies - k, 2 * k
    at = int(np.flatnonzero(reached)[-1])
    while at:
        i, k = how[at]
        counts[i] += k
        at -= k * int(weights[i])
    return counts


def packing_plan(demand: dict[int, int], size: int) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """Patterns (item weights, how often each) and how many sequences take each; together they hold exactly ``demand``."""
    weights = np.array(sorted(w for w, n in demand.items() if n), np.int64)
    if not len(weights):
        return []
    left = np.array([demand[int(w)] for w in weights], np.int64)
    patterns, used = column_generation(weights, left.astype(float), size)
    plan = []

    def take(counts, times):
        nonlocal left
        held = np.flatnonzero(counts)
        times = min(times, int((left[held] // counts[held]).min()))
        if times > 0:
            plan.append((weights[held], counts[held], times))
            left = left - times * counts
    for i in np.argsort(-used, kind="stable"):
        take(patterns[:, i], int(used[i] + 1e-6))
    for i in np.argsort(-(used % 1), kind="stable"):
        if weights @ patterns[:, i] == size:
            take(patterns[:, i], 1)
    while left.any():
        take(fullest(weights, left, size), 1 << 62)
    return plan


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _tokenised(ranks_path: str, size: int, end: int):
    """Per document: tokens with the closing id, digests of its whole pieces and of its last one."""
    def run(batches):
        encoding = encoder(ranks_path)[0]
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                ids = np.append(encoding.encode_to_numpy(text or "", allowed_special="all"), np.uint32(end))
                whole = len(ids) // size
                out.append((len(ids), [_crc(ids[i * size:(i + 1) * size]) for i in range(whole)], _crc(ids[whole * size:])))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tkey"), pa.array([o[0] for o in out], pa.int64()),
                                              pa.array([o[1] for o in out], pa.list_(pa.int64())), pa.array([o[2] for o in out], pa.int64())],
                                             names=["doc_id", "tkey", "doc_tokens", "whole_crcs", "last_crc"])
    return run


_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, slot long"


def _ranges(plan) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Ranges of ranks in ascending order of (class, first rank): key, and (items a sequence, first sequence, first slot) of each; sequences in all."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for weights, counts, times in plan:
        slot = 0
        for w, n in zip(weights.tolist(), counts.tolist()):
            rows.append((w << 44 | used.get(w, 0), n, sequence, slot))
            used[w] = used.get(w, 0) + n * times
            slot += n
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return table[:, 0], table[:, 1:], np.array(sorted(used)), sequence


def _assigned(plan, first_whole: dict[int, int], size: int):
    keys, found, _, _ = _ranges(plan)

    def run(batches):
        for batch in batches:
            doc, tokens, last = batch.column("doc_id"), batch.column("doc_tokens").to_numpy(), batch.column("last_crc").to_numpy()
            cls, rank = batch.column("cls").to_numpy(), batch.column("position").to_numpy() - 1
            wholes, after = tokens // size, batch.column("run_wholes").to_numpy()
            rest = np.flatnonzero(cls)
            at = np.searchsorted(keys, cls[rest] << 44 | rank[rest], "right") - 1
            n, sequence, slot = found[at].T if len(rest) else np.zeros((3, 0), np.int64)
            inside = rank[rest] - (keys[at] & (1 << 44) - 1 if len(rest) else 0)
            start = wholes[rest] * size
            yield pa.RecordBatch.from_arrays([doc.take(pa.array(rest)), *map(pa.array, (
                start, tokens[rest] - start, last[rest], tokens[rest], sequence + inside // np.maximum(n, 1), slot + inside % np.maximum(n, 1)))],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "slot"])
            full = np.repeat(np.arange(len(cls)), wholes)
            if len(full):
                index = np.arange(len(full)) - np.repeat(np.cumsum(wholes) - wholes, wholes)
                base = np.array([first_whole[int(c)] for c in cls], np.int64) + after - wholes
                crcs = batch.column("whole_crcs").flatten().to_numpy()
                yield pa.RecordBatch.from_arrays([doc.take(pa.array(full)), *map(pa.array, (
                    index * size, np.full(len(full), size), crcs, tokens[full], base[full] + index, np.zeros(len(full), np.int64)))],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "slot"])
    return run


def pack(docs: DataFrame, ranks_path: str | None = None, size: int = SIZE, end: int = END, step: int = STEP) -> DataFrame:
    """Place every token id of every document in a sequence of at most ``size`` ids.

    A document's ids are those of its whole text (null: empty), strings of special tokens counting as that token, then ``end``.
    Returns per piece: ``doc_id``, ``start`` (ids of its document before it), ``length``, ``ids_crc32`` (of its ids as unsigned
    little-endian 32-bit numbers), ``doc_tokens`` (with ``end``), ``sequence_id`` (from 0, gapless) and ``offset`` (in its
    sequence, gapless from 0). Documents are cut only at multiples of ``size``; a sequence is filled to within ``step - 1`` ids
    per piece as far as the linear program can, and only the last few sequences are emptier.

    Only ``doc_id`` and ``text`` are read. Repeated rows, also with one id or a null id, are each packed; their pieces cannot
    be told apart where the rows are equal. Empty texts have the one id ``end``. An empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    if size % step:
        raise ValueError("size must be a multiple of step")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("tkey"), "text")
    tokens = rows.mapInArrow(_tokenised(ranks_path or default_ranks(), size, end),
                             "doc_id long, tkey long, doc_tokens long, whole_crcs array<long>, last_crc long")
    rest = F.col("doc_tokens") % size
    items = keep(tokens.withColumns({"cls": F.floor((rest + step - 1) / step), "wholes": F.floor(F.col("doc_tokens") / size)}), "packing-items")
    histogram = items.groupBy("cls").agg(F.count("*").alias("n"), F.sum("wholes").alias("wholes")).orderBy("cls").collect()
    plan = packing_plan({r.cls: r.n for r in histogram if r.cls}, size // step)
    at, first_whole = sum(times for _, _, times in plan), {}
    for r in histogram:
        first_whole[r.cls] = at
        at += r.wholes
    ranked = running(items, "cls", ["doc_id", "tkey"], sums=("wholes",), name="packing-ranked")
    pieces = ranked.mapInArrow(_assigned(plan, first_whole, size), _PIECES)
    order = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return pieces.withColumn("offset", F.coalesce(F.sum("length").over(order), F.lit(0)).cast("long")).drop("slot")
