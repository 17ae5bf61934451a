"""Conversation repair: the cheapest edits that make turns alternate, by a Viterbi whose chunks run in parallel.

An automaton of four states (nothing yet, after a system turn, after a user turn, after an assistant turn) reads the repaired
roles. Backward costs, the cheapest way from a state at a row to the end, need the row after. Rows are dealt to tasks in
ranges and cut into chunks; every chunk starts from a speculative vector of costs at its end. Fix-up passes hand each chunk
the vector found at the start of the next and run it again until its vectors differ from the earlier ones by a constant only,
which leaves everything before unchanged; in practice a few rows. When no chunk changes any more, vectors are right up to
a constant, and constants do not change a choice: each chunk says where it ends from each state it may be entered in, these
maps are composed along the conversation, and every chunk traces its own part of the least audit among the cheapest.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heliospark.llm.runs import by_range, changes, plain, running
from heliospark.llm.shared import keep, small_batches

CHUNK = 128
BLANKS = " \t\n\x0b\x0c\r"
RENAME, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
CLEAN, BLANK, DUPLICATE, CUT, ABSENT = range(5)
_FAR = 1 << 40
_GO = np.array([2, 2, 3, 2])  # the one state that an added or renamed turn can lead to
_NEXT = np.array([[1, 4, 4, 4], [2, 2, 4, 2], [4, 4, 3, 4], [4, 4, 4, 4]])  # by initial (s, u, a, other) and state; 4: not allowed
_END = np.array([0, 2 * INSERT, INSERT, 0])
_ROLE = {2: "user", 3: "assistant"}
_LEGAL = {(0, 1), (1, 2), (2, 1)}


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows after damage (conv_id, turn, role, text, copies); a dropped row stays as one without role, text and copies."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    code, text = F.crc32(key) % 20, F.coalesce("text", space)
    stays = code != 0
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.when(stays, F.col("turn").cast("long")).alias("turn"),
        F.when(stays, F.when(code == 4, "user").otherwise(F.coalesce("role", space))).alias("role"),
        F.when(stays, F.when(code == 1, "").when(code == 2, F.translate(text, ".!?", "")).otherwise(text)).alias("text"),
        F.when(code == 0, 0).when(code == 3, 2).otherwise(1).cast("long").alias("copies"))


def _code() -> Column:
    """Initial of the role in two bits, fault above them."""
    first = F.substring("role", 1, 1)
    trimmed = F.rtrim("text", F.lit(BLANKS))
    initial = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    fault = (F.when(F.col("role").isNull(), ABSENT).when(trimmed == "", BLANK).when(F.col("later"), DUPLICATE)
             .when(~F.substring(trimmed, -1, 1).isin(".", "!", "?"), CUT).otherwise(CLEAN))
    return (initial + 4 * fault).cast("byte")


def _rows(conversations: DataFrame) -> DataFrame:
    """Distinct rows of each conversation with their copies and faults; equal rows meet before they travel."""
    rows = damaged(conversations).groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    rows = keep(rows.withColumn("digest", F.sha2("text", 256)), "repair-rows")
    when = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    seen = rows.where("role IS NOT NULL").groupBy(F.col("conv_id").alias("__c"), F.col("role").alias("__r"), F.col("digest").alias("__d")).agg(
        F.count("*").alias("__n"), F.min(when).alias("__first")).where("__n > 1")
    same = F.col("conv_id").eqNullSafe(F.col("__c")) & (F.col("role") == F.col("__r")) & (F.col("digest") == F.col("__d"))
    later = F.col("__first").isNotNull() & ~F.col("turn").eqNullSafe(F.col("__first.turn"))
    return rows.join(seen, same, "left").withColumn("later", later).select("conv_id", "turn", "role", "text", "copies", _code().alias("code"))


_CHUNKS = "conv_id long, part int, idx long, whole boolean, turns array<long>, codes array<tinyint>, copies array<long>, roles array<string>, texts array<string>"


def _chunks(size: int):
    """Cut sorted rows into chunks; ``whole`` where a conversation surely has this chunk only."""
    def run(batches):
        from pyspark import TaskContext
        part, idx = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            starts = np.flatnonzero(changes(*plain(batch.column("conv_id")), None))
            long = np.diff(np.append(starts, n))
            inner = np.arange(n) - np.repeat(starts, long)
            cuts = np.flatnonzero(inner % size == 0)
            run_of = np.searchsorted(starts, cuts, "right") - 1
            whole = (run_of > 0) & (run_of < len(starts) - 1) & (long[run_of] <= size)
            offsets = pa.array(np.append(cuts, n), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, batch.column(c)) for c in ("turn", "code", "copies", "role", "text")]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id").take(pa.array(cuts)), pa.array(np.full(len(cuts), part, np.int32)),
                                              pa.array(np.arange(idx, idx + len(cuts))), pa.array(whole), *lists],
                                             names=["conv_id", "part", "idx", "whole", "turns", "codes", "copies", "roles", "texts"])
            idx += len(cuts)
    return run


def _grid(column: pa.Array, fill: int) -> np.ndarray:
    """Lists as rows of a matrix."""
    sizes = np.array(column.value_lengths().to_numpy(zero_copy_only=False))
    out = np.full((len(sizes), max(int(sizes.max()), 1) if len(sizes) else 1), fill, np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _moves(h: np.ndarray, code: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Costs of deleting, keeping and renaming a row, by state, given the costs ``h`` after it."""
    initial, fault = code & 3, code >> 2
    here = (more + np.where(fault == CUT, TRUNCATED, 0))[:, None]
    forced = ((fault == BLANK) | (fault == DUPLICATE))[:, None]
    beyond = np.concatenate([h, np.full((len(h), 1), _FAR)], axis=1)
    kept = np.where(forced, _FAR, here + np.take_along_axis(beyond, _NEXT[initial], axis=1))
    renamed = np.where(forced, _FAR, here + RENAME + h[:, _GO])
    return DELETE + more[:, None] + h, kept, renamed


def _before(h: np.ndarray, code: np.ndarray, more: np.ndarray) -> np.ndarray:
    """Costs before a row; turns may be added ahead of it."""
    best = np.minimum.reduce(_moves(h, code, more))
    for _ in range(2):
        best = np.minimum(best, INSERT + best[:, _GO])
    return np.where((code >> 2 == ABSENT)[:, None], h, best)


def backward(codes: np.ndarray, copies: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Costs before each row (chunk, row, state) and, last, at the end."""
    n, width = codes.shape
    out = np.empty((n, width + 1, 4), np.int64)
    out[:, width] = end
    for j in range(width - 1, -1, -1):
        out[:, j] = _before(out[:, j + 1], codes[:, j], DELETE * (copies[:, j] - 1))
    return out


def trace(costs: np.ndarray, codes: np.ndarray, copies: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Least letters among the cheapest moves: added turns before each row, the row's letter (0: absent) and the last state."""
    n, width = codes.shape
    added, letters, each = np.zeros((n, width), np.int64), np.zeros((n, width), np.uint8), np.arange(n)
    for j in range(width):
        now, live = costs[:, j], codes[:, j] >> 2 != ABSENT
        drop, kept, renamed = _moves(costs[:, j + 1], codes[:, j], DELETE * (copies[:, j] - 1))
        for _ in range(2):
            want = now[each, state]
            add = live & (drop[each, state] != want) & (INSERT + now[each, _GO[state]] == want)
            added[:, j] += add
            state = np.where(add, _GO[state], state)
        want = now[each, state]
        deleted, keeps = drop[each, state] == want, kept[each, state] == want
        letters[:, j] = np.where(live, np.where(deleted, ord("D"), np.where(keeps, ord("K"), ord("R"))), 0)
        moved = np.where(keeps, _NEXT[codes[:, j] & 3, state], _GO[state])
        state = np.where(live & ~deleted, moved, state)
    return added, letters, state


def _vector(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), np.int64).reshape(-1, 4)


def _vectors(values: np.ndarray) -> pa.Array:
    return pa.array((values - values.min(axis=1, keepdims=True)).tolist() if len(values) else [], pa.list_(pa.int64()))


def _fix_up(batches):
    """Run chunks whose end vector has changed (``target``), until the new vectors differ from the old by constants."""
    for batch in batches:
        end, target, start = (_vector(batch.column(c)) for c in ("end", "target", "start"))
        stale = np.flatnonzero((end != target).any(axis=1) | (start < 0).any(axis=1))
        if len(stale):
            some = batch.take(pa.array(stale))
            codes, copies = _grid(some.column("codes"), 4 * ABSENT), _grid(some.column("copies"), 1)
            fresh, old, live = target[stale], end[stale], np.ones(len(stale), bool)
            unknown = (start[stale] < 0).any(axis=1)
            for j in range(codes.shape[1] - 1, -1, -1):
                more = DELETE * (copies[live, j] - 1)
                fresh[live], old[live] = _before(fresh[live], codes[live, j], more), _before(old[live], codes[live, j], more)
                apart = fresh - old
                live &= unknown | (apart != apart[:, :1]).any(axis=1)
                if not live.any():
                    break
            start[stale[live]] = fresh[live]
        names = [n for n in batch.schema.names if n not in ("end", "target", "start")]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), _vectors(target), _vectors(start)], names=[*names, "end", "start"])


def _exits(batches):
    """Where a chunk ends, from each state it may be entered in."""
    for batch in batches:
        codes, copies, end = _grid(batch.column("codes"), 4 * ABSENT), _grid(batch.column("copies"), 1), _vector(batch.column("end"))
        costs, out = backward(codes, copies, end), np.zeros(len(codes), np.int64)
        for s in range(4):
            out |= trace(costs, codes, copies, np.full(len(codes), s))[2] << 2 * s
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("part"), batch.column("idx"), batch.column("seq"), batch.column("end"), pa.array(out)],
                                         names=["conv_id", "part", "idx", "seq", "end", "exits"])


_COUNTS = ("blank", "duplicate", "truncated", "illegal", "cost")
_FIELDS = ("low", "high", "turns", "first_initial", "last_initial", *_COUNTS, "audit", "parts", "repaired")
_SUMMARY = "conv_id long, seq long, low long, high long, turns long, first_initial int, last_initial int, " + ", ".join(f"{c} long" for c in _COUNTS) + ", audit string, parts long, repaired string"
RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _added(state: int, n: int, out: list[str]) -> int:
    for _ in range(n):
        state = int(_GO[state])
        out.append(_ROLE[state] + ":")
    return state


def _summaries(batch, end: np.ndarray, entry: np.ndarray, last: np.ndarray):
    """What a chunk adds to its conversation."""
    grids = codes, copies = _grid(batch.column("codes"), 4 * ABSENT), _grid(batch.column("copies"), 1)
    added, letters, exits = trace(backward(*grids, end), *grids, entry)
    columns = (batch.column(c).to_pylist() for c in ("turns", "roles", "texts"))
    for i, (turns, roles, texts) in enumerate(zip(*columns)):
        state, audit, lines, before, first, found = int(entry[i]), [], [], None, None, dict.fromkeys(_COUNTS, 0)
        for j, (role, text) in enumerate(zip(roles, texts)):
            if role is None:
                continue
            code, n = int(codes[i, j]), int(copies[i, j])
            initial, fault, letter = code & 3, code >> 2, chr(letters[i, j])
            found["blank"] += n * (fault == BLANK)
            found["duplicate"] += n if fault == DUPLICATE else n - 1 if fault != BLANK else 0
            found["truncated"] += fault == CUT
            found["illegal"] += n - 1 + (before is not None and (before, initial) not in _LEGAL)
            found["cost"] += INSERT * int(added[i, j]) + DELETE * (n - 1) + (DELETE if letter == "D" else TRUNCATED * (fault == CUT) + RENAME * (letter == "R"))
            state = _added(state, int(added[i, j]), lines)
            audit.append("I" * int(added[i, j]) + letter + "D" * (n - 1))
            if letter == "K":
                state = int(_NEXT[initial, state])
                lines.append(f"{role}:{text}")
            elif letter == "R":
                state = int(_GO[state])
                lines.append(f"{_ROLE[state]}:{text}")
            before, first = initial, initial if first is None else first
        if last[i]:
            n = int(_END[state]) // INSERT
            _added(state, n, lines)
            audit.append("I" * n)
            found["cost"] += INSERT * n
        known = sorted({t for t in turns if t is not None})
        yield (known[0] if known else None, known[-1] if known else None, len(known), first, before, *found.values(), "".join(audit), len(lines), "\n".join(lines))


class _Conversation:
    """Chunks of one conversation put together in order; of the text only the digest is held."""

    def __init__(self, conv_id):
        self.conv_id, self.low, self.high, self.turns, self.last = conv_id, None, None, 0, None
        self.counts, self.audit, self.hash, self.parts = [0] * len(_COUNTS), [], hashlib.sha256(), 0

    def add(self, low, high, turns, first_initial, last_initial, *rest):
        *counts, audit, parts, repaired = rest
        if low is not None:
            self.turns += turns - (low == self.high)
            self.low, self.high = low if self.low is None else self.low, high
        self.counts = [a + b for a, b in zip(self.counts, counts)]
        if first_initial is not None:
            self.counts[3] += self.last is not None and (self.last, first_initial) not in _LEGAL
            self.last = last_initial
        self.audit.append(audit)
        if parts:
            self.hash.update(b"\n" * bool(self.parts) + repaired.encode())
            self.parts += parts

    def row(self):
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv_id, gaps, *self.counts, "".join(self.audit), self.hash.hexdigest())


def _result(rows: list[tuple]) -> pa.RecordBatch:
    names = ["conv_id", "gaps", *_COUNTS, "audit", "repaired_sha256"]
    types = [pa.int64()] * (2 + len(_COUNTS)) + [pa.string()] * 2
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)


def _whole(batches):
    for batch in batches:
        n, rows = batch.num_rows, []
        summaries = _summaries(batch, np.tile(_END, (n, 1)), np.zeros(n, np.int64), np.ones(n, bool))
        for conv_id, summary in zip(batch.column("conv_id").to_pylist(), summaries):
            rows.append(_Conversation(conv_id))
            rows[-1].add(*summary)
        yield _result([r.row() for r in rows])


def _parts(batches):
    types = [pa.int64()] * 3 + [pa.int32()] * 2 + [pa.int64()] * len(_COUNTS) + [pa.string(), pa.int64(), pa.string()]
    for batch in batches:
        entry, last = batch.column("entry").to_numpy(), batch.column("last").to_numpy(zero_copy_only=False)
        rows = list(_summaries(batch, _vector(batch.column("end")), entry, last))
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("seq"), *(pa.array([r[i] for r in rows], t) for i, t in enumerate(types))],
                                         names=["conv_id", "seq", *_FIELDS])


def _assembled(batches):
    current = None
    for batch in batches:
        rows = []
        for conv_id, *summary in zip(*(batch.column(c).to_pylist() for c in ("conv_id", *_FIELDS))):
            if current is None or current.conv_id != conv_id:
                if current is not None:
                    rows.append(current.row())
                current = _Conversation(conv_id)
            current.add(*summary)
        if rows:
            yield _result(rows)
    if current is not None:
        yield _result([current.row()])


def _longs(values) -> Column:
    return F.array(*(F.lit(int(v)).cast("long") for v in values))


def _converged(chunks: DataFrame) -> DataFrame:
    """Chunks (conv_id, part, idx, seq, codes, copies) with ``end``, the costs at their ends, right up to a constant."""
    small = running(chunks.select("conv_id", "part", "idx", "codes", "copies"), "conv_id", ["part", "idx"], name="repair-numbered")
    columns = ["conv_id", "part", "idx", "seq", "codes", "copies"]
    state = small.withColumnRenamed("position", "seq").select(*columns, _longs(_END).alias("end"), _longs(_END).alias("target"), _longs([-1] * 4).alias("start"))
    fields = "conv_id long, part int, idx long, seq long, codes array<tinyint>, copies array<long>, end array<long>, start array<long>"
    while True:
        state = keep(state.mapInArrow(_fix_up, fields), "repair-vectors")
        after = state.select(F.col("conv_id").alias("__c"), (F.col("seq") - 1).alias("__s"), F.col("start").alias("__start"))
        joined = state.join(after, F.col("conv_id").eqNullSafe(F.col("__c")) & (F.col("seq") == F.col("__s")), "left")
        joined = joined.select(*columns, "end", F.coalesce("__start", _longs(_END)).alias("target"), "start", F.col("__s").isNull().alias("last"))
        if joined.where("end <> target").isEmpty():
            return joined
        state = joined.drop("last")


def repair(conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Damage conversations by a fixed rule, find their faults and repair them at the least cost.

    Nulls count as one blank, in the key of the damage as in role and text. A conversation's rows are taken by turn (null first),
    ties by role and text. Returns one row per conv_id of the input, null being one too: ``gaps``, ``blank``,
    ``duplicate``, ``truncated``, ``illegal``, ``cost`` (long), ``audit`` (letters of the edits) and ``repaired_sha256``. A role
    counts by its first letter, in lower case only. Equal rows, however many, travel as one with a count. Conversations
    without rows after damage have zeros, no audit and the digest of an empty text; an empty table gives an empty result.
    Other columns do not matter. A conversation may have any number of rows; its edits are found in parallel, and only
    the digest of its repaired text, which is one running hash, passes over it in one task, chunk by chunk.
    """
    small_batches(conversations.sparkSession)
    sorted_rows = by_range(_rows(conversations), "conv_id", ["turn", "role", "text"])
    chunks = keep(sorted_rows.mapInArrow(_chunks(chunk), _CHUNKS), "repair-chunks")
    whole = chunks.where("whole").mapInArrow(_whole, RESULT)

    ends = _converged(chunks.where("NOT whole"))
    exits = running(keep(ends.mapInArrow(_exits, "conv_id long, part int, idx long, seq long, end array<long>, exits long"), "repair-exits"),
                    "conv_id", ["seq"], maps=("exits",), name="repair-states")
    exits = exits.withColumn("state", F.col("run_exits").bitwiseAND(F.lit(3)))
    before = exits.select(F.col("conv_id").alias("__c"), (F.col("seq") + 1).alias("__s"), F.col("state").alias("entry"))
    totals = exits.groupBy(F.col("conv_id").alias("__t")).agg(F.max("seq").alias("n"))
    placed = (exits.join(before, F.col("conv_id").eqNullSafe(F.col("__c")) & (F.col("seq") == F.col("__s")), "left")
              .join(totals, F.col("conv_id").eqNullSafe(F.col("__t"))))
    placed = placed.select("part", "idx", "seq", "end", F.coalesce("entry", F.lit(0)).cast("long").alias("entry"), (F.col("seq") == F.col("n")).alias("last"))
    parts = chunks.where("NOT whole").join(placed, ["part", "idx"]).mapInArrow(_parts, _SUMMARY)
    return whole.union(parts.repartition("conv_id").sortWithinPartitions("conv_id", "seq").mapInArrow(_assembled, RESULT))
