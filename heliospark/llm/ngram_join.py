"""Similarity self-join of documents on word shingles (exact Jaccard threshold), by rare-first prefix filtering.

1. One scan sums how many documents hold each shingle, in a table of fixed size over shingle hashes, and writes each
   document's set size, set hash and range histogram. Documents with equal sets form a class.
2. A second scan orders each set rare-first (by that table, ties by hash: one order for all documents) and emits the
   prefix that any similar set must meet. A task emits a class once, so a large group of copies is reduced before the
   shuffle.
3. Prefix entries meet by shingle. Within a shingle's group each class is paired with the group's first and with its
   neighbour in size; length and position bounds drop pairs. Remaining pairs are distinct, pass the suffix bound and are
   verified once on the whole texts. Only texts of such pairs are shuffled: a bit filter of fixed size drops most others.
4. Links so far give components. Only shingle groups that still span several components can hide a link that matters:
   there, pairs from different components are generated in bounded blocks and verified: first a few partners for each
   class, which joins most components, then all pairs that are left. What of a prefix no other prefix
   shares bounds a document's overlap with any that is not larger, which leaves few such pairs.

Pairs inside a component that is already connected are never expanded, so a group of near copies costs a few pairs for
each member while components stay exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heliospark.llm.components import components
from heliospark.llm.files import batches_of
from heliospark.llm.shared import chunks, fresh_path, keep, mixed, only, runs_of, signed, text_key, tidy, whole_hash, word_hashes

WIDTH = 5
PERCENT = 75
TABLE_BITS = 22  # fixed: 2^22 counters, 16 MB, at every input size
SLICES = 16
RANGES = 256
HOT_GROUP = 50_000  # documents in a counter for each salt of a shingle
BLOCK = 1_000  # classes that meet at once in a group that spans components
FILTER_BITS = 27  # fixed: 2^27 bits, 16 MB, at every input size
_FULL = 65_535  # a range that holds this many or more
PARTNERS = 6  # partners of a class in each shingle before all pairs are tried
SEEN_CLASSES = 500_000


def shingle_sets(column: pa.Array, width: int = WIDTH) -> Iterator[tuple[int, np.ndarray]]:
    """Row number and sorted distinct shingle hashes of each text; no words give an empty set."""
    for first, _, data, offsets in chunks(column):
        h, bounds, _ = word_hashes(data, offsets, fold=True)
        grams = runs_of(h, width)
        for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
            if b - a >= width:
                yield first + i, np.unique(grams[a:b - width + 1])
            else:
                yield first + i, whole_hash(h[a:b]) if b > a else grams[:0]


def _class_id(grams: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(grams.tobytes(), digest_size=8).digest(), "little", signed=True)


def _ranges(grams: np.ndarray) -> bytes:
    return np.minimum(np.bincount(grams >> np.uint64(56), minlength=RANGES), _FULL).astype(np.uint16).tobytes()


def suffix_fits(a: np.ndarray, b: np.ndarray, n: np.ndarray, percent: int) -> np.ndarray:
    """Whether two sets may overlap enough, by their counts in fixed hash ranges; n is the sum of both sizes."""
    out = np.empty(len(a), bool)
    for s in range(0, len(a), 20_000):
        x, y = a[s:s + 20_000], b[s:s + 20_000]
        out[s:s + 20_000] = np.minimum(x, y).sum(1, dtype=np.int64) * (100 + percent) >= percent * n[s:s + 20_000]
        out[s:s + 20_000] |= (x == _FULL).any(1) | (y == _FULL).any(1)
    return out


def prefix_length(n: int, percent: int) -> int:
    return n - -(-n * percent // 100) + 1


_SKETCH = "doc_id long, tkey long, cls long, n long, ranges binary, slice int, counts binary"


def _sketch(width: int):
    @tidy
    def run(batches):
        counts = np.zeros(1 << TABLE_BITS, np.int32)
        schema = pa.schema([("doc_id", pa.int64()), ("tkey", pa.int64()), ("cls", pa.int64()), ("n", pa.int64()),
                            ("ranges", pa.binary()), ("slice", pa.int32()), ("counts", pa.binary())])
        for batch in batches:
            sets = [g for _, g in shingle_sets(batch.column("text"), width)]
            for start in range(0, len(sets), 256):
                part = [g for g in sets[start:start + 256] if len(g)]
                if part:
                    slots, found = np.unique(np.concatenate(part) >> np.uint64(64 - TABLE_BITS), return_counts=True)
                    counts[slots] += found.astype(np.int32)
            nothing = [None] * len(sets)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("tkey"),
                pa.array([_class_id(g) if len(g) else None for g in sets], pa.int64()),
                pa.array([len(g) for g in sets], pa.int64()), pa.array([_ranges(g) for g in sets], pa.binary()),
                pa.array(nothing, pa.int32()), pa.array(nothing, pa.binary())], schema=schema)
        none = pa.array([None], pa.int64())
        for i, piece in enumerate(np.split(counts, SLICES)):
            if piece.any():
                yield pa.RecordBatch.from_arrays([none, none, none, none, pa.array([None], pa.binary()), pa.array([i], pa.int32()),
                                                  pa.array([piece.tobytes()], pa.binary())], schema=schema)
    return run


def _add_counts(kind):
    """Partial sums of the counters that one task reads."""
    def run(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                part = np.frombuffer(blob.as_py(), kind)
                total[i] = total[i] + part if i in total else part.astype(np.int64)
        for i, part in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=["slice", "counts"])
    return run


def frequencies(sketch: DataFrame) -> str:
    """Documents of each counter, summed by tasks into a table of fixed size in the shared folder, for tasks to read: its path."""
    rows = sketch.where("slice IS NOT NULL").select("slice", "counts")
    rows = rows.mapInArrow(_add_counts(np.int32), "slice int, counts binary").repartition(SLICES, "slice").mapInArrow(_add_counts(np.int64), "slice int, counts binary")
    path = fresh_path(sketch.sparkSession, "frequencies")
    rows.write.parquet(path)
    return path


def read_frequencies(path: str) -> np.ndarray:
    counts = np.zeros((SLICES, (1 << TABLE_BITS) // SLICES), np.int32)
    for batch in batches_of(path):
        for i, blob in zip(batch.column("slice").to_pylist(), batch.column("counts")):
            counts[i] = np.minimum(np.frombuffer(blob.as_buffer(), np.int64), 2**31 - 1)
    return counts.reshape(-1)


_POSTING = "token long, salt int, cls long, n int, pos int"


def _prefixes(path: str, width: int, percent: int):
    @tidy
    def run(batches):
        table = read_frequencies(path)
        rank = np.empty(len(table), np.uint16)
        for at in range(0, len(table), 1 << 16):
            rank[at:at + (1 << 16)] = np.log2(1.0 + table[at:at + (1 << 16)]) * 256
        seen: set[int] = set()
        low = np.uint64((1 << 48) - 1)
        for batch in batches:
            out: list[tuple] = []
            held = 0
            for _, grams in shingle_sets(batch.column("text"), width):
                if not len(grams):
                    continue
                cls = _class_id(grams)
                if cls in seen:
                    continue
                if len(seen) < SEEN_CLASSES:
                    seen.add(cls)
                slot = grams >> np.uint64(64 - TABLE_BITS)
                key = rank[slot].astype(np.uint64) << np.uint64(48) | (grams & low)
                size = prefix_length(len(grams), percent)
                if size < len(key):
                    first = np.argpartition(key, size - 1)[:size]
                    first = first[np.argsort(key[first])]
                else:
                    first = np.argsort(key)
                salt = table[slot[first]].astype(np.int64) // HOT_GROUP + 1
                salt = np.where(salt > 1, cls % salt, -1)
                out.append((key[first], salt, cls, len(grams)))
                held += len(first)
                if held > 200_000:
                    yield _posting_batch(out)
                    out, held = [], 0
            if out:
                yield _posting_batch(out)
    return run


def _posting_batch(out):
    sizes = [len(k) for k, _, _, _ in out]
    return pa.RecordBatch.from_arrays([
        pa.array(signed(np.concatenate([k for k, _, _, _ in out]))),
        pa.array(np.concatenate([s for _, s, _, _ in out]).astype(np.int32)),
        pa.array(np.repeat(np.array([c for _, _, c, _ in out], np.int64), sizes)),
        pa.array(np.repeat(np.array([n for _, _, _, n in out], np.int32), sizes)),
        pa.array(np.concatenate([np.arange(s, dtype=np.int32) for s in sizes]))],
        names=["token", "salt", "cls", "n", "pos"])


def may_reach(n1, p1, n2, p2, percent: int):
    """Length and position bounds for two prefix entries of one shingle."""
    small, large = np.minimum(n1, n2), np.maximum(n1, n2)
    best = np.minimum(p1, p2) + np.minimum(n1 - p1, n2 - p2)
    return (small * 100 >= large * percent) & (best * (100 + percent) >= percent * (n1 + n2))


_CANDIDATE = "kind int, token long, salt int, a long, b long, n int, pos int"


def _columns(table: pa.Table | pa.RecordBatch) -> dict[str, np.ndarray]:
    def values(column):
        if pa.types.is_binary(column.type):
            return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, RANGES)
        return column.to_numpy(zero_copy_only=False)
    return {name: values(table.column(name)) for name in table.schema.names}


def _whole_groups(batches, keys: tuple[str, ...]):
    """Columns of sorted rows, cut only where a group ends."""
    held: dict[str, np.ndarray] | None = None
    for batch in batches:
        now = _columns(batch)
        if not len(now[keys[0]]):
            continue
        if held is not None:
            now = {k: np.concatenate([held[k], v]) for k, v in now.items()}
        last = np.ones(len(now[keys[0]]), bool)
        for k in keys:
            last &= now[k] == now[k][-1]
        cut = int(np.argmax(last))  # sorted: the last group is the tail
        if cut:
            yield {k: v[:cut] for k, v in now.items()}
        held = {k: v[cut:] for k, v in now.items()}
    if held is not None:
        yield held


def _group_starts(columns: dict[str, np.ndarray], keys: tuple[str, ...]) -> np.ndarray:
    new = np.ones(len(columns[keys[0]]), bool)
    new[1:] = False
    for k in keys:
        new[1:] |= columns[k][1:] != columns[k][:-1]
    return np.flatnonzero(new)


def _meet(percent: int):
    """Pair the members of each shingle's group with its first member and with their neighbours in size."""
    keys = ("token", "salt")

    def run(batches):
        for c in _whole_groups(batches, keys):
            again = np.zeros(len(c["token"]), bool)  # a class that several tasks emitted
            again[1:] = (c["token"][1:] == c["token"][:-1]) & (c["salt"][1:] == c["salt"][:-1]) & (c["cls"][1:] == c["cls"][:-1])
            c = {k: v[~again] for k, v in c.items()}
            starts = _group_starts(c, keys)
            sizes = np.diff(np.append(starts, len(c["token"])))
            group = np.repeat(np.arange(len(starts)), sizes)
            many = sizes[group] > 1
            c["n"], c["pos"] = c["n"].astype(np.int64), c["pos"].astype(np.int64)
            member = np.flatnonzero(many)
            order = member[np.lexsort((c["cls"][member], c["n"][member], group[member]))]
            follows = group[order[1:]] == group[order[:-1]]
            x = np.concatenate([member, order[1:][follows]])
            y = np.concatenate([starts[group[member]], order[:-1][follows]])
            fits = (x != y) & may_reach(c["n"][x], c["pos"][x], c["n"][y], c["pos"][y], percent)
            x, y = x[fits], y[fits]
            pairs = np.unique(np.stack([np.minimum(c["cls"][x], c["cls"][y]), np.maximum(c["cls"][x], c["cls"][y])]), axis=1)
            opened = np.flatnonzero((sizes[group] > 2) | (c["salt"] >= 0))
            heads = starts[c["salt"][starts] >= 0]
            yield _candidate_batch(1, pairs.shape[1], a=pairs[0], b=pairs[1])
            shared, times = np.unique(c["cls"][many | (c["salt"] >= 0)], return_counts=True)
            yield _candidate_batch(4, len(shared), a=shared, n=times)
            for kind, rows in ((2, opened), (3, heads)):
                yield _candidate_batch(kind, len(rows), token=c["token"][rows], salt=c["salt"][rows], a=c["cls"][rows],
                                       n=c["n"][rows], pos=c["pos"][rows])
    return run


def _candidate_batch(kind: int, size: int, **values):
    types = (("kind", np.int32), ("token", np.int64), ("salt", np.int32), ("a", np.int64), ("b", np.int64), ("n", np.int32), ("pos", np.int32))
    values["kind"] = np.full(size, kind)
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(values.get(k, np.zeros(size))).astype(t)) for k, t in types],
                                      names=[k for k, _ in types])


def _cross(percent: int):
    """All pairs from different components in a block pair of a group."""
    keys = ("token", "i", "j")

    def run(batches):
        for c in _whole_groups(batches, keys):
            c["n"], c["pos"] = c["n"].astype(np.int64), c["pos"].astype(np.int64)
            starts = _group_starts(c, keys)
            found = []
            for s, e in zip(starts, np.append(starts[1:], len(c["token"]))):
                rows = np.arange(s, e)
                left, right = rows[c["own"][rows] == c["i"][s]], rows[c["own"][rows] == c["j"][s]]
                if not len(left) or not len(right):
                    continue
                x, y = (g.reshape(-1) for g in np.meshgrid(left, right, indexing="ij"))
                fits = _bounded(c, x, y, percent)
                found.append(np.stack([np.minimum(c["a"][x[fits]], c["a"][y[fits]]), np.maximum(c["a"][x[fits]], c["a"][y[fits]])]))
            if found:
                pairs = np.unique(np.concatenate(found, axis=1), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])
    return run


def _bounded(c, x, y, percent: int) -> np.ndarray:
    """Whether two entries of one shingle, from different components, may link."""
    fits = (c["comp"][x] != c["comp"][y]) & may_reach(c["n"][x], c["pos"][x], c["n"][y], c["pos"][y], percent)
    # the larger set's bound only: what of its prefix lies in the smaller's suffix is less than that suffix, which is no longer than its own
    larger = np.where(c["n"][x] > c["n"][y], x, y)
    most = np.where(c["n"][x] == c["n"][y], np.minimum(c["most"][x], c["most"][y]), c["most"][larger])
    fits &= most * (100 + percent) >= percent * (c["n"][x] + c["n"][y])
    left = np.flatnonzero(fits)
    for at in np.split(left, range(20_000, len(left), 20_000)):  # ranges are half a kilobyte: only some pairs' at once
        fits[at] = suffix_fits(c["ranges"][x[at]], c["ranges"][y[at]], c["n"][x[at]] + c["n"][y[at]], percent)
    return fits


def _some(percent: int, partners: int):
    """Pair each member of a block with its next few members, in an order that differs from shingle to shingle."""
    keys = ("token", "own")

    def run(batches):
        for c in _whole_groups(batches, keys):
            c["n"], c["pos"] = c["n"].astype(np.int64), c["pos"].astype(np.int64)
            starts = _group_starts(c, keys)
            group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(c["token"]))))
            order = np.lexsort((mixed(c["a"].view(np.uint64) ^ mixed(c["token"].view(np.uint64))), group))
            found = []
            for off in range(1, partners + 1):
                x, y = order[off:], order[:-off]
                fits = (group[x] == group[y]) & _bounded(c, x, y, percent)
                found.append(np.stack([np.minimum(c["a"][x[fits]], c["a"][y[fits]]), np.maximum(c["a"][x[fits]], c["a"][y[fits]])]))
            pairs = np.unique(np.concatenate(found, axis=1), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])
    return run


def _suffix_fits(percent: int):
    """Upper bound of the overlap from both sets' counts in fixed hash ranges."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16).reshape(-1, RANGES) for k in ("ranges_a", "ranges_b"))
            fits = suffix_fits(a, b, a.sum(1, dtype=np.int64) + b.sum(1, dtype=np.int64), percent)
            yield batch.filter(pa.array(fits)).select(["a", "b", "doc_a", "tkey_a", "doc_b", "tkey_b"])
    return run


def _verify(width: int, percent: int):
    @tidy
    def run(batches):
        for batch in batches:
            left = [g for _, g in shingle_sets(batch.column("text_a"), width)]
            right = [g for _, g in shingle_sets(batch.column("text_b"), width)]
            good = []
            for x, y in zip(left, right):
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.filter(pa.array(good, pa.bool_())).select(["a", "b"])
    return run


def _one_of_repeated(docs: DataFrame, repeated: DataFrame) -> DataFrame:
    """Rows of ``docs``, those equal in id and text once; ``repeated`` has the keys of such rows, few as a rule."""
    same = docs["doc_id"].eqNullSafe(repeated["__id"]) & (docs["tkey"] == repeated["__key"])
    return docs.join(repeated, same, "left_anti").union(docs.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "tkey"]))


def _bit(tkey: np.ndarray) -> np.ndarray:
    return tkey.view(np.uint64) >> np.uint64(64 - FILTER_BITS)


def _bits(batches):
    """Bits of the texts that one task reads, in slices without empty ones."""
    bits = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for batch in batches:
        at = _bit(batch.column("tkey").to_numpy())
        np.bitwise_or.at(bits, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
    for i, piece in enumerate(np.split(bits, SLICES)):
        if piece.any():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([piece.tobytes()], pa.binary())], names=["slice", "bits"])


def _has_bit(path: str):
    @tidy
    def run(batches):
        bits = np.zeros((SLICES, (1 << (FILTER_BITS - 3)) // SLICES), np.uint8)
        for batch in batches_of(path):
            for i, blob in zip(batch.column("slice").to_pylist(), batch.column("bits")):
                bits[i] |= np.frombuffer(blob.as_buffer(), np.uint8)
        bits = bits.reshape(-1)
        for batch in batches:
            at = _bit(batch.column("tkey").to_numpy())
            yield batch.filter(pa.array((bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)))
    return run


def with_keys(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose ``tkey`` is among ``keys``, and a few others: texts that no pair needs are dropped before a shuffle.

    The bits are set by ranges of keys and read by tasks from the shared folder.
    """
    path = fresh_path(docs.sparkSession, "filter")
    wanted = keys.select("tkey").distinct().repartition(SLICES, F.shiftrightunsigned("tkey", 60))
    wanted.mapInArrow(_bits, "slice int, bits binary").write.parquet(path)
    return docs.mapInArrow(_has_bit(path), docs.schema)


def _links(pairs: DataFrame, classes: DataFrame, docs: DataFrame, repeated: DataFrame, width: int, percent: int) -> DataFrame:
    side = lambda s: classes.select(F.col("cls").alias(s), F.col("doc_id").alias(f"doc_{s}"), F.col("tkey").alias(f"tkey_{s}"), F.col("ranges").alias(f"ranges_{s}"))
    found = pairs.distinct().join(side("a"), "a").join(side("b"), "b")
    found = keep(found.mapInArrow(_suffix_fits(percent), "a long, b long, doc_a long, tkey_a long, doc_b long, tkey_b long"), "pairs")
    texts = _one_of_repeated(with_keys(docs, found.select(F.explode(F.array("tkey_a", "tkey_b")).alias("tkey"))), repeated)

    def with_text(found, s):
        text = texts.select(F.col("doc_id").alias("__id"), F.col("tkey").alias("__key"), F.col("text").alias(f"text_{s}"))
        return found.join(text, F.col(f"doc_{s}").eqNullSafe(F.col("__id")) & (F.col(f"tkey_{s}") == F.col("__key"))).drop("__id", "__key")
    found = with_text(with_text(found, "a"), "b")
    return keep(found.select("a", "b", "text_a", "text_b").mapInArrow(_verify(width, percent), "a long, b long"), "verified")


def _spread(opened: DataFrame, labels: DataFrame, classes: DataFrame) -> DataFrame:
    """Entries of shingles whose classes the labels (a, b: its component) leave in several components, with component and block."""
    entries = keep(opened.join(labels, "a", "left").withColumn("comp", F.coalesce("b", "a")).drop("b"), "labelled")
    sizes = entries.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("size")).where("lo <> hi")
    sizes = sizes.select("token", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    entries = entries.join(sizes, "token").withColumn("own", F.pmod(F.xxhash64("a"), "blocks").cast("int"))
    return entries.join(classes.select(F.col("cls").alias("a"), "ranges"), "a")


def _labels(links: DataFrame) -> DataFrame:
    """Components as links from each node to its label, which stand for all links so far."""
    return components(links).select(F.col("node").alias("a"), F.col("label").alias("b"))


def similar_groups(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """Group documents by chains of links; two link when 100 * |A and B| >= percent * |A or B| for their shingle sets.

    ``docs`` needs ``doc_id`` and ``text``; other columns are not read. Returns one row for each input row: ``doc_id``,
    ``tkey`` (hash of the text), ``n_shingles`` and ``component_id``, the smallest doc_id reachable. Null, empty and
    blank texts have no shingle, link with nothing and are their own component; a text of fewer than ``width`` words is
    one shingle. Repeated rows, also with the same doc_id, are each returned. A row with a null doc_id links by its text
    like any other; ``component_id`` is null where no row reachable has a doc_id. An empty table gives an empty result.
    Shingles and sets are compared by 64-bit hashes.
    """
    return labelled_groups(docs, width, percent).drop("label")


def labelled_groups(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``similar_groups`` with ``label``, which tells groups apart also where they share a doc_id or have none; null without shingles."""
    spark: SparkSession = docs.sparkSession
    keyed = docs.select("doc_id", "text").withColumn("tkey", text_key())
    sketch = keep(keyed.mapInArrow(_sketch(width), _SKETCH), "sketch")
    counts = frequencies(sketch)
    per_doc = sketch.where("slice IS NULL").select("doc_id", "tkey", "cls", "n", "ranges")
    classes = keep(per_doc.where("cls IS NOT NULL").groupBy("cls").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "tkey")).alias("d"), F.min("ranges").alias("ranges"))  # a null id only if there is no other
        .select("cls", "d.doc_id", "d.tkey", "ranges"), "classes")

    several = per_doc.groupBy(F.col("doc_id").alias("__id"), F.col("tkey").alias("__key")).agg(F.count("*").alias("rows")).where("rows > 1")
    repeated = keep(several.select("__id", "__key"), "repeated")

    postings = keyed.select("text").mapInArrow(_prefixes(counts, width, percent), _POSTING)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    met = (postings.repartition(parts, "token", "salt").sortWithinPartitions("token", "salt", "cls")
           .mapInArrow(_meet(percent), _CANDIDATE))
    met = keep(met, "candidates")
    heads = met.where("kind = 3").select("token", "a")
    across = heads.join(heads.groupBy("token").agg(F.min("a").alias("b")), "token").where("a <> b")
    first = _links(met.where("kind = 1").select("a", "b").union(across.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))),
                   classes, keyed, repeated, width, percent)
    # an upper bound of the overlap with any set that is not larger; a larger one may hold more of the prefix in its suffix
    shared = met.where("kind = 4").groupBy("a").agg(F.sum("n").alias("shared"))
    prefix = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    opened = keep(met.where("kind = 2").select("token", "a", "n", "pos").join(shared, "a")
                  .withColumn("most", F.col("n") - prefix + F.col("shared")).drop("shared"), "open")
    labels = _labels(first)
    some = _spread(opened, labels, classes).select("token", "own", "a", "n", "pos", "comp", "most", "ranges")
    some = some.repartition(parts, "token", "own").sortWithinPartitions("token", "own").mapInArrow(_some(percent, PARTNERS), "a long, b long")
    second = labels.union(_links(some, classes, keyed, repeated, width, percent))
    labels = _labels(second)
    blocks = _spread(opened, labels, classes).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    blocks = blocks.select("token", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "a", "n", "pos", "comp", "most", "ranges")
    rest = (blocks.repartition(parts, "token", "i", "j").sortWithinPartitions("token", "i", "j")
            .mapInArrow(_cross(percent), "a long, b long"))
    whole = components(labels.union(_links(rest, classes, keyed, repeated, width, percent)))

    named = (classes.select("cls", "doc_id").join(whole.withColumnRenamed("node", "cls"), "cls", "left")
             .withColumn("label", F.coalesce("label", "cls")))
    least = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    of_class = named.join(least, "label").select("cls", "label", "component_id")
    return (per_doc.join(of_class, "cls", "left")
            .select("doc_id", "tkey", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), "label"))


def one_of_each(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One row of each group of similar documents, that with the smallest doc_id (ties: smallest hash of the text; a null doc_id comes last).

    Groups that share a doc_id but no link each keep a row. Documents without words are no group and all stay. All columns of ``docs`` are returned unchanged.
    """
    groups = keep(labelled_groups(docs, width, percent), "groups")
    wordless = groups.where("n_shingles = 0").select("doc_id", "tkey").distinct()
    first = groups.where("n_shingles > 0").groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "tkey")).alias("k")).select("k.doc_id", "k.tkey")
    rows = groups.where("n_shingles > 0").groupBy("doc_id", "tkey").agg(F.count("*").alias("rows"))
    match = first["doc_id"].eqNullSafe(rows["doc_id"]) & (first["tkey"] == rows["tkey"])
    chosen = first.join(rows, match).select(first["doc_id"], first["tkey"], "rows").union(wordless.withColumn("rows", F.lit(1)))
    return only(docs, keep(chosen, "chosen"))
