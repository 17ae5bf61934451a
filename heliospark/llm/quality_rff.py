"""Quality scores from document statistics: random Fourier features, ridge by summed normal equations, isotonic calibration.

Every whole text is read once into a narrow table of statistics. Each task sums the normal equations of its labelled rows,
in two folds; only these matrices of fixed size reach the driver, which solves them. Each fold is scored by the other
fold's model, these scores are counted in bins of fixed number, and pooling adjacent violators over the bins gives the
calibration of the model of both folds.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliospark.llm.shared import binary, keep, text_key

FEATURES = 256
BANDWIDTH = 4.0
RIDGE = 1e-3
BINS = 1024
SEED = 7
_LOW, _HIGH = -0.5, 1.5

_GROUPS = (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n", b"\t\r\x0b\x0c", b"!", b"?", b".", b",", b";:",
           b"#$%&*", b"|", b"<>{}[]()", b"/\\=_@+~^`", b"-'\"")
_CLASS = np.full(256, len(_GROUPS) + 1, np.int64)
_CLASS[128:] = len(_GROUPS)
for _i, _bytes in enumerate(_GROUPS):
    _CLASS[np.frombuffer(_bytes, np.uint8)] = _i
STATISTICS = len(_GROUPS) + 2 + 10


def statistics(raw: bytes) -> np.ndarray:
    """Shares of byte classes, lengths, and how much words and lines repeat; all zero for an empty text."""
    out = np.zeros(STATISTICS)
    if not raw:
        return out
    classes = len(_GROUPS) + 2
    histogram = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    out[:classes] = np.bincount(_CLASS, weights=histogram, minlength=classes) / len(raw)
    words, lines = raw.split(), [x for x in raw.split(b"\n") if x]
    n, distinct = len(words), len(set(words))
    blanks = histogram[[9, 10, 11, 12, 13, 32]].sum()
    letters = histogram[65:91].sum() + histogram[97:123].sum()
    out[classes:] = (
        np.log1p(len(raw)), np.log1p(n), (len(raw) - blanks) / max(n, 1), distinct / max(n, 1),
        np.log1p(n) - np.log1p(distinct), np.log1p(len(lines)), n / max(len(lines), 1) / 50, len(set(lines)) / max(len(lines), 1),
        histogram[65:91].sum() / max(letters, 1), histogram[46] / max(n, 1))
    return out


def _statistics(batches):
    for batch in batches:
        rows = [statistics(t.as_py()) for t in binary(batch.column("text"))]
        flat = pa.array(np.concatenate(rows) if rows else np.zeros(0))
        offsets = pa.array(np.arange(0, (len(rows) + 1) * STATISTICS, STATISTICS, dtype=np.int32))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tkey"), pa.ListArray.from_arrays(offsets, flat)], names=["doc_id", "tkey", "x"])


def _matrix(column) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), float).reshape(-1, STATISTICS)


class Map:
    """Random Fourier features of standardised statistics, and a constant."""

    def __init__(self, mean, deviation, features: int, bandwidth: float, seed: int):
        random = np.random.default_rng(seed)
        self.mean, self.scale = mean, np.where(deviation > 1e-9, deviation, 1.0)
        self.directions = random.normal(0, 1 / bandwidth, (STATISTICS, features))
        self.phases = random.uniform(0, 2 * np.pi, features)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        z = np.cos(z @ self.directions + self.phases) * np.sqrt(2 / len(self.phases))
        return np.column_stack([z, np.ones(len(z))])


def _moments(batches):
    total, count = np.zeros((2, STATISTICS)), 0
    for batch in batches:
        x = _matrix(batch.column("x"))
        total += x.sum(0), (x * x).sum(0)
        count += len(x)
    yield pa.RecordBatch.from_arrays([pa.array([0]), pa.array([np.append(total.ravel(), count).tobytes()])], names=["slot", "sums"])


def _equations(shared):
    def run(batches):
        features = shared.value
        size = len(features.phases) + 2
        sums = np.zeros((2, size, size))
        for batch in batches:
            z, y = features(_matrix(batch.column("x"))), batch.column("label").to_numpy().astype(float)
            fold = batch.column("fold").to_numpy()
            rows = np.column_stack([z, y])
            for k in (0, 1):
                part = rows[fold == k]
                sums[k] += part.T @ part
        yield pa.RecordBatch.from_arrays([pa.array([0, 1]), pa.array([s.tobytes() for s in sums])], names=["slot", "sums"])
    return run


def _added(batches):
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for slot, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
            part = np.frombuffer(blob.as_py())
            total[slot] = total[slot] + part if slot in total else part
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array([v.tobytes() for v in total.values()], pa.binary())], names=["slot", "sums"])


def _summed(rows: DataFrame, function) -> dict[int, np.ndarray]:
    """Sum matrices of fixed size over all tasks; tasks' sums meet in a few tasks first."""
    schema = "slot long, sums binary"
    met = rows.mapInArrow(function, schema).repartition(8).mapInArrow(_added, schema)
    out: dict[int, np.ndarray] = {}
    for slot, blob in met.collect():
        part = np.frombuffer(blob)
        out[slot] = out[slot] + part if slot in out else part
    return out


def solve(sums: np.ndarray, ridge: float) -> np.ndarray:
    """Ridge weights from one matrix of sums over (features, constant, label); the constant is not shrunk."""
    a, b, n = sums[:-1, :-1], sums[:-1, -1], sums[-2, -2]
    penalty = np.full(len(a), ridge * max(n, 1.0) + 0.05)
    penalty[-1] = 1e-9
    return np.linalg.solve(a + np.diag(penalty), b)


def _binned(shared):
    def run(batches):
        features, weights = shared.value
        sums = np.zeros((2, BINS))
        for batch in batches:
            z, y, fold = features(_matrix(batch.column("x"))), batch.column("label").to_numpy().astype(float), batch.column("fold").to_numpy()
            raw = np.where(fold == 0, z @ weights[1], z @ weights[0])
            at = np.clip((raw - _LOW) / (_HIGH - _LOW) * BINS, 0, BINS - 1).astype(int)
            sums += np.bincount(at, weights=y, minlength=BINS), np.bincount(at, minlength=BINS)
        yield pa.RecordBatch.from_arrays([pa.array([0]), pa.array([sums.tobytes()])], names=["slot", "sums"])
    return run


def isotonic(positive: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over bins in order; bins without rows are skipped. Returns bin places and shares."""
    blocks: list[list[float]] = []  # positives, rows, first place, last place
    for place in np.flatnonzero(count):
        blocks.append([positive[place], count[place], place, place])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            p, n, _, last = blocks.pop()
            blocks[-1][0] += p
            blocks[-1][1] += n
            blocks[-1][3] = last
    xs = [x for b in blocks for x in (b[2], b[3])]
    ys = [y for b in blocks for y in (b[0] / b[1],) * 2]
    return np.array(xs, float), np.array(ys, float)


def _score(model, x: np.ndarray) -> np.ndarray:
    if model is None:
        return np.full(len(x), 0.5)
    mapping, weights, xs, ys = model
    raw = mapping(x) @ weights
    place = (raw - _LOW) / (_HIGH - _LOW) * BINS - 0.5
    return np.clip(0.998 * np.interp(place, xs, ys) + 0.002 / (1 + np.exp(-8 * (raw - 0.5))), 0, 1)  # strictly rising


def _scores(shared):
    def run(batches):
        for batch in batches:
            found = pa.array(_score(shared.value, _matrix(batch.column("x"))))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tkey"), found], names=["doc_id", "tkey", "score"])
    return run


def _classified(shared):
    """Score rows by their text and keep those that are predicted good."""
    def run(batches):
        for batch in batches:
            rows = [statistics(t.as_py()) for t in binary(batch.column("text"))]
            good = _score(shared.value, np.array(rows).reshape(-1, STATISTICS)) >= 0.5
            yield batch.filter(pa.array(good))
    return run


def _held_crc() -> F.Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary"))


def _table(docs: DataFrame) -> DataFrame:
    return keep(docs.select(F.col("doc_id").cast("long"), text_key().alias("tkey"), "text").mapInArrow(_statistics, "doc_id long, tkey long, x array<double>"), "statistics")


def _fit(table: DataFrame, labels: DataFrame, features: int, bandwidth: float, ridge: float, seed: int):
    """The broadcast model: feature map, weights, calibration; None without any usable label."""
    context = table.sparkSession.sparkContext
    known = labels.where("quality IS NOT NULL").select(F.col("doc_id").cast("long"), F.col("quality").cast("double").alias("label"))
    train = table.join(known, "doc_id").where(_held_crc() % 3 != 1).select("x", "label", (F.floor(_held_crc() / 3) % 2).alias("fold"))
    train = keep(train, "labelled")
    moments = _summed(train, _moments).get(0)
    if moments is None or moments[-1] == 0:
        return context.broadcast(None)
    first, second = moments[:-1].reshape(2, -1) / moments[-1]
    mapping = Map(first, np.sqrt(np.maximum(second - first * first, 0)), features, bandwidth, seed)
    sums = _summed(train, _equations(context.broadcast(mapping)))
    halves = [sums[k].reshape(features + 2, features + 2) for k in (0, 1)]
    both = halves[0] + halves[1]
    weights = [solve(h if h[-2, -2] > 0 else both, ridge) for h in halves]
    positive, count = _summed(train, _binned(context.broadcast((mapping, weights))))[0].reshape(2, BINS)
    return context.broadcast((mapping, solve(both, ridge), *isotonic(positive, count)))


def score(docs: DataFrame, labels: DataFrame, features: int = FEATURES, bandwidth: float = BANDWIDTH, ridge: float = RIDGE, seed: int = SEED) -> DataFrame:
    """Score every whole text; higher means label 1 is likelier.

    ``docs`` needs ``doc_id`` and ``text``, ``labels`` needs ``doc_id`` and ``quality``. Learns from labelled rows whose
    crc32(doc_id as text) mod 3 is not 1; only statistics of the text enter a score. Returns ``doc_id``, ``tkey`` (hash of
    the text), ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 if score >= 0.5, else 0). Null texts count as empty
    and are scored too; rows with a null doc_id are scored and not held out; null labels are not learnt from. Without any
    usable label every score is 0.5. Repeated rows are each scored; an empty table gives an empty result.
    """
    table = _table(docs)
    scored = table.mapInArrow(_scores(_fit(table, labels, features, bandwidth, ridge, seed)), "doc_id long, tkey long, score double")
    return scored.select("doc_id", "tkey", F.coalesce(_held_crc() % 3 == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, features: int = FEATURES, bandwidth: float = BANDWIDTH, ridge: float = RIDGE, seed: int = SEED) -> DataFrame:
    """The rows of ``docs`` that score at least 0.5, all columns unchanged; texts are read again rather than shuffled."""
    return docs.mapInArrow(_classified(_fit(_table(docs), labels, features, bandwidth, ridge, seed)), docs.schema)
