"""Helpers shared by the corpus operators: intermediate tables, Arrow texts and vectorised words."""

from __future__ import annotations

import ctypes
import functools
import gc
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_BYTES = 1 << 20
BATCH = "4m"
WORD = r"[^\x20\x09-\x0D]+"


def small_batches(spark: SparkSession) -> None:
    """Tasks get texts in Arrow batches of ``BATCH`` bytes, unless the session sets a size itself: a batch is held several times."""
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or one made for local runs where it is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="heliospark-llm-"))
    return spark.sparkContext.getCheckpointDir()


def fresh_path(spark: SparkSession, name: str) -> str:
    small_batches(spark)
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: the plan starts anew and lost executors cost nothing."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read(spark: SparkSession, directory: str, table: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{directory}/{table}.parquet")


def text_key() -> F.Column:
    """Tells apart rows that share a doc_id."""
    return F.xxhash64("text")


def binary(column: pa.Array) -> pa.Array:
    """Texts as bytes; null counts as empty."""
    return pc.fill_null(column.cast(pa.binary()), b"")


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows in pieces of about ``limit`` bytes: first row, row after the last, their bytes, offsets into these."""
    column = binary(column)
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        last = min(last, len(column))
        yield first, last, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def _byte_values(fold: bool) -> np.ndarray:
    values = np.random.default_rng(20240229).integers(1, 2**64 - 1, 256, np.uint64, endpoint=True)
    if fold:
        values[65:91] = values[97:123]
    values[_SPACE] = 0
    return values


_VALUES = {fold: _byte_values(fold) for fold in (False, True)}
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))


@functools.lru_cache(maxsize=1)
def _powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    def row(base):
        out = np.full(length, base, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)
    return row(_BASE), row(_INVERSE)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def word_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte positions at which the words of all documents start."""
    blank = _SPACE[data]
    before = np.empty(len(data), bool)
    if len(data):
        before[0], before[1:] = True, blank[:-1]
        inner = offsets[:-1]
        before[inner[inner < len(data)]] = True
    return np.flatnonzero(before & ~blank)


def word_hashes(data: np.ndarray, offsets: np.ndarray, fold: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of all words, each document's first word (one more for the end), and byte positions of the words.

    A word's hash is a polynomial over random byte values, taken from one running product; ``fold`` reads A-Z as a-z.
    """
    starts = word_starts(data, offsets)
    bounds = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), bounds, starts
    size = CHUNK_BYTES
    while size < len(data):
        size *= 2
    power, inverse = _powers(size)
    weighted = _VALUES[fold][data]
    weighted *= power[:len(data)]
    return mixed(np.add.reduceat(weighted, starts) * inverse[starts]), bounds, starts


def runs_of(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all ``width`` consecutive words (documents not kept apart)."""
    if len(h) < width:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(h) - width + 1, np.uint64)
    for i in range(width):
        total += h[i:len(h) - width + 1 + i] * np.uint64(pow(0xD1342543DE82EF95, i, 1 << 64))
    return mixed(total)


def whole_hash(h: np.ndarray) -> np.ndarray:
    """One hash for a sequence shorter than a window."""
    return runs_of(h, len(h)) ^ np.uint64(len(h))


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def only(docs: DataFrame, keys: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """One row of ``docs`` for each (doc_id, tkey) of ``keys`` (columns doc_id, tkey, rows: how many rows of docs have it, and others).

    Rows of ``docs`` equal in doc_id and text count once; with ``also``, columns of both, only if they agree in these too.
    Further columns of ``keys`` are added. Keys that only one row has, nearly all, need no look at their neighbours.
    """
    keyed, extra = docs.withColumn("__tkey", text_key()), [c for c in keys.columns if c not in ("doc_id", "tkey", "rows", *also)]

    def part(chosen: DataFrame) -> DataFrame:
        chosen = chosen.select(F.col("doc_id").alias("__id"), F.col("tkey").alias("__key"), *(F.col(c).alias(f"__also_{c}") for c in also), *extra)
        match = keyed["doc_id"].eqNullSafe(chosen["__id"]) & (keyed["__tkey"] == chosen["__key"])
        for c in also:
            match &= keyed[c].eqNullSafe(chosen[f"__also_{c}"])
        return keyed.join(chosen, match).drop("__id", "__key", *(f"__also_{c}" for c in also))
    several = keep(keys.where("rows > 1"), "several")
    return part(keys.where("rows = 1")).union(part(several).dropDuplicates(["doc_id", "__tkey", *also])).drop("__tkey")


_REMEMBERED = [_powers]


def remember(cached):
    """Mark a cached function whose results a worker drops around heavy tasks."""
    _REMEMBERED.append(cached)
    return cached


def release_memory() -> None:
    """Give back what tasks of a reused Python worker remember, or have freed but its allocators still hold."""
    for cached in _REMEMBERED:
        cached.cache_clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run):
    """A heavy task that starts with free memory and leaves none behind: idle workers count against an executor too."""
    def tidied(batches):
        release_memory()
        try:
            yield from run(batches)
        finally:
            release_memory()
    return tidied
