"""Exact token counts of whole texts; huge texts are encoded in overlapping chunks that are spliced where both sides agree.

A chunk's encoding is right from some place on and up to some place, both unknown at first. Neighbouring chunks overlap,
and a splice needs a byte position that (a) both encodings have as a token boundary and (b) is proven stable: a blank
after an ASCII letter or digit. No rule of the pre-tokenizer and no special string spans such a place, so what stands
before it cannot change what follows. If an overlap has no such place, the texts concerned are cut again with wider
overlaps, up to the whole text.
"""

from __future__ import annotations

import base64
import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliospark.llm.shared import binary, keep, text_key

CHUNK = 1 << 16
OVERLAP = 512
LIMIT = 1024
END_OF_TEXT = "<|endoftext|>"
RANKS = "byte_bpe_50k.tiktoken"


def default_ranks() -> str:
    import public_tokenizers
    return public_tokenizers.path(RANKS)


@functools.lru_cache(maxsize=2)
def encoder(ranks_path: str):
    """Encoding of a rank file with its end-of-text string, and the bytes of each token.

    The rank file holds the same vocabulary as the .json of that name and gives the same ids, several times faster.
    """
    import public_tokenizers
    import tiktoken
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={END_OF_TEXT: len(ranks)})
    sizes = np.zeros(len(ranks) + 1, np.int64)
    for token, rank in ranks.items():
        sizes[rank] = len(token)
    sizes[len(ranks)] = len(END_OF_TEXT)
    return encoding, sizes


def count(text: str, ranks_path: str) -> int:
    return len(encoder(ranks_path)[0].encode(text, allowed_special="all"))


def cut(size: int, chunk: int, overlap: int) -> list[tuple[int, int]]:
    """Byte ranges that cover a text; each reaches ``overlap`` into the next."""
    starts = range(0, max(size, 1), chunk)
    return [(s, min(size, s + chunk + overlap)) for s in starts if s == 0 or s + overlap < size]


def _rounded(raw: bytes, at: int) -> int:
    while 0 < at < len(raw) and raw[at] & 0xC0 == 0x80:
        at -= 1
    return at


def stable_boundaries(raw: bytes, ranks_path: str) -> tuple[np.ndarray, np.ndarray, int]:
    """Encode a chunk: its provably stable token boundaries (bytes), tokens before each, and tokens in all."""
    encoding, sizes = encoder(ranks_path)
    ids = encoding.encode_to_numpy(raw.decode(), allowed_special="all")
    ends = np.cumsum(sizes[ids])
    data = np.frombuffer(raw, np.uint8)
    inner = ends[:-1]
    before = data[inner - 1] | 0x20
    word = ((before >= 97) & (before <= 122)) | ((data[inner - 1] >= 48) & (data[inner - 1] <= 57))
    blank = (data[inner] == 32) | (data[inner] == 10)
    good = np.flatnonzero(word & blank)
    return inner[good], good + 1, len(ids)


def splice(pieces: list[tuple[int, int, np.ndarray, np.ndarray, int]]) -> int | None:
    """Tokens of a text from its pieces (start, end, boundaries, counts, total) in order; None if two do not align."""
    total, taken = 0, 0
    for left, right in zip(pieces, pieces[1:]):
        common, i, j = np.intersect1d(left[2] + left[0], right[2] + right[0], return_indices=True)
        fits = np.flatnonzero(left[3][i] >= taken)
        if not len(fits):
            return None
        at = fits[len(fits) // 2]
        total += int(left[3][i[at]]) - taken
        taken = int(right[3][j[at]])
    return total + pieces[-1][4] - taken


_PIECE = pa.schema([("doc_id", pa.int64()), ("tkey", pa.int64()), ("start", pa.int64()), ("stop", pa.int64()), ("piece", pa.binary())])


def _pieces(chunk: int, overlap: int):
    def run(batches):
        for batch in batches:
            for doc, key, text in zip(batch.column("doc_id"), batch.column("tkey"), binary(batch.column("text"))):
                raw = text.as_py()
                ranges = [(_rounded(raw, s), _rounded(raw, e) if e < len(raw) else e) for s, e in cut(len(raw), chunk, overlap)]
                yield pa.RecordBatch.from_arrays([pa.array([doc.as_py()] * len(ranges), pa.int64()), pa.array([key.as_py()] * len(ranges), pa.int64()),
                                                  pa.array([s for s, _ in ranges]), pa.array([e for _, e in ranges]),
                                                  pa.array([raw[s:e] for s, e in ranges])], schema=_PIECE)
    return run


def _encode_pieces(chunk: int, overlap: int, ranks_path: str):
    """Keep of each piece what a splice needs: boundaries within both overlaps, and its total."""
    def run(batches):
        for batch in batches:
            rows = []
            for start, stop, raw in zip(*(batch.column(c).to_pylist() for c in ("start", "stop", "piece"))):
                at, counts, total = stable_boundaries(raw, ranks_path)
                near = (at <= overlap) | (at >= chunk - 4)
                rows.append((at[near].tolist(), counts[near].tolist(), total))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("doc_id", "tkey", "start", "stop")] + [
                pa.array([r[0] for r in rows], pa.list_(pa.int64())), pa.array([r[1] for r in rows], pa.list_(pa.int64())), pa.array([r[2] for r in rows], pa.int64())],
                names=["doc_id", "tkey", "start", "stop", "at", "counts", "total"])
    return run


def _splice_rows(batches):
    for batch in batches:
        tokens = []
        for pieces in batch.column("pieces").to_pylist():
            pieces.sort(key=lambda p: p["start"])
            tokens.append(splice([(p["start"], p["stop"], np.array(p["at"], np.int64), np.array(p["counts"], np.int64), p["total"]) for p in pieces]))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tkey"), pa.array(tokens, pa.int64())], names=["doc_id", "tkey", "n_tokens"])


def _count_rows(ranks_path: str):
    def run(batches):
        encoding = encoder(ranks_path)[0]
        for batch in batches:
            tokens = [len(encoding.encode_to_numpy(t, allowed_special="all")) if t else 0 for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(tokens, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])
    return run


def _huge_counts(huge: DataFrame, chunk: int, overlap: int, ranks_path: str) -> DataFrame:
    """Spliced counts of distinct huge texts (doc_id, tkey, n_tokens), each text's chunks spread over all tasks."""
    done, parts = None, int(huge.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    todo = huge
    while True:
        pieces = todo.mapInArrow(_pieces(chunk, overlap), "doc_id long, tkey long, start long, stop long, piece binary")
        encoded = (pieces.repartition(parts, "tkey", "start").dropDuplicates(["tkey", "doc_id", "start"])
                   .mapInArrow(_encode_pieces(chunk, overlap, ranks_path), "doc_id long, tkey long, start long, stop long, at array<long>, counts array<long>, total long"))
        spliced = keep(encoded.groupBy("doc_id", "tkey").agg(F.collect_list(F.struct("start", "stop", "at", "counts", "total")).alias("pieces"))
                       .mapInArrow(_splice_rows, "doc_id long, tkey long, n_tokens long"), "spliced")
        good = spliced.where("n_tokens IS NOT NULL")
        done = good if done is None else done.union(good)
        failed = spliced.where("n_tokens IS NULL")
        if failed.isEmpty():
            return done
        overlap *= 16
        chunk = max(chunk, overlap)
        todo = todo.join(failed.select("doc_id", "tkey"), ["doc_id", "tkey"], "left_semi")


def token_counts(docs: DataFrame, ranks_path: str | None = None, limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Tokens of every whole text: ``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit`` (n_tokens > limit).

    Only ``doc_id`` and ``text`` are read. Null and empty texts have 0 bytes and 0 tokens. Strings of special tokens
    inside a text count as that one token; nothing is added, cut off or padded. Repeated rows, also with one doc_id or
    a null doc_id, are each returned; an empty table gives an empty result.
    """
    ranks_path = ranks_path or default_ranks()
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    small = rows.where(F.col("n_bytes") <= chunk + overlap).mapInArrow(_count_rows(ranks_path), "doc_id long, n_bytes long, n_tokens long")
    huge = rows.where(F.col("n_bytes") > chunk + overlap).withColumn("tkey", text_key()).withColumn("doc_id", F.coalesce("doc_id", F.lit(-1 << 63)))
    counted = _huge_counts(huge.select("doc_id", "tkey", "text"), chunk, overlap, ranks_path)
    spliced = huge.select("doc_id", "tkey", "n_bytes").join(counted, ["doc_id", "tkey"])
    large = spliced.select(F.nullif("doc_id", F.lit(-1 << 63)).alias("doc_id"), "n_bytes", "n_tokens")
    return small.union(large).withColumn("over_limit", F.col("n_tokens") > limit)
