"""Byte-pair encoding and decoding with a vocabulary of word-end tokens, merged in contiguous rank arrays.

A word's parts lie in one list and the ranks of adjacent parts in another. The least rank is found by a scan, its
boundary deleted and the two neighbouring ranks refreshed: for words of a few parts this beats any heap. Words beyond
``SHORT`` parts would make that quadratic and use a heap over the same ranks.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from heliospark.llm.shared import small_batches, tidy

VOCABULARY = "word_bpe_49k.json"
SHORT = 128
ROWS = 1000  # texts whose results are held at once
REMEMBERED = 150_000  # words in each of two generations of which a worker keeps the encoding; others are encoded again
LONGEST = 64  # longer words are not kept
_NO_RANK = 1 << 60
_ID = (1 << 20) - 1
_BLANK = "\\x09-\\x0D\\x20\\x85\\xA0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000"


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path(VOCABULARY)


def _byte_symbols() -> list[str]:
    """The printable character that stands for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Memory(dict):
    """Encodings of the words met lately: a full generation becomes the older one, from which words met again come back."""

    def __init__(self, make):
        self.make, self.older = make, {}

    def __missing__(self, word: str):
        found = self.older.pop(word, None) or self.make(word)
        if len(word) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[word] = found
        return found

    def forget(self) -> None:
        self.clear()
        self.older = {}


class Codec:
    def __init__(self, path: str):
        import regex
        with open(path, encoding="utf-8") as lines:
            spec = json.load(lines)
        model, added = spec["model"], spec["added_tokens"]
        self.vocabulary: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in added}
        self.tokens = {i: t for t, i in [*self.vocabulary.items(), *self.special.items()]}
        self.merges: dict[int, int] = {}  # pair of ids -> rank and merged id
        for rank, (a, b) in enumerate(model["merges"]):
            self.merges[self.vocabulary[a] << 20 | self.vocabulary[b]] = rank << 20 | self.vocabulary[a + b]
        symbols = _byte_symbols()
        self.inner = [self.vocabulary[s] for s in symbols]
        self.last = [self.vocabulary[s + self.end] for s in symbols]
        self.split = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{_BLANK}\p{{L}}\p{{N}}]+").findall
        self.specials = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")").split if added else None
        self.memory = Memory(self.word)

    def merge(self, parts: list[int]) -> list[int]:
        """Merge adjacent parts, least rank first and leftmost on ties, until none is left."""
        if len(parts) > SHORT:
            return self._merge_long(parts)
        rank = self.merges.get
        ranks = [rank(a << 20 | b, _NO_RANK) for a, b in zip(parts, parts[1:])]
        while ranks:
            least = min(ranks)
            if least == _NO_RANK:
                break
            i = ranks.index(least)
            parts[i] = least & _ID
            del parts[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = rank(parts[i] << 20 | parts[i + 1], _NO_RANK)
            if i:
                ranks[i - 1] = rank(parts[i - 1] << 20 | parts[i], _NO_RANK)
        return parts

    def _merge_long(self, parts: list[int]) -> list[int]:
        n, merges = len(parts), self.merges
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(p >> 20, i, parts[i], parts[i + 1]) for i in range(n - 1) if (p := merges.get(parts[i] << 20 | parts[i + 1]))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or parts[i] != a or parts[j] != b:
                continue
            parts[i] = merges[a << 20 | b] & _ID
            alive[j], after[i] = False, after[j]
            if after[i] < n:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < n and (p := merges.get(parts[k] << 20 | parts[after[k]])):
                    heapq.heappush(heap, (p >> 20, k, parts[k], parts[after[k]]))
        return [p for p, live in zip(parts, alive) if live]

    def word(self, word: str) -> tuple[int, str, str]:
        """Tokens, ids and token texts of a word."""
        raw = word.encode()
        ids = self.merge([self.inner[b] for b in raw[:-1]] + [self.last[raw[-1]]])
        return len(ids), " ".join(map(str, ids)), self.decode(ids)

    def _plain(self, text: str) -> list[tuple[int, str, str]]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return list(map(self.memory.__getitem__, self.split(text.lower())))

    def words(self, text: str) -> list[tuple[int, str, str]]:
        """Encodings of a text's words in order; a special token's string is one."""
        if not any(s in text for s in self.special):
            return self._plain(text)
        found = []
        for k, part in enumerate(self.specials(text)):
            found += [(1, str(self.special[part]), part)] if k % 2 else self._plain(part)
        return found

    def encode(self, text: str | None) -> list[int]:
        return [int(i) for w in self.words(text or "") for i in w[1].split(" ")]

    def decode(self, ids: list[int]) -> str:
        """Token texts joined by a blank, as a vocabulary without a decoder gives them; unknown ids are left out."""
        return " ".join(self.tokens[i] for i in ids if i in self.tokens)


@functools.lru_cache(maxsize=1)
def codec(path: str) -> Codec:
    """The vocabulary, kept from task to task; what a task remembers of words goes when it ends."""
    return Codec(path)


def _other(batch, *but: str) -> list[str]:
    return [n for n in batch.schema.names if n not in but]


def _digests(path: str, with_ids: bool):
    def run(batches):
        words = codec(path).words
        for batch in (whole.slice(at, ROWS) for whole in batches for at in range(0, whole.num_rows, ROWS)):
            out = []
            for text in batch.column("text").to_pylist():
                counts, ids, tokens = zip(*found) if (found := words(text or "")) else ((), (), ())
                ids = " ".join(ids)
                out.append((sum(counts), hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(" ".join(tokens).encode()).hexdigest(),
                            np.fromstring(ids, np.int32, sep=" ") if with_ids else None))
            names, found = _other(batch, "text"), ["n_tokens", "ids_sha256", "decoded_sha256", "ids"][:4 if with_ids else 3]
            types = (pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [pa.array([o[i] for o in out], types[i]) for i in range(len(found))], names=[*names, *found])

    @tidy
    def clean(batches):
        try:
            yield from run(batches)
        finally:
            codec(path).memory.forget()
    return clean


def _ids(path: str):
    def run(batches):
        for batch in batches:
            ids = [codec(path).encode(t) for t in batch.column("text").to_pylist()]
            names = _other(batch, "text")
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [pa.array(ids, pa.list_(pa.int32()))], names=[*names, "ids"])
    return run


def _texts(path: str):
    def run(batches):
        for batch in batches:
            texts = [codec(path).decode(i or []) for i in batch.column("ids").to_pylist()]
            names = _other(batch, "ids")
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [pa.array(texts, pa.string())], names=[*names, "decoded"])
    return run


def _named(docs: DataFrame, keep: tuple[str, ...]) -> str:
    types = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    return ", ".join(f"`{c}` {types[c]}" for c in keep)


def encode(docs: DataFrame, path: str | None = None, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Token ids of every whole text: the ``carry`` columns and ``ids`` (array of int; empty for null and blank texts)."""
    return docs.select(*carry, "text").mapInArrow(_ids(path or default_vocabulary()), _named(docs, carry) + ", ids array<int>")


def decode(encoded: DataFrame, path: str | None = None, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Texts of token ids: the ``carry`` columns and ``decoded`` (null ids give an empty text; ids that do not exist are left out)."""
    return encoded.select(*carry, "ids").mapInArrow(_texts(path or default_vocabulary()), _named(encoded, carry) + ", decoded string")


def digests(docs: DataFrame, path: str | None = None, carry: tuple[str, ...] = ("doc_id",), with_ids: bool = False) -> DataFrame:
    """Encode and decode every whole text and return the digests of both.

    Returns the ``carry`` columns, ``n_tokens``, ``ids_sha256`` (decimal ids joined by a blank) and ``decoded_sha256``
    (decoded text in UTF-8), lower-case hex; ``with_ids`` adds ``ids``. Null, empty and blank texts have no token and the digests of an empty text.
    Each row stands alone: order, repeated rows and other columns do not matter, and an empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    return docs.select(*carry, "text").mapInArrow(_digests(path or default_vocabulary(), with_ids),
                                                 _named(docs, carry) + ", n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids)
