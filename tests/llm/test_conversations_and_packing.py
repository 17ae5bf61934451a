"""Conversation repair, prefix trie and packing against plain Python and exact round trips."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import brute
import numpy as np
import pytest

from heliospark.llm import conversation_repair, packing, prefix_trie
from heliospark.llm.runs import IDENTITY, _then, running

SCHEMA = "conv_id long, turn long, role string, text string, seq long, part int, copies long, owner long, depth long"
COLUMNS = ("conv_id", "turn", "role", "text")


def _frame(spark, rows, parts=5):
    """Conversation rows with columns whose names the operators use inside."""
    return spark.createDataFrame([(*r, 7, 7, 7, 7, 7) for r in rows], SCHEMA).repartition(parts)


def _by_id(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is not None, r[0] or 0))


@pytest.fixture(scope="module")
def odd_conversations(spark):
    """Few ids, null ids and turns, ties, many equal rows, odd roles, one very long text."""
    rng = random.Random(5)
    texts = ["Yes.", "no", "", "  ", "ok!", "What?", "a b.\t", "cut. x", None, "é.  ", "long " * 40_000]
    rows = [(rng.choice([1, 2, 3, None]), rng.choice([None, *range(60)]), rng.choice(["user", "assistant", "system", "tool", None, ""]), rng.choice(texts)) for _ in range(300)]
    rows += [(10 + i % 3, i, rng.choice(["user", "assistant"]), f"t{rng.randrange(10**6)}" + rng.choice([".", "!", "", ""])) for i in range(400)]
    rows += [(20, 4, "user", "Same.")] * 200 + [(-7, 0, "user", "Only."), (2**60, 3, "assistant", "far")]
    return _frame(spark, rows)


@pytest.mark.parametrize("chunk", [128, 7])
def test_repair_matches_a_search_over_audits(spark, odd_conversations, chunk):
    got = _by_id(conversation_repair.repair(odd_conversations, chunk).collect())
    assert got == brute.repaired([tuple(r) for r in odd_conversations.select(*COLUMNS).collect()])


def test_repair_of_the_fixture_and_of_nothing(spark, directory):
    table = spark.read.parquet(f"{directory}/conversations.parquet")
    got = _by_id(conversation_repair.repair(table).collect())
    assert got == brute.repaired([tuple(r) for r in table.select(*COLUMNS).collect()])
    assert conversation_repair.repair(table.limit(0)).count() == 0


def test_speculative_vectors_settle_after_a_few_rows():
    """From any two end vectors the costs a few rows earlier differ by a constant."""
    rng = np.random.default_rng(3)
    codes = rng.choice([0, 1, 2, 1, 2, 13, 14, 5], (200, 60))
    ones = np.ones_like(codes)
    a = conversation_repair.backward(codes, ones, np.tile(conversation_repair._END, (200, 1)))[:, 0]
    b = conversation_repair.backward(codes, ones, rng.integers(0, 9, (200, 4)))[:, 0]
    apart = a - b
    assert ((apart == apart[:, :1]).all(axis=1)).mean() > 0.9


@pytest.fixture(scope="module")
def branching(spark):
    """Conversations over a tiny alphabet, so that prefixes branch, end inside others and repeat."""
    rng = random.Random(11)
    rows = []
    for c in range(160):
        same = c % 4 == 0
        for t in range(rng.choice([1, 2, 3, 6, 9, 14, 30])):
            rows.append((c * 3, t if rng.random() < 0.97 or t else None, "user" if t % 2 == 0 else None, "hot" if same or t == 0 else rng.choice(["a", "b", "é", None])))
    rows.append((-6, 0, "user", "hot"))
    return rows


@pytest.mark.parametrize("block", [4, 1, 3])
def test_trie_matches_plain_grouping(spark, branching, block):
    got = sorted(map(tuple, prefix_trie.prefix_trie(_frame(spark, [*branching, (None, 1, "user", "left out")]), block).collect()), key=lambda r: r[:2])
    want = brute.trie([(c, t, r, x) for c, t, r, x in branching])
    assert len(got) == len(want)
    assert got == want


def test_trie_of_the_fixture_and_of_nothing(spark, directory):
    table = spark.read.parquet(f"{directory}/conversations.parquet")
    got = sorted(map(tuple, prefix_trie.prefix_trie(table).collect()), key=lambda r: r[:2])
    assert got == brute.trie([tuple(r) for r in table.select(*COLUMNS).collect()])
    assert prefix_trie.prefix_trie(table.limit(0)).count() == 0


def test_trie_counts_repeated_rows_as_turns(spark):
    rows = [(0, 1, "user", "x")] * 300 + [(1, 1, "user", "x")] * 5
    nodes = prefix_trie.prefix_trie(_frame(spark, rows)).collect()
    assert sorted(map(tuple, nodes), key=lambda r: r[:2]) == brute.trie(rows)
    assert next(r for r in nodes if r.depth == 0).n_convs == 2


def test_running_values_cross_tasks(spark):
    rng = random.Random(2)
    rows = [(rng.choice([1, 1, 1, 1, 2, None]), i, rng.randrange(-50, 50), rng.getrandbits(62), rng.getrandbits(8)) for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, o long, s long, x long, m long").repartition(6)
    got = {r.o: r for r in running(df, "k", ["o"], ("s",), ("x",), ("m",)).collect()}
    for key in (1, 2, None):
        n, total, xor, mapped = 0, 0, 0, IDENTITY
        for k, o, s, x, m in rows:
            if k == key:
                n, total, xor, mapped = n + 1, total + s, xor ^ x, _then(mapped, m)
                assert (got[o].position, got[o].run_s, got[o].run_x, got[o].run_m) == (n, total, xor, mapped)


def _check_pieces(rows, texts):
    """Every id in one piece, pieces of a document and of a sequence gapless; returns sizes of sequences."""
    from tokenizers import Tokenizer
    import public_tokenizers
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = Counter()
    for doc, text in texts:
        ids[doc, (*library.encode(text or "", add_special_tokens=False).ids, 1)] += 1
    crc = {}
    for (doc, tokens), n in ids.items():
        for start in range(0, len(tokens), 2048):
            part = np.array(tokens[start:start + 2048], "<u4")
            crc[doc, start, len(part), zlib.crc32(part.tobytes()), len(tokens)] = n + crc.get((doc, start, len(part), zlib.crc32(part.tobytes()), len(tokens)), 0)
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == Counter(crc)
    at = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at.get(r.sequence_id, 0)
        at[r.sequence_id] = r.offset + r.length
    assert max(at.values(), default=0) <= 2048
    return list(at.values())


def test_packed_documents(spark, small):
    rows = packing.pack(small).collect()
    sizes = _check_pieces(rows, [tuple(r) for r in small.select("doc_id", "text").collect()])
    assert sum(sizes) / (2048 * len(sizes)) > 0.95


def test_packing_odd_rows(spark, odd, empty, odd_rows):
    _check_pieces(packing.pack(odd).collect(), odd_rows)
    assert packing.pack(empty).count() == 0
    many = spark.createDataFrame([(None if i % 2 else 5, "same words here" if i % 3 else None) for i in range(900)], "doc_id long, text string").repartition(4)
    _check_pieces(packing.pack(many).collect(), [tuple(r) for r in many.collect()])


@pytest.mark.parametrize("n,spread", [(1, 1.0), (40, 1.0), (3000, 1.0), (30_000, 0.2)])
def test_plans_hold_the_demand_in_few_sequences(n, spread):
    rng = np.random.default_rng(n)
    weights = np.clip(rng.lognormal(4, spread, n).astype(int), 1, 256)
    plan = packing.packing_plan(dict(Counter(weights.tolist())), 256)
    held = Counter()
    for w, counts, times in plan:
        assert w @ counts <= 256
        for a, b in zip(w.tolist(), counts.tolist()):
            held[a] += b * times
    assert held == Counter(weights.tolist())
    few = sum(t for *_, t in plan)
    assert few >= weights.sum() / 256
    if spread == 1.0:
        assert few <= weights.sum() / 256 * 1.01 + 2


def test_column_generation_reaches_the_known_optimum():
    """Three classes whose best mix is 2 x 5 + 0, 1 x 4 + 2 x 3: found by enumeration."""
    weights, demand = np.array([3, 4, 5]), np.array([40.0, 20.0, 20.0])
    patterns, used = packing.column_generation(weights, demand, 10)
    assert np.allclose(patterns @ used, demand)
    assert used.sum() <= 30 + 0.5


def test_knapsack_prices_like_enumeration():
    import itertools
    rng = np.random.default_rng(4)
    for _ in range(20):
        weights, values = np.sort(rng.choice(np.arange(1, 12), 4, False)), rng.random(4)
        best = max(np.dot(c, values) for c in itertools.product(range(13), repeat=4) if np.dot(c, weights) <= 12)
        worth, counts = packing.knapsack(weights, values, 12)
        assert abs(worth - best) < 1e-9 and counts @ weights <= 12 and abs(counts @ values - worth) < 1e-9
