import hashlib
import random

import brute
import numpy as np
from pyspark.sql import functions as F
import pytest

from heliospark.llm import components, ngram_join, simhash, substring_dedup


def _key(row):
    return tuple((v is None, v) for v in row)


def _groups(df):
    return sorted((tuple(r) for r in ngram_join.similar_groups(df).select("doc_id", "n_shingles", "component_id").collect()), key=_key)


def test_groups_of_odd_rows(odd, odd_rows, empty):
    known = [r for r in odd_rows if r[0] is not None]
    got = [r for r in _groups(odd) if r[0] is not None]
    assert got == brute.similar_groups(known)
    assert _groups(empty) == []


def test_groups_of_documents(small):
    rows = [tuple(r) for r in small.select("doc_id", "text").collect()]
    assert _groups(small) == brute.similar_groups(rows)


def test_near_copies_that_only_chain(spark, monkeypatch):
    """A dense group of near copies: pairs below the threshold, links only by chains, small blocks and salted shingles."""
    monkeypatch.setattr(ngram_join, "BLOCK", 7)
    monkeypatch.setattr(ngram_join, "HOT_GROUP", 5)
    random = np.random.default_rng(3)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for d in range(120):
        words = list(base)
        for at in random.choice(150, random.integers(0, 9), replace=False):
            words[at] = f"e{random.integers(0, 6)}"
        rows.append((d, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert _groups(df) == brute.similar_groups(rows)


def test_only_texts_of_pairs_are_moved(spark, monkeypatch):
    """Verification gets each text that a pair needs, and few others, before it shuffles them."""
    base = [f"w{i}" for i in range(60)]
    rows = [(d, " ".join(base[:60 - d])) for d in range(3)] + [(1, " ".join(base[:59])), (None, " ".join(base + ["x"])), (3, None), (4, "")]
    rows += [(d, " ".join(f"v{d}x{i}" for i in range(60))) for d in range(10, 300)]
    df, moved = spark.createDataFrame(rows, "doc_id long, text string").repartition(4), []
    plain = ngram_join._one_of_repeated
    monkeypatch.setattr(ngram_join, "_one_of_repeated", lambda docs, repeated: moved.append(sorted(map(_key, docs.select("doc_id", "text").collect()))) or plain(docs, repeated))
    groups = {(r.doc_id, r.component_id) for r in ngram_join.similar_groups(df).collect()}
    assert {g for g in groups if g[0] is None or g[0] < 3} == {(0, 0), (1, 0), (2, 0), (None, 0)}
    needed = sorted(map(_key, rows[:5]))
    assert [k for k in moved[0] if k in needed] == needed and len(moved[0]) < 10


@pytest.mark.parametrize("own", [20, 7])
def test_a_base_and_many_longer_versions(spark, own):
    """Versions link with their base only, which lies beyond the prefixes that versions share with each other."""
    random = np.random.default_rng(own)
    base = [f"w{i}" for i in range(84)]
    texts = [" ".join(base)] + [" ".join(base + [f"v{d}x{i}" for i in range(own)]) for d in range(40)]
    rows = [(int(d), t) for d, t in zip(random.permutation(len(texts)), texts)]
    rows = [rows[i] for i in random.permutation(len(rows))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute.similar_groups(rows)
    assert {c for _, _, c in want} == {0}
    assert _groups(df) == want


def test_bounds_never_drop_a_link():
    random = np.random.default_rng(5)
    for _ in range(300):
        x = np.unique(random.integers(0, 2**63, 40, np.uint64) * np.uint64(2))
        y = np.unique(np.concatenate([x[: random.integers(1, len(x))], random.integers(0, 2**63, 12, np.uint64)]))
        both = len(np.intersect1d(x, y))
        if 100 * both >= 75 * (len(x) + len(y) - both):
            a, b = (np.frombuffer(ngram_join._ranges(s), np.uint16)[None] for s in (x, y))
            assert ngram_join.suffix_fits(a, b, np.array([len(x) + len(y)]), 75).all()
            px, py = (np.sort(s)[: ngram_join.prefix_length(len(s), 75)] for s in (x, y))
            common = np.intersect1d(px, py)
            assert len(common)
            i, j = np.searchsorted(px, common[0]), np.searchsorted(py, common[0])
            assert ngram_join.may_reach(len(x), i, len(y), j, 75)


def test_one_of_each_keeps_one_row_of_a_group(odd):
    kept = ngram_join.one_of_each(odd)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert {1, 5, 6, 7, 8, 10, 11, 13, 20} <= set(ids)
    assert 4 in ids and not {2, 3, 9, 12} & set(ids)
    assert ids.count(14) <= 1


def test_null_and_shared_ids(spark):
    """A null id takes no links from others, groups without any id hold together, and a shared id joins nothing."""
    x, y, z = ([f"{c}{i}" for i in range(60)] for c in "xyz")
    near = lambda words, d: " ".join([*words[:59], f"end{d}"])
    rows = [(None, " ".join(x)), (4, " ".join(x)), (5, near(x, 1)), (6, near(x, 2)), (None, " ".join(y)), (None, " ".join(y)), (None, near(y, 1)), (None, near(y, 2)),
            (7, " ".join(z)), (7, "same id, other text")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {tuple(r) for r in ngram_join.similar_groups(df).select("doc_id", "n_shingles", "component_id").collect()}
    assert got == {(None, 56, 4), (4, 56, 4), (5, 56, 4), (6, 56, 4), (None, 56, None), (7, 56, 7), (7, 1, 7)}
    kept = [tuple(r) for r in ngram_join.one_of_each(df).collect()]
    assert len(kept) == 4 and {(4, " ".join(x)), (7, " ".join(z)), (7, "same id, other text")} < set(kept)
    assert [d for d, t in kept if t.startswith("y0")] == [None]


def test_components(spark):
    links = spark.createDataFrame([(1, 2), (2, 3), (9, 8), (7, 9), (5, 5), (3, 1)] + [(i, i + 1) for i in range(100, 160)], "a long, b long")
    got = {r.node: r.label for r in components.components(links).collect()}
    assert got == {2: 1, 3: 1, 8: 7, 9: 7} | dict.fromkeys(range(101, 161), 100)
    assert components.components(links.limit(0)).count() == 0


@pytest.mark.parametrize("large, suffixes, stretch", [(4096, 50_000, 512), (1, 50_000, 3), (4096, 0, 512), (1, 40, 7)])
def test_repeats_of_odd_rows(odd, odd_rows, empty, monkeypatch, large, suffixes, stretch):
    monkeypatch.setattr(substring_dedup, "LARGE_GROUP", large)
    monkeypatch.setattr(substring_dedup, "GROUP_SUFFIXES", suffixes)
    monkeypatch.setattr(substring_dedup, "STRETCH", stretch)
    want = [(d, n, gone, hashlib.sha256(kept.encode()).hexdigest()) for d, n, gone, kept in brute.remove_repeats([r for r in odd_rows if r[0] is not None])]
    rows = substring_dedup.remove_repeats(odd).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(tuple(r) for r in rows if r.doc_id is not None) == want
    assert [r.n_removed for r in rows if r.doc_id is None] == [0]
    assert substring_dedup.remove_repeats(empty).count() == 0


@pytest.mark.parametrize("span", [50, 12])
def test_repeats_of_documents(small, span):
    rows = [tuple(r) for r in small.select("doc_id", "text").collect()]
    got = substring_dedup.remove_repeats(small, span).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got)) == [(d, n, g, hashlib.sha256(k.encode()).hexdigest()) for d, n, g, k in brute.remove_repeats(rows, span)]


def test_common_short_passages_are_split_until_groups_fit(spark, monkeypatch):
    """A passage shorter than the window among other words in all documents, one longer than it, and many equal words."""
    pick = random.Random(11)
    short, long = ([f"{name}{i}" for i in range(n)] for name, n in (("s", 40), ("l", 70)))
    rows = []
    for d in range(300):
        own = [f"{d}-{i}" for i in range(60)]
        rows.append((d, " ".join(own[:20] + short + own[20:40] + (long if pick.random() < 0.3 else []) + own[40:] + (["same"] * 120 if d % 50 == 0 else []))))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    monkeypatch.setattr(substring_dedup, "LARGE_GROUP", 50)
    monkeypatch.setattr(substring_dedup, "GROUP_SUFFIXES", 200)
    monkeypatch.setattr(substring_dedup, "TREE_WINDOWS", 300)
    split = []
    whole = substring_dedup._owners_by_window
    monkeypatch.setattr(substring_dedup, "_owners_by_window", lambda *a: split.append(whole(*a)) or split[-1])
    trees = substring_dedup.suffix_owners

    def measured(group, texts, doc, span):
        size = sum(len(t.split()) - span + 1 for t in texts)
        assert size <= 500, size
        return trees(group, texts, doc, span)
    monkeypatch.setattr(substring_dedup, "suffix_owners", measured)
    got = substring_dedup.remove_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got)) == [(d, n, g, hashlib.sha256(k.encode()).hexdigest()) for d, n, g, k in brute.remove_repeats(rows)]
    assert split and split[0].count() > 200


def test_suffix_owners_finds_the_least_document():
    texts = [b"a b c d", b"b c d e", b"a b c d", b"b c d e"]
    owners = substring_dedup.suffix_owners(np.array([1, 1, 1, 2]), texts, np.array([5, 3, 9, 4]), 3)
    assert [o.tolist() for o in owners] == [[5, 3], [3, 3], [5, 3], [4, 4]]


def _report(df):
    return simhash.fingerprint_report(df)


def test_edited_texts(small):
    rows = sorted((tuple(r) for r in small.select("doc_id", "text").collect()), reverse=True)
    got = {r.doc_id: r for r in _report(small).collect()}
    better = 0
    for i, (d, t) in enumerate(rows):
        third, after = len(t) // 3, rows[(i + 1) % len(rows)]
        assert got[d].n_chars == len(t)
        assert got[d].edited_sha256 == hashlib.sha256((t[:len(t) - third] + after[1][:third]).encode()).hexdigest()
        bits = bin(int(got[d].fingerprint, 16) ^ int(got[after[0]].fingerprint, 16)).count("1")
        assert got[d].near_next == 1 - bits / 128
        better += got[d].near_edited > got[d].near_next
    assert better >= 0.97 * len(rows)
    by_text = {}
    for d, t in rows:
        assert by_text.setdefault(t, got[d].fingerprint) == got[d].fingerprint


def test_fingerprints_of_odd_rows(odd, odd_rows, empty):
    got = _report(odd).collect()
    assert sorted(r.doc_id for r in got if r.doc_id is not None) == sorted(d for d, _ in odd_rows if d is not None)
    assert len(got) == len(odd_rows)
    assert all(0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1 for r in got)
    blank = {r.fingerprint for r in got if r.doc_id in (5, 6, 7)}
    assert len(blank) == 1
    assert _report(empty).count() == 0


def test_next_row_wraps_and_skips_gaps(spark):
    ids = [3, 255, 256, 257, 5000, 2_000_000, -7, 40_000_000_000]
    df = spark.createDataFrame([(i, 0, f"t{i}") for i in ids], "doc_id long, tkey long, text string").repartition(4)
    got = {r.doc_id: r.n for r in simhash.with_next(df, {"n": "text"}).collect()}
    line = sorted(ids, reverse=True)
    assert got == {d: f"t{line[(i + 1) % len(line)]}" for i, d in enumerate(line)}


@pytest.mark.parametrize("radius", [0, 3, simhash.RADIUS])
def test_search_within_a_radius_is_exact(spark, radius):
    random = np.random.default_rng(1)
    values = [int.from_bytes(random.bytes(16), "big") for _ in range(60)]
    for v in values[:40]:
        flips = random.choice(128, random.integers(1, 10), replace=False)
        values.append(v ^ sum(1 << int(b) for b in flips))
    rows = [tuple(int.from_bytes(v.to_bytes(16, "big")[s:s + 8], "big", signed=True) for s in (0, 8)) for v in values]
    df = spark.createDataFrame(rows, "high long, low long").distinct()
    got = [tuple(r) for r in simhash.within_radius(df, df, radius).select("high", "low", "near_high", "near_low").collect()]
    want = {(*rows[i], *rows[j]) for i, x in enumerate(values) for j, y in enumerate(values) if bin(x ^ y).count("1") <= radius}
    assert len(got) == len(set(got)) and set(got) == want


def test_next_rows_of_sparse_ids(spark):
    """Ids far apart: every span holds one row, and no window holds more than one range of spans."""
    random = np.random.default_rng(4)
    ids = sorted({int(i) for i in random.integers(-2**60, 2**60, 300)}, reverse=True)
    rows = spark.createDataFrame([(i, i % 1000) for i in ids], "doc_id long, tkey long").repartition(3)
    got = {r.doc_id: r.after for r in simhash.with_next(rows, {"after": "doc_id"}).collect()}
    assert got == dict(zip(ids, ids[1:] + ids[:1]))


def test_fingerprints_stay_in_the_jvm(small):
    plan = _report(small)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_repeated_rows_of_linked_texts_are_verified_once(spark):
    """Two linked texts of 300 equal rows each, one id or none: every row gets the group, and a pair of texts is compared once."""
    one, two = " ".join(f"w{i}" for i in range(60)), " ".join(f"w{i}" for i in range(58))
    rows = [(7, one)] * 300 + [(9, two)] * 300 + [(None, two + " w58")] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted((r.doc_id or 0, r.component_id) for r in ngram_join.similar_groups(docs).collect())
    assert got == [(0, 7)] * 50 + [(7, 7)] * 300 + [(9, 7)] * 300
    keyed = docs.withColumn("tkey", F.xxhash64("text"))
    repeated = keyed.groupBy(F.col("doc_id").alias("__id"), F.col("tkey").alias("__key")).count().where("count > 1").drop("count")
    assert ngram_join._one_of_repeated(keyed, repeated).count() == 3
