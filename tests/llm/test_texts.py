import hashlib
import random
from collections import defaultdict

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from heliospark.llm import bpe_codec, license_scan, quality_rff, source_mix, token_counts

ALPHABET = "aAbÉéßΣσςİı 'stREl d1²½١ⅷ㎏ǅﬁé中文\x1c\x1f\x85\xa0 　\n\t\r\x0b  <|endoftext|> <|startoftext|>😀🇩🇪́̈\x00.,!?—_"


def _odd_texts():
    pick = random.Random(5)
    return ["".join(pick.choice(ALPHABET) for _ in range(pick.randint(0, 60))) for _ in range(800)] + [
        "x" * 1000, "ab" * 5000, "<|endoftext|>" * 3 + "a<|endoftext|>b's", "", " ", "it's we'll THEY'RE"]


@pytest.fixture(scope="module")
def byte_tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def word_tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_counts_are_the_library_s(spark, odd_rows, odd, empty, byte_tokenizer):
    rows = [(i, t) for i, t in enumerate(_odd_texts() + [t for _, t in odd_rows])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = [(i, len((t or "").encode()), len(byte_tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t in rows]
    for chunk, overlap in ((1 << 16, 512), (300, 8), (2000, 64)):
        got = token_counts.token_counts(df, chunk=chunk, overlap=overlap, limit=20).collect()
        assert sorted((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
        assert all(r.over_limit == (r.n_tokens > 20) for r in got)
    assert token_counts.token_counts(odd, chunk=300, overlap=8).count() == len(odd_rows)
    assert token_counts.token_counts(empty).count() == 0


def test_pieces_that_do_not_align_are_refused():
    piece = (0, 10, np.array([3]), np.array([1]), 4)
    assert token_counts.splice([piece, (5, 15, np.array([2]), np.array([1]), 4)]) is None
    assert token_counts.splice([piece, (2, 15, np.array([1]), np.array([1]), 6)]) == 1 + 6 - 1


def test_codec_is_the_library_s(spark, odd, odd_rows, empty, word_tokenizer):
    texts = _odd_texts() + [t for _, t in odd_rows]
    codec = bpe_codec.codec(bpe_codec.default_vocabulary())
    for text in texts:
        want = word_tokenizer.encode(text or "", add_special_tokens=False).ids
        assert codec.encode(text) == want
        assert codec.decode(want) == word_tokenizer.decode(want, skip_special_tokens=False)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in bpe_codec.digests(df, with_ids=True).collect():
        ids = word_tokenizer.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert (r.n_tokens, r.ids) == (len(ids), ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(word_tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    back = bpe_codec.decode(bpe_codec.encode(df)).collect()
    assert all(r.decoded == codec.decode(codec.encode(texts[r.doc_id])) for r in back)
    assert bpe_codec.digests(odd).count() == len(odd_rows) and bpe_codec.digests(empty).count() == 0


def test_short_and_long_words_merge_alike():
    codec = bpe_codec.codec(bpe_codec.default_vocabulary())
    pick = random.Random(2)
    for _ in range(200):
        raw = bytes(pick.choice(b"etaoinshrdlu") for _ in range(pick.randint(1, 60)))
        parts = [codec.inner[b] for b in raw[:-1]] + [codec.last[raw[-1]]]
        assert codec.merge(list(parts)) == codec._merge_long(list(parts))


def _shares(sizes, share=1.5, most=2.0):
    """Targets by repeated dealing."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, open_, target = share * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if level * weight[s] >= most * sizes[s]]
        if not full:
            return target | {s: level * weight[s] for s in open_}
        for s in full:
            target[s] = most * sizes[s]
            left -= target[s]
            open_.remove(s)
    return target


@pytest.mark.parametrize("table", ["odd", "small"])
def test_mix(request, table):
    df = request.getfixturevalue(table)
    rows = [tuple(r) for r in df.select("doc_id", "text", "source").collect()]
    got = source_mix.mix(df).collect()
    assert sorted(str((r.doc_id, r.size, r.source)) for r in got) == sorted(str((d, len(brute.words(t)), s)) for d, t, s in rows)
    sizes, largest, taken = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in got:
        sizes[r.source] += r.size
        largest[r.source] = max(largest[r.source], r.size)
        taken[r.source] += r.taken
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 2
    want = _shares(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 2 * largest[s]
    assert sorted(map(str, source_mix.mix(df.repartition(5)).collect())) == sorted(map(str, got))


def test_mix_of_nothing(empty, small):
    assert source_mix.mix(empty).count() == 0
    plan = source_mix.mix(small)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_repeated_documents(odd):
    mixed = source_mix.mix(odd)
    out = source_mix.repeated(odd, mixed)
    assert out.columns == odd.columns
    assert out.count() == mixed.agg(F.sum("copies")).first()[0]


def test_quality_on_held_out_documents(spark, small, directory):
    labels = spark.read.parquet(f"{directory}/labels.parquet")
    got = quality_rff.score(small, labels).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in got) >= 0.9 * len(got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    good, bad = ([r.score for r in got if r.quality == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) >= 0.95


def test_quality_of_odd_rows(spark, odd, odd_rows, empty):
    nothing = spark.createDataFrame([(1, None)], "doc_id long, quality int")
    got = quality_rff.score(odd, nothing).collect()
    assert len(got) == len(odd_rows) and all(r.score == 0.5 and r.predicted == 1 for r in got)
    one = spark.createDataFrame([(d, 1) for d in range(1, 9)], "doc_id long, quality int")
    assert all(0 <= r.score <= 1 for r in quality_rff.score(odd, one).collect())
    assert quality_rff.score(empty, one).count() == 0
    assert quality_rff.keep_good(odd, nothing).columns == odd.columns


def test_isotonic_is_the_best_monotone_fit():
    xs, ys = quality_rff.isotonic(np.array([1, 0, 3, 1, 4.0]), np.array([2, 0, 4, 4, 4.0]))
    assert (np.diff(ys) >= 0).all()
    assert np.interp([0, 2, 3, 4], xs, ys).tolist() == [0.5, 0.5, 0.5, 1.0]


def test_normal_equations_match_a_direct_fit():
    random_ = np.random.default_rng(0)
    x, y = np.column_stack([random_.normal(size=(50, 3)), np.ones(50)]), random_.normal(size=50)
    rows = np.column_stack([x, y])
    got = quality_rff.solve(rows.T @ rows, 0.1)
    penalty = np.diag([0.1 * 50 + 0.05] * 3 + [1e-9])
    assert np.allclose(got, np.linalg.solve(x.T @ x + penalty, x.T @ y))


def test_licences(spark, odd, odd_rows, empty):
    texts = ["Released under the MIT License.", "x\nlicensed  under the APACHE license version 2.0\ny", "Licensed to drive", None, "",
             license_scan.TEMPLATES["ISC"].replace(". ", ".\n"), "before\n\n" + license_scan.TEMPLATES["MIT"] + "\n\nafter"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in license_scan.license_scan(df).collect()}
    assert [got[i].best_license for i in range(7)] == ["MIT-notice", "Apache-2.0-notice", None, None, None, "ISC", "MIT"]
    assert license_scan.license_scan(odd).count() == len(odd_rows) and license_scan.license_scan(empty).count() == 0


def _every_run(text, templates, threshold):
    """Dice of each template with every run of words."""
    words = license_scan.normalised(text)
    found = {}
    for name, template in templates.items():
        wanted = license_scan.bigrams(license_scan.normalised(template))
        m, best = sum(wanted.values()), None
        for i in range(len(words) - 1 if m else 0):
            left, common = dict(wanted), 0
            for j in range(i + 1, len(words)):
                g = words[j - 1], words[j]
                if left.get(g, 0):
                    left[g] -= 1
                    common += 1
                dice = 2 * common / (j - i + m)
                if dice >= threshold and (best is None or dice > best[0]):
                    best = dice, i, j - i + 1
        if best:
            found[name] = best
    return found


def test_pruning_loses_no_run_of_words():
    """Against every template compared with every run, texts read whole and in small pieces."""
    pick = random.Random(4)
    templates = {n: license_scan.TEMPLATES[n] for n in ("MIT-notice", "Apache-2.0-notice", "GPL-3.0-notice", "CC-BY-4.0-notice", "CC-BY-SA-4.0-notice", "MPL-2.0", "GPL-3.0-header")}
    templates |= {"repeats": "a b a b a c a b", "word": "one", "none": "?!"}
    for threshold in (0.8, 0.6):
        matcher = license_scan.Matcher(templates, threshold)
        hits = 0
        for _ in range(60):
            words = []
            for _ in range(pick.randint(1, 3)):
                part = pick.choice(list(templates.values())).split()
                for _ in range(pick.randint(0, max(1, len(part) // 5))):
                    at = pick.randrange(len(part))
                    part[at:at + pick.randint(0, 1)] = [pick.choice(["other", "the", "license", "a", "b"])]
                words += part + [pick.choice(["under the", "a b", "x", "this work is"])] * pick.randint(0, 3)
            text = " ".join(words)
            want = _every_run(text, templates, threshold)
            hits += len(want)
            assert matcher.scan(text) == want
            assert matcher.scan(text, 7) == want
        assert hits > 30


def test_licences_inside_files(spark):
    """Whole licences as files carry them: after names, in comments, over several paragraphs, in mid-line, in very long texts."""
    def commented(name):
        words = license_scan.TEMPLATES[name].split()
        return "/*\n * Copyright (c) 2020 Some Body\n *\n" + "".join(f" * {' '.join(words[i:i + 11])}\n" + " *\n" * (i % 33 == 0) for i in range(0, len(words), 11)) + " */\nint main() { return 0; }\n"
    files = {n: commented(n) for n in license_scan.TEMPLATES}
    filler = "words of a long text that names no licence and a copy of the source " * 20_000
    middle = {n: filler + license_scan.TEMPLATES[n] + " " + filler for n in ("BSD-3-Clause", "CC-BY-NC-4.0-notice")}
    texts = [*files.items(), *middle.items(), ("MIT", (license_scan.TEMPLATES["MIT"] + "\n") * 500), ("ISC", "x" * 3_000_000 + " " + license_scan.TEMPLATES["ISC"])]
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(texts)] + [(len(texts), filler)], "doc_id long, text string")
    got = {r.doc_id: r for r in license_scan.license_scan(df).collect()}
    for i, (name, _) in enumerate(texts):
        assert name in got[i].licenses and got[i].scores[got[i].licenses.index(name)] == 1 == got[i].best_score, name
    assert got[len(texts)].licenses == []
    exact = got[len(files) + 1]
    assert exact.first_words == [len(license_scan.normalised(filler))] and exact.n_words == [len(license_scan.normalised(license_scan.TEMPLATES["CC-BY-NC-4.0-notice"]))]



def test_equal_rows_of_two_sources_keep_their_own_copies(spark):
    rows = [(7, "same words here", s) for s in ("a", "a", "b", None)] + [(i, f"filler {i} of b " * 3, "b") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    mixed = source_mix.mix(docs)
    want = {(r.doc_id, r.source): r.n for r in mixed.groupBy("doc_id", "source").agg(F.sum("copies").alias("n")).where("n > 0").collect()}
    got = {(r.doc_id, r.source): r["count"] for r in source_mix.repeated(docs, mixed).groupBy("doc_id", "source").count().collect()}
    assert got == want
