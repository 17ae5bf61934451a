"""Fingerprints against a plain vote, and the classifier's summed equations against one fit over all rows."""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from heliospark.llm import quality_rff, simhash


def _plain_votes(spark, texts: dict[int, str]) -> dict[int, tuple[int, int]]:
    """Signed votes of every word pair, counted one by one; only the hashes come from Spark."""
    pairs = []
    for key, text in texts.items():
        words = re.split(r"[\x20\x09-\x0D]+", (text or "").strip(" \t\n\x0b\x0c\r"))
        pairs += [(key, a, b) for a, b in zip(words, [*words[1:], None])]
    hashed = spark.createDataFrame(pairs, "k long, a string, b string").withColumn("high", F.xxhash64("a", "b"))
    votes = defaultdict(lambda: np.zeros((2, 64), int))
    for r in hashed.withColumn("low", F.xxhash64("high", F.lit(1))).collect():
        for side, h in enumerate((r.high, r.low)):
            votes[r.k][side] += [1 if h >> bit & 1 else -1 for bit in range(64)]
    signed = {k: [sum(1 << bit for bit in range(64) if v[side][bit] > 0) for side in (0, 1)] for k, v in votes.items()}
    return {k: tuple(x - (1 << 64) if x >> 63 else x for x in both) for k, both in signed.items()}


def test_fingerprints_equal_a_plain_vote(spark, odd_rows):
    texts = {i: text for i, (_, text) in enumerate(odd_rows) if text is None or len(text) < 20_000}
    frame = spark.createDataFrame(list(texts.items()), "k long, body string").repartition(3)
    got = {r.k: (r.high, r.low) for r in simhash.fingerprints(frame, ("k",)).collect()}
    assert got == _plain_votes(spark, texts)


def test_summed_equations_equal_one_fit_over_all_rows(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(500, quality_rff.STATISTICS)) * 3 + 1
    y, fold = (x[:, 0] > 1).astype(float), rng.integers(0, 2, 500)
    rows = [(list(map(float, a)), float(b), int(c)) for a, b, c in zip(x, y, fold)]
    df = spark.createDataFrame(rows, "x array<double>, label double, fold long").repartition(7)
    total = quality_rff._summed(df.select("x"), quality_rff._moments)[0]
    assert np.allclose(total[:quality_rff.STATISTICS], x.sum(0)) and total[-1] == 500
    mapped = quality_rff.Map(x.mean(0), x.std(0), 64, 3.0, 5)
    sums = quality_rff._summed(df, quality_rff._equations(spark.sparkContext.broadcast(mapped)))
    z = mapped(x)
    for k in (0, 1):
        part, size = fold == k, z.shape[1] + 1
        got = quality_rff.solve(sums[k].reshape(size, size), 1e-3)
        penalty = np.full(z.shape[1], 1e-3 * part.sum() + 0.05)
        penalty[-1] = 1e-9
        want = np.linalg.lstsq(np.vstack([z[part], np.diag(np.sqrt(penalty))]), np.append(y[part], np.zeros(z.shape[1])), rcond=None)[0]
        assert np.allclose(got, want, atol=1e-6)
