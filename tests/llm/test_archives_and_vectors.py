import hashlib
import types

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import __spark_entry__
import brute
from heliospark.llm import bpe_codec, vector_search, warc
from heliospark.llm.shared import fresh_path

PAGES = [(1, "http://a.example.com/x", "p" * 1500), (2, "http://a.example.com/x", "p" * 1500), (3, None, None), (4, "odd\r\nurl", ""), (5, "https://u@B.example.org:8080/q?a=1#f", "é" * 600),
         (6, "http://c.example.com", "short"), (7, "http://c.example.com", "short"), (8, "http://a.example.com/x", "q\r\n\r\n" * 300), (8, "http://a.example.com/x", "q\r\n\r\n" * 300),
         (None, "http://n.example.com", "p" * 1500)]


def _want(rows):
    best = {}
    for page, _, html in rows:
        payload = (html or "").encode()
        if page is not None:
            best[payload] = max(best.get(payload, page), page)
    out = []
    for page, _, html in rows:
        payload = (html or "").encode()
        kept = best.get(payload)
        revisit = len(payload) >= 1000 and kept is not None and kept != page
        out.append((str(page), len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response", kept if revisit else None))
    return sorted(out, key=str)


def _got(df):
    return sorted(((str(r[0]), *r[1:]) for r in df.collect()), key=str)


def test_archives_round_trip(spark, directory, monkeypatch):
    schema = "page_id long, url string, html string, key string, file string, refers_to string"
    odd = spark.createDataFrame([(*r, "?", "?", "?") for r in PAGES], schema).repartition(3)
    assert _got(warc.round_trip(odd)) == _want(PAGES)
    assert warc.round_trip(odd.limit(0)).count() == 0
    pages = spark.read.parquet(f"{directory}/pages.parquet")
    assert _got(warc.round_trip(pages)) == _want([tuple(r) for r in pages.select("page_id", "url", "html").collect()])


def test_lookup_reads_one_url(spark):
    odd = spark.createDataFrame([*PAGES, *[(100 + i, f"http://h{i % 7}.example.com/{i}", f"page {i}") for i in range(300)]], "page_id long, url string, html string").repartition(4)
    folder = fresh_path(spark, "warc")
    captures = warc.write_archives(odd, folder)
    directory = warc.build_index(captures, folder, lines=7)
    assert directory.count() > 10
    for url, pages in (("http://a.example.com/x", [1, 2, 8, 8]), ("http://h3.example.com/3", [103]), ("http://none.example.com/", [])):
        keys = spark.createDataFrame([(warc.url_key(url),), (None,)], "key string")
        records = warc.read_records(warc.lookup(keys, directory)).collect()
        assert sorted(r.page_id for r in records) == pages
    assert warc.url_key("https://u@B.example.org:8080/q?a=1#f") == "org,example,b:8080)/q?a=1"


@pytest.mark.parametrize("scaled", [False, True])
def test_neighbours(spark, scaled):
    random = np.random.default_rng(8)
    vectors = random.normal(size=(3000, 16)) + 3 * random.normal(size=(12, 16))[random.integers(0, 12, 3000)]
    if scaled:
        vectors *= random.uniform(0.5, 2, (3000, 1))
    vectors = vectors.astype(np.float32).astype(float)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>, label int").repartition(4)
    got = {}
    for r in vector_search.search(df, "vec_id % 20 = 0", list_size=64).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert sorted(got) == list(range(0, 3000, 20))
    found = 0
    for q, hits in got.items():
        scores = (vectors * vectors[q]).sum(1)
        scores[q] = -np.inf
        best = set(np.argsort(-scores, kind="stable")[:20].tolist())
        found += len(best & {v for v, _ in hits})
        assert len(hits) == 20 and all(s == pytest.approx(scores[v], abs=1e-9) for v, s in hits)
        assert hits == sorted(hits, key=lambda h: (-h[1], h[0]))
    assert found >= 0.9 * 20 * len(got)


def test_every_list_within_the_ratio_is_probed():
    """Far more lists than the graph is asked for first, nearly all of them within the ratio of the nearest."""
    random = np.random.default_rng(9)
    graph = vector_search.CentroidGraph(random.normal(size=(600, 48)))
    queries, sizes = random.normal(size=(20, 48)), np.full(600, 100)
    ids, vectors = pa.array(range(20), pa.int64()), [q[:47].tolist() for q in queries]
    batch = pa.RecordBatch.from_arrays([ids, pa.array(vectors, pa.list_(pa.float64()))], names=["vec_id", "v"])
    shared = types.SimpleNamespace(value=(graph, 1.0))
    got = {(q, c) for b in vector_search._probes(shared, sizes, 20)([batch]) for q, c in zip(b.column("query_id").to_pylist(), b.column("list").to_pylist())}
    dist = ((np.column_stack([queries[:, :47], np.zeros(20)])[:, None] - graph.centroids) ** 2).sum(2)
    want = {(q, c) for q in range(20) for c in range(600) if dist[q, c] <= vector_search.RATIO * dist[q].min()}
    assert len(want) > 20 * 40 and want <= got
    assert all(sum(q == i for q, _ in got) < 600 for i in range(20))


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, []), (8, [1.0, 2.0, 3.0]), (20, [0.5, 0.5]), (20, [0.5, 0.5]), (None, [1.0, 1.0])]
    df = spark.createDataFrame([(*r, "?", "?") for r in rows], "vec_id long, embedding array<float>, list string, v string")
    got = sorted(tuple(r) for r in vector_search.search(df, "vec_id % 20 = 0").collect())
    assert got == [(0, 1, 1, 1.0), (0, 2, 20, 0.5), (20, 1, 0, 0.5), (20, 2, 1, 0.5)]
    assert vector_search.search(df.limit(0), "vec_id % 20 = 0").count() == 0


def test_equal_vectors_are_ordered_by_id(spark):
    df = spark.createDataFrame([(i, [0.6, 0.8]) for i in range(100)], "vec_id long, embedding array<float>")
    got = vector_search.search(df, "vec_id % 20 = 0").where("query_id = 0").orderBy("rank").collect()
    assert [r.vec_id for r in got] == list(range(1, 21))


def test_pipeline_stages(spark, directory):
    docs = spark.read.parquet(f"{directory}/documents.parquet")
    columns = docs.columns
    tokenizer = Tokenizer.from_file(bpe_codec.default_vocabulary())
    before = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    for step, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = fresh_path(spark, "test")
        stage(spark, docs, directory).write.parquet(path)
        docs = spark.read.parquet(path)
        if step < 4:
            assert docs.columns == columns
            rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        if step == 0:
            labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{directory}/labels.parquet").collect()}
            kept = {d for d, _ in rows}
            clean = [d for d, _ in before if labels.get(d) == 1]
            assert sum(d in kept for d in clean) >= 0.95 * len(clean) and set(rows) <= set(before)
        if step == 1:
            assert sorted(rows) == sorted((d, t) for d, t in before if (d, d) in {(g[0], g[2]) for g in brute.similar_groups(before)})
        if step == 2:
            want = {d: (gone, kept) for d, _, gone, kept in brute.remove_repeats(before)}
            texts = dict(before)
            assert dict(rows) == {d: kept if gone else texts[d] for d, (gone, kept) in want.items()}
        if step == 3:
            assert set(rows) <= set(before)
            total = sum(len(brute.words(t)) for _, t in before)
            assert abs(sum(len(brute.words(t)) for _, t in rows) - 1.5 * total) <= 0.2 * total
        if step == 4:
            texts = dict(before)
            assert docs.count() == len(before)
            for r in docs.collect():
                assert r.ids == tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids
        before = rows if step < 4 else before


def test_every_operator_is_registered():
    names = __spark_entry__.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10
    assert "pipeline" in names
