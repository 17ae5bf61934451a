"""Corpus queries against their SQL twins, on the smallest fixture and on odd rows."""

from types import SimpleNamespace

import pytest

from compare import canonical, compare, oracle
from heliospark.llm import ngram_join, prefix_trie, substring_dedup
from heliospark.llm.queries import ORACLE_SQL, QUERIES


def _written(spark, df, tmp_path, table):
    """The rows as one file of a folder, as DuckDB reads them; a connection over it."""
    df.toPandas().to_parquet(f"{tmp_path}/{table}.parquet")
    return oracle(str(tmp_path))


def _rows(con, name):
    cursor = con.execute(ORACLE_SQL[name])
    return canonical([d[0] for d in cursor.description], cursor.fetchall())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, duck, directory, name):
    verdict, _, rows = compare(spark, duck, SimpleNamespace(run=QUERIES[name], sql=ORACLE_SQL[name]), directory)
    assert verdict == "ok" and rows


def test_odd_texts_match_sql(spark, odd, tmp_path):
    known = odd.select("doc_id", "text").where("doc_id IS NOT NULL")
    con = _written(spark, known, tmp_path, "documents")
    groups = ngram_join.similar_groups(known).select("doc_id", "n_shingles", "component_id")
    assert canonical(groups.columns, groups.collect()) == _rows(con, "op6_ngram_jaccard_join")
    cut = substring_dedup.remove_repeats(known).drop("kept_text")
    assert canonical(cut.columns, cut.collect()) == _rows(con, "op10_substring_dedup")


def test_odd_conversations_match_sql(spark, tmp_path):
    rows = [(c, t, "user" if t % 2 else None, None if t == 3 else f"turn {t} {c % 3}") for c in (-7, 0, 1, 2, 5, 8, 10, 11, 40) for t in range(12 - abs(c) % 5)]
    rows += [(3, None, "user", "first"), (3, 4, "user", "one"), (3, 4, "assistant", "tie"), (3, 4, "user", "two"), (4, 0, "", "")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    trie = prefix_trie.prefix_trie(frame)
    assert canonical(trie.columns, trie.collect()) == _rows(_written(spark, frame, tmp_path, "conversations"), "op12_prefix_trie")
