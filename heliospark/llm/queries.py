"""The corpus operators as queries over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from heliospark.llm import (
    bpe_codec, conversation_repair, license_scan, ngram_join, packing, prefix_trie, quality_rff, simhash, source_mix,
    substring_dedup, token_counts, vector_search, warc)
from heliospark.llm.shared import read
from heliospark.llm.sql import ORACLE_SQL  # noqa: F401


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(read(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read(spark, sf_dir, "documents"))


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_quality_rff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rff.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")).drop("tkey")


def op5_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.digests(read(spark, sf_dir, "documents"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = ngram_join.similar_groups(read(spark, sf_dir, "documents"))
    return groups.select("doc_id", "n_shingles", "component_id")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read(spark, sf_dir, "pages"))


def op8_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.search(read(spark, sf_dir, "embeddings"), "vec_id % 20 = 0")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.fingerprint_report(read(spark, sf_dir, "documents"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(read(spark, sf_dir, "documents")).drop("kept_text")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(read(spark, sf_dir, "conversations"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(read(spark, sf_dir, "conversations"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_license_scan, op2_token_counts, op3_source_mix, op4_quality_rff, op5_bpe_codec, op6_ngram_jaccard_join,
    op7_warc, op8_vector_search, op9_simhash, op10_substring_dedup, op11_conversation_repair, op12_prefix_trie, op13_packing)}
