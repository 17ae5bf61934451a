"""A training corpus from raw documents: quality, near duplicates, repeated passages, source mix, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heliospark.llm import bpe_codec, ngram_join, quality_rff, source_mix, substring_dedup
from heliospark.llm.shared import fresh_path, read

ORACLE_SQL = None  # hashes, a fitted classifier and a tokenizer are beyond SQL; tests compare with plain Python


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; it learns from the labels of the documents it gets."""
    return quality_rff.keep_good(docs, read(spark, sf_dir, "labels"))


def one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by Jaccard similarity of at least 0.75 over five-word shingles."""
    return ngram_join.one_of_each(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that an earlier document holds are cut; a document cut to nothing stays, empty."""
    whole = docs.withColumn("__row", F.struct(*(c for c in docs.columns if c not in ("text", "n_chars"))))
    cut = substring_dedup.remove_repeats(whole, carry=("__row",))
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return cut.select(*(new[c].alias(c) if c in new else F.col("__row")[c].alias(c) for c in docs.columns))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources come near their target weights."""
    return source_mix.repeated(docs, source_mix.mix(docs))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document taken, and digests of the ids and of the decoded text."""
    return bpe_codec.digests(docs, carry=("doc_id", "source"), with_ids=True)


STAGES = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", one_of_similar),
    ("substring dedup", without_repeats),
    ("mixing sources", mixed_sources),
    ("BPE encoding", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
