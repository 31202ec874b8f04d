"""A training corpus in five stages. Each takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's docs; all but the last return documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm.bpe_codec import bpe_round_trip
from pagemill.llm.common import read_table
from pagemill.llm.decontaminate import find_benchmark
from pagemill.llm.ngram_join import ngram_groups
from pagemill.llm.numbering import identified
from pagemill.llm.quality import keep_good
from pagemill.llm.sentence_dedup import dedup_sentences
from pagemill.sources.storage import stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the row with the smallest doc_id stays, one without id only if none
    has one, and of several with that id one by a digest. Rows that are equal in id and text are one
    document; rows with one id and different texts are different documents."""
    rows = identified(docs)
    groups = ngram_groups(rows.select("doc_id", "text")).select("doc_id", "component_id").distinct()
    # Numbers ascend with doc_id, null first.
    rank = F.struct(F.col("row.doc_id").isNull().alias("none"), "doc_id")
    first = (
        rows.select("doc_id", rank.alias("rank")).distinct().join(groups, "doc_id")
        .groupBy("component_id").agg(F.min("rank").alias("first")).select(F.col("first.doc_id").alias("doc_id"))
    )
    return rows.join(first, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select("row.*")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sentences of passages that came before go; a document of which nothing is left goes as well."""
    found = dedup_sentences(docs)
    left = (F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_sentences"))
    cut = found.filter(left)
    if "n_chars" in docs.columns:
        changed = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
        cut = cut.withColumn("n_chars", changed)
    return cut.select(*docs.columns)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    rows = identified(docs)
    found = find_benchmark(rows.select("doc_id", "text"), read_table(spark, sf_dir, "benchmark"))
    hit = found.filter(F.size("runs") > 0).select("doc_id").distinct()
    return rows.join(hit, "doc_id", "left_anti").select("row.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of each document's token ids, and the digest of the text they decode to."""
    return bpe_round_trip(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality),
    ("ngram_join", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("decontamination", benchmark_passages),
    ("bpe_codec", tokens),
]

# Robust estimates, clause cuts and merges are beyond SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder before the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage_function in STAGES:
        docs = stage(stage_function(spark, docs, sf_dir), name)
    return docs
