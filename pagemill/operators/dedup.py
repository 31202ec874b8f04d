"""Counting and deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"))


def dedup_keep_first(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per `key`: the first by `order`. NULL keys count as one group.

    An aggregate rather than a window: each task keeps one candidate per key before the shuffle, so
    a key that holds a large part of the rows costs no more than any other.
    """
    first = F.min_by(F.struct(*df.columns), F.struct(*order))
    return df.groupBy(F.col(key).alias("_key")).agg(first.alias("_first")).select("_first.*")


def dedup_any(df: DataFrame, key: str) -> DataFrame:
    """One row per `key`, whichever; NULL keys count as one group."""
    return df.dropDuplicates([key])
