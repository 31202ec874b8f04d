"""Unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all_list(dfs: list[DataFrame]) -> DataFrame:
    """Union by position; duplicates stay."""
    return reduce(DataFrame.unionAll, dfs)


def append_by_name(dfs: list[DataFrame], rank: str | None = "source_rank") -> DataFrame:
    """Union by name with NULL for missing columns; `rank` numbers the inputs from 0."""
    if rank is not None:
        dfs = [df.withColumn(rank, F.lit(number)) for number, df in enumerate(dfs)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
