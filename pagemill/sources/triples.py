"""Building triple tables from relational ones."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagemill.functions.text import ColumnLike, as_column
from pagemill.schemas import TRIPLES
from pagemill.sources.storage import stage

# Text of triples that one task writes, and the least in small tables.
TASK_BYTES = 32 * 1024 * 1024
LEAST_BYTES = 1024 * 1024
# To so many tasks Spark shuffles without buffering what a task reads; until then a task's text may grow to MOST_BYTES.
TASKS = 200
MOST_BYTES = 256 * 1024 * 1024


class Statement(NamedTuple):
    """One fact per row: a predicate, the column with its object, and the language of a text."""

    predicate: str
    value: ColumnLike
    lang: ColumnLike | None = None

    def columns(self) -> list[Column]:
        language = F.lit(None).cast("string") if self.lang is None else as_column(self.lang)
        value = as_column(self.value).cast("string")
        return [F.lit(self.predicate).alias("p"), value.alias("o"), language.alias("lang")]


def triples_from(df: DataFrame, subject: ColumnLike, statements: Sequence[Statement]) -> DataFrame:
    """(s, p, o, lang) rows in one scan; a statement whose object is NULL gives no triple."""
    facts = F.explode(F.array(*[F.struct(*s.columns()) for s in statements]))
    return (
        df.select(as_column(subject).cast("string").alias("s"), facts.alias("_fact"))
        .select("s", "_fact.p", "_fact.o", "_fact.lang")
        .where(F.col("o").isNotNull())
    )


def triple_view(df: DataFrame, subject: ColumnLike, statements: Sequence[Statement]) -> DataFrame:
    """The same triples with one scan per statement.

    Made for querying without storing them: a pattern on one predicate reads the columns of that
    statement only, the other scans are pruned from the plan.
    """
    node = as_column(subject).cast("string").alias("s")
    parts = [df.select(node, *s.columns()).where(F.col("o").isNotNull()) for s in statements]
    return reduce(DataFrame.unionAll, parts)


def write_triples(triples: DataFrame, path: str, mode: str = "error") -> None:
    """A triple table partitioned by predicate, so that a pattern reads only its own files.

    Each predicate is measured, and its rows are dealt to places behind those of the predicates before it;
    a task writes TASK_BYTES of places, and up to MOST_BYTES where that takes more than TASKS tasks. So the rows of rare predicates are gathered, those of common ones are
    split however few splits they are read in, and the sort of a task stays small. `triples` is read
    twice: hand in a table or a staged result. `mode` is that of Spark's writers.
    """
    size = F.lit(16)
    for column in triples.columns:
        size = size + F.coalesce(F.octet_length(column), F.lit(0))
    before = Window.orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    # One row per predicate, of which each has a folder.
    sizes = triples.groupBy(F.col("p").alias("_of")).agg(F.sum(size).alias("_bytes"))
    sizes = stage(sizes.withColumn("_before", F.coalesce(F.sum("_bytes").over(before), F.lit(0))), "predicates")
    total = sizes.agg(F.sum("_bytes")).first()[0] or 0
    each = min(TASK_BYTES, max(LEAST_BYTES, total // triples.sparkSession.sparkContext.defaultParallelism + 1))
    each = max(each, min(MOST_BYTES, total // TASKS + 1))
    # Content and partition decide the place, so a repeated task repeats it.
    dealt = F.pmod(F.xxhash64(*triples.columns, F.spark_partition_id()), F.col("_bytes"))
    task = F.call_function("div", F.col("_before") + dealt, F.lit(each)).cast("int")
    rows = triples.join(F.broadcast(sizes), F.col("p").eqNullSafe(F.col("_of")), "left")
    placed = rows.select(*triples.columns, F.coalesce(task, F.lit(0)).alias("_task"))
    spread = placed.repartitionById(total // each + 1, "_task").drop("_task")
    spread.write.mode(mode).partitionBy("p").parquet(path)


def read_triples(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TRIPLES).parquet(path).select("s", "p", "o", "lang")
