"""Dense numbers within keys, and ids by which every different document has one of its own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagemill.sources.storage import stage, stage_sized

# Bits of `monotonically_increasing_id` that count the rows of a partition.
ROW_BITS = 33


def numbered(rows: DataFrame, order: Sequence[str], name: str) -> tuple[DataFrame, int]:
    """`rows` with `_index`, dense from 0 within `_key` in `order`, and `_n`, the rows of the key; and their number.

    The rows are written once as they are read, so that finding the ranges of the sort does not compute
    them again, and once in order; equal rows are told apart by where they were read, so many
    of them still spread over partitions. A key's rows in a partition are counted, not looked at, so a hot
    key costs one number per partition.
    """
    marked = stage(rows.withColumn("_tie", F.monotonically_increasing_id()), f"{name}-read")
    in_order = marked.orderBy("_key", *order, "_tie").drop("_tie")
    placed = stage(in_order.withColumn("_place", F.monotonically_increasing_id()), name)
    placed = placed.withColumn("_part", F.shiftright("_place", ROW_BITS))
    per_part = placed.groupBy("_part", "_key").agg(F.count(F.lit(1)).alias("_rows"), F.min("_place").alias("_first"))
    of_key = Window.partitionBy("_key")
    before = of_key.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts, small = stage_sized(
        per_part.select(
            "_part", "_key",
            (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
            F.sum("_rows").over(of_key).alias("_n"),
            "_rows",
        ),
        f"{name}-starts",
    )
    total = starts.agg(F.sum("_rows")).first()[0] or 0
    found = placed.join(F.broadcast(starts) if small else starts, ["_part", "_key"])
    index = (F.col("_place") + F.col("_shift")).alias("_index")
    return found.select(*[c for c in rows.columns], index, "_n"), total


def identified(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, row): a number of its own for each different (key, text), its text, and the whole row.

    Numbers ascend with keys, null first; texts of one key are in a fixed order. Rows equal in key and text
    have one number. Where no key is null or repeats, which only the keys are read for, it is the key
    itself. Else a text is known by a digest of 128 bits, and numbers are places in a global sort.
    """
    own = F.col(f"`{key}`").cast("long")
    whole = F.struct(*[F.col(f"`{c}`") for c in documents.columns])
    rows = documents.select(own.alias("doc_id"), F.col(f"`{text}`").alias("text"), whole.alias("row"))
    keys = documents.select(own.alias("doc_id")).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    if keys.filter((F.col("n") > 1) | F.col("doc_id").isNull()).isEmpty():
        return rows
    marked = rows.withColumns({"first": F.xxhash64("text"), "second": F.xxhash64(F.lit(1), "text")})
    texts = marked.select(F.lit("").alias("_key"), "doc_id", "first", "second").distinct()
    numbers, _ = numbered(texts, ["doc_id", "first", "second"], "texts")
    numbers, small = stage_sized(
        numbers.select(F.col("doc_id").alias("id"), F.col("first").alias("a"), F.col("second").alias("b"), "_index"), "numbers"
    )
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("first") == F.col("a")) & (F.col("second") == F.col("b"))
    found = marked.join(F.broadcast(numbers) if small else numbers, same)
    return found.select(F.col("_index").alias("doc_id"), "text", "row")
