"""Finding hot keys with mergeable sketches, and joins that spread them over many tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.sources.storage import BROADCAST_BYTES, stage_sized

# A key is hot when it holds this share of the rows, and at least this many rows.
HOT_SHARE = 0.01
HOT_ROWS = 1_000_000
# Counters of one sketch. Every key above the share is certain to be found.
SKETCH_ITEMS = 1024
# Sketches are merged in this many tasks first and then once per group.
SKETCH_BRANCHES = 64
# Tasks over which the rows of one hot key are spread.
FANOUT = 32


def key_sketches(df: DataFrame, by: str, columns: Sequence[str]) -> DataFrame:
    """One row per group of `by`: its rows, and for each column the NULLs and a sketch of frequent values.

    One pass; sketches have a fixed size and are merged in two steps. Rows of several tables can be kept
    in one: `hot_in_sketches` merges those of one group.
    """
    branch = F.pmod(F.spark_partition_id(), F.lit(SKETCH_BRANCHES))
    nulls = [F.count_if(F.col(c).isNull()).alias(f"_nulls_{c}") for c in columns]
    items = F.lit(SKETCH_ITEMS)
    sketches = [
        F.call_function("approx_top_k_accumulate", F.col(c), items).alias(f"_sketch_{c}") for c in columns
    ]
    partial = df.select(by, *columns).groupBy(by, branch.alias("_branch")).agg(
        F.count("*").alias("_rows"), *nulls, *sketches
    )
    return merged_sketches(partial, by, columns)


def merged_sketches(sketches: DataFrame, by: str, columns: Sequence[str]) -> DataFrame:
    """One row per group out of several."""
    sums = [F.sum(name).alias(name) for name in ("_rows", *[f"_nulls_{c}" for c in columns])]
    combined = [
        F.call_function("approx_top_k_combine", F.col(f"_sketch_{c}"), F.lit(SKETCH_ITEMS)).alias(f"_sketch_{c}")
        for c in columns
    ]
    return sketches.groupBy(by).agg(*sums, *combined)


def hot_in_sketches(
    sketches: DataFrame,
    by: str,
    columns: Sequence[str],
    share: float = HOT_SHARE,
    min_rows: int = HOT_ROWS,
) -> dict[tuple, list]:
    """Hot values of each column within each group, as {(group, column): values}.

    `sketches` has one row per group. At most 1/share values per group and column reach the driver.
    """
    k = F.lit(round(1 / share))
    found = sketches.select(
        by,
        "_rows",
        *[f"_nulls_{c}" for c in columns],
        *[F.call_function("approx_top_k_estimate", f"_sketch_{c}", k).alias(c) for c in columns],
    )
    hot: dict[tuple, list] = {}
    for row in found.collect():
        limit = max(share * row["_rows"], min_rows)
        for c in columns:
            values = [e["item"] for e in row[c] or [] if e["item"] is not None and e["count"] >= limit]
            if row[f"_nulls_{c}"] >= limit:
                values.append(None)
            if values:
                hot[row[by], c] = values
    return hot


def hot_values_by(
    df: DataFrame,
    by: str,
    columns: Sequence[str],
    share: float = HOT_SHARE,
    min_rows: int = HOT_ROWS,
) -> dict[tuple, list]:
    """Hot values of each column within each group of `by`, as {(group, column): values}.

    One pass with fixed-size sketches; at most 1/share values per group and column reach the driver.
    None stands for a hot NULL. The result only steers how rows are spread, never which rows exist.
    """
    return hot_in_sketches(key_sketches(df, by, columns), by, columns, share, min_rows)


def hot_values(
    df: DataFrame, column: str, share: float = HOT_SHARE, min_rows: int = HOT_ROWS
) -> list:
    """Hot values of one column, with None for NULL."""
    rows = df.select(F.lit(0).alias("_all"), column)
    return hot_values_by(rows, "_all", [column], share, min_rows).get((0, column), [])


def _is_one_of(column: str, values: Sequence) -> Column:
    return F.coalesce(F.col(column).isin(list(values)), F.lit(False))


def row_part(df: DataFrame, fanout: int) -> Column:
    """A number below `fanout`; content and partition decide it, so a repeated task repeats it."""
    hashable = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return F.pmod(F.xxhash64(*hashable, F.spark_partition_id()), F.lit(fanout)).cast("int")


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    how: str,
    hot_left: Sequence = (),
    hot_right: Sequence = (),
    fanout: int = FANOUT,
) -> DataFrame:
    """Equi-join on a text column with its hot keys split up, and the result of a plain join.

    Rows of a key in `hot_left` are spread on the left and copied on the right, so the right side
    should hold few rows for it. Keys in `hot_right` are treated the other way round; each of them
    has to occur on the right. None in `hot_left` spreads the rows without key. All other keys are
    joined as usual, and the engine may still pick a broadcast from measured sizes.
    """
    if hot_right and how not in ("inner", "left"):
        raise ValueError(f"a {how} join needs a right side without repeated keys")
    without_key = None in hot_left and how in ("left", "left_anti")
    hot_left = [v for v in hot_left if v is not None]
    hot_right = [v for v in hot_right if v is not None]

    def copies(values: Sequence) -> Column:
        every = F.array(*[F.lit(i) for i in range(fanout)])
        return F.explode(F.when(_is_one_of(on, values), every).otherwise(F.array(F.lit(0))))

    keys = [on]
    if hot_left:
        keys.append("_left_part")
        part = F.when(_is_one_of(on, hot_left), row_part(left, fanout)).otherwise(F.lit(0))
        left = left.withColumn("_left_part", part)
        right = right.withColumn("_left_part", copies(hot_left))
    if hot_right:
        keys.append("_right_part")
        part = F.when(_is_one_of(on, hot_right), row_part(right, fanout)).otherwise(F.lit(0))
        right = right.withColumn("_right_part", part).withColumn("_found", F.lit(True))
        left = left.withColumn("_right_part", copies(hot_right))
    if without_key:
        # A NULL matches nothing, so such rows may take any keys that do not occur on the right.
        # The right side keeps its own partitioning.
        keys[0] = "_key"
        nowhere = F.concat(F.lit("\u0000"), row_part(left, fanout).cast("string"))
        left = left.withColumn("_key", F.coalesce(F.col(on), nowhere))
        right = right.withColumnRenamed(on, "_key")
    joined = left.join(right, keys, how)
    if hot_right:
        # A copied left row that met no right row in its part met one in another part.
        joined = joined.where(~_is_one_of(on, hot_right) | F.col("_found").isNotNull())
    return joined.drop("_key", "_left_part", "_right_part", "_found")


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    how: str,
    limit: int = BROADCAST_BYTES,
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join with a lookup table that has at most one row per key.

    The lookup is staged and measured. Within `limit` it is broadcast, so the left side is neither
    shuffled nor skewed; beyond it both sides are shuffled and the left's hot keys are spread.
    """
    right, small = stage_sized(right, "lookup", limit)
    if small:
        return left.join(F.broadcast(right), on, how)
    return spread_join(left, right, on, how, hot_left=hot_values(left, on, min_rows=min_rows))
