"""Dense positions and contiguous chunks without a single-task sort."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from pagemill.operators import line_chunks
from pagemill.sources.storage import stage

# Chunks up to which rows look their chunk up among the keys at which chunks begin.
MOST_CUTS = 10_000

Cuts = list[int]
Chunk = Callable[[Column], Column]

_OFFSETS = StructType(
    [StructField("_part_file", StringType()), StructField("_rows_before", LongType()),
     StructField("_weight_before", LongType()), StructField("_blocks_before", LongType())]
)


def _div(value: Column, divisor: int) -> Column:
    return F.call_function("div", value, F.lit(divisor))


def _located(df: DataFrame, order: list[str], weight: str | None) -> tuple[DataFrame, int]:
    """Sorted rows with their staged file, their row in it, and the totals before that file.

    A global sort is written once: each range partition becomes a file, and files are numbered in
    sort order. One count per file, not per row, goes through the driver. Rows that tie in `order`
    are told apart by content and partition, so that many of them do not end up in one range.
    """
    hashable = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    ties = [F.xxhash64(*hashable), F.spark_partition_id()]
    staged = stage(df.orderBy(*order, *ties), "positions").select(
        "*",
        F.col("_metadata.file_name").alias("_part_file"),
        F.col("_metadata.row_index").alias("_part_row"),
    )
    total = F.sum(weight) if weight else F.lit(0)
    parts = staged.groupBy("_part_file").agg(F.count("*").alias("rows"), total.alias("weight")).collect()

    def number(name: str) -> tuple[int, int]:
        fields = name.split(".")[0].split("-")
        return int(fields[1]), int(fields[-1].lstrip("c"))

    offsets, rows, weights, blocks = [], 0, 0, 0
    for part in sorted(parts, key=lambda p: number(p["_part_file"])):
        offsets.append((part["_part_file"], rows, weights, blocks))
        blocks += -(-part["rows"] // line_chunks.BLOCK_LINES)
        rows += part["rows"]
        weights += part["weight"]
    # As many rows as the sort has partitions.
    table = F.broadcast(df.sparkSession.createDataFrame(offsets, _OFFSETS))
    return staged.join(table, "_part_file"), rows


def with_position(df: DataFrame, order: list[str], name: str = "pos") -> tuple[DataFrame, int]:
    """`df` with dense positions 0, 1, 2, … in `order`, and the number of rows."""
    located, rows = _located(df, order, None)
    position = (F.col("_rows_before") + F.col("_part_row")).alias(name)
    return located.select(*df.columns, position), rows


def split_even(df: DataFrame, n: int, order: list[str], name: str = "chunk_id") -> DataFrame:
    """Add the number, from 0, of `n` contiguous chunks; the first `rows % n` have one row more.

    See `_split_at` for what is read and moved.
    """

    def rule(rows: int) -> tuple[Cuts, Chunk]:
        size, longer = divmod(rows, n)
        edge = longer * (size + 1)
        # With size 0 every position lies before the edge, so the divisor 1 is never used.
        starts = [j * size + min(j, longer) for j in range(n)]

        def chunk(pos: Column) -> Column:
            late = F.lit(longer) + _div(pos - edge, max(size, 1))
            return F.when(pos < edge, _div(pos, size + 1)).otherwise(late)

        return starts, chunk

    return _split_at(df, n, order, name, rule)


def split_floor(df: DataFrame, n: int, order: list[str], name: str = "chunk_id") -> DataFrame:
    """Add the number, from 0, of `n` contiguous chunks whose bounds are floor(rows * j / n).

    See `_split_at` for what is read and moved.
    """

    def rule(rows: int) -> tuple[Cuts, Chunk]:
        return [rows * j // n for j in range(n)], lambda pos: _div((pos + 1) * n - 1, max(rows, 1))

    return _split_at(df, n, order, name, rule)


def _split_at(df: DataFrame, n: int, order: list[str], name: str, rule: Callable[[int], tuple[Cuts, Chunk]]) -> DataFrame:
    """Chunks whose first positions follow from the number of rows.

    Only the columns of `order` are sorted and written. The keys at which chunks begin, at most `n`, are
    looked up there, and every row of `df` finds its chunk among them by halving, where it is read:
    other columns are neither sorted nor shuffled nor written. Only rows that tie in `order` across a bound
    are placed one by one, in a fixed order of their content. `df` is read twice, so hand in a table
    or a staged result; from MOST_CUTS chunks on, every row is placed.
    """
    if n > MOST_CUTS:
        placed, rows = with_position(df, order, "_pos")
        return placed.select(*df.columns, rule(rows)[1](F.col("_pos")).cast("int").alias(name))
    keys, rows = with_position(df.select(*order), order, "_pos")
    starts, chunk = rule(rows)
    # A chunk that is empty begins where the next one does.
    begins = sorted({s for s in starts if 0 < s < rows})
    if not begins:
        return df.select("*", chunk(F.lit(0).cast("long")).cast("int").alias(name))
    sides = [(at, at - side) for at in begins for side in (0, 1)]
    positions = df.sparkSession.createDataFrame(sides, "_begin bigint, _pos bigint")
    key = F.struct(*[F.col(f"`{c}`") for c in order])
    cuts = (
        keys.join(F.broadcast(positions), "_pos").groupBy("_begin")
        .agg(F.max(key).alias("key"), (F.count_distinct(key) < 2).alias("tied"))
        .select("key", "_begin", "tied", chunk(F.col("_begin")).cast("int").alias("chunk"))
    )
    cuts = stage(cuts, "cuts")
    listed = F.array_sort(F.collect_list(F.struct("key", "_begin", "tied", "chunk")))
    first = chunk(F.lit(0).cast("long")).cast("int")

    def between(rows: DataFrame) -> DataFrame:
        found = rows.withColumn("_cuts", cuts.agg(listed).scalar()).withColumn(
            "_cut", _last_cut(F.col("_cuts"), len(begins), key)
        )
        return found.select(*df.columns, F.coalesce("_cut.chunk", first).alias(name))

    # At most as many keys as there are bounds.
    runs = F.broadcast(cuts.where("tied").select(F.col("key").alias("_run")).distinct())
    if runs.isEmpty():
        return between(df)
    whole = between(df.join(runs, key == F.col("_run"), "left_anti"))
    # Ties across a bound: where their run begins in all rows, plus their place in the run.
    tied = df.join(runs, key == F.col("_run"), "left_semi").select(*df.columns)
    placed, _ = with_position(tied, order, "_place")
    placed_runs = placed.groupBy(key.alias("_run")).agg(F.min("_place").alias("_run_place"))
    again = keys.join(runs, key == F.col("_run"))
    starts_of = again.groupBy("_run").agg(F.min("_pos").alias("_run_pos"))
    shifts = placed_runs.join(starts_of, "_run").select("_run", (F.col("_run_pos") - F.col("_run_place")).alias("_shift"))
    moved = placed.join(F.broadcast(shifts), key == F.col("_run"))
    pos = F.col("_place") + F.col("_shift")
    return whole.unionAll(moved.select(*df.columns, chunk(pos).cast("int").alias(name)))


def _last_cut(cuts: Column, n: int, key: Column) -> Column:
    """The last of `n` sorted cuts whose key is not beyond `key`, or NULL; found by halving."""
    steps = F.array(*[F.lit(1 << s) for s in reversed(range(n.bit_length()))])
    start = F.struct(F.lit(0).alias("at"), key.alias("key"))

    def nearer(found: Column, step: Column) -> Column:
        at = found["at"] + step
        fits = (at <= n) & (F.get(cuts, at - 1)["key"] <= found["key"])
        return F.struct(F.when(fits, at).otherwise(found["at"]).alias("at"), found["key"].alias("key"))

    return F.aggregate(steps, start, nearer, lambda found: F.get(cuts, found["at"] - 1))


def split_bytes(
    df: DataFrame, size: int, order: list[str], line: str = "value", name: str = "chunk_id"
) -> DataFrame:
    """Add the number, from 0, of the chunk in which each line lies (newlines count as bytes).

    The first chunk begins with the first line, the next with the first line that starts more than
    `size` bytes behind the start of the one before, so lines are never cut and a chunk holds the
    line that reaches or passes its size. The chain of starts is found by composing blocks of lines, see
    `line_chunks`, and not line by line. A null line counts as empty. Lines with equal keys in `order`
    are in a fixed order of their content.
    """
    located, _ = _located(df.withColumn("_bytes", _line_bytes(line)), order, "_bytes")
    found = line_chunks.with_chained_chunks(
        located, size, row="_part_row", weight="_bytes", blocks="_blocks_before", offset="_weight_before", name="_chunk"
    )
    return found.select(*df.columns, F.col("_chunk").cast("int").alias(name))


def split_byte_ranges(
    df: DataFrame, size: int, order: list[str], line: str = "value", name: str = "chunk_id"
) -> DataFrame:
    """Add the number of the `size`-byte range in which each line starts (newlines count).

    Lines are never cut, and every range starts at a multiple of `size`.
    """
    located, _ = _located(df.withColumn("_bytes", _line_bytes(line)), order, "_bytes")
    within = Window.partitionBy("_part_file").orderBy("_part_row").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("_weight_before") + F.coalesce(F.sum("_bytes").over(within), F.lit(0))
    return located.select(*df.columns, _div(start, size).cast("int").alias(name))


def _line_bytes(line: str) -> Column:
    return F.coalesce(F.octet_length(line), F.lit(0)).cast("long") + F.lit(1)
