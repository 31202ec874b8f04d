"""Chunks of lines, each of which begins at the first line after the last chunk's start plus a size.

Where a chunk begins depends on where the one before began, so the chain of starts looks sequential. It
is not walked as one: each block of lines turns a threshold (the next chunk begins at the first line
that starts beyond it) into the threshold behind the block. Such jump functions are steps, computed for
all blocks at once, and composed in groups until one is left; thresholds then go down the same way.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagemill.sources.storage import stage, stage_sized

# Lines of a block, which one task holds as numbers.
BLOCK_LINES = 1 << 20
# Lines of a cell; chunks are looked up by cell when rows get their number.
CELL_LINES = 256
# Functions that one step composes.
FAN = 64
# Before the first line: the first chunk begins at the first line.
BEFORE = -1

STEPS_TYPE = "_block long, _reach long, _last long, _at array<long>, _to array<long>, _chunks array<long>"
STEPS = pa.schema([
    ("_block", pa.int64()), ("_reach", pa.int64()), ("_last", pa.int64()), ("_at", pa.list_(pa.int64())),
    ("_to", pa.list_(pa.int64())), ("_chunks", pa.list_(pa.int64())),
])
ENTRY_TYPE = "_block long, _threshold long, _before long"
ENTRY = pa.schema([("_block", pa.int64()), ("_threshold", pa.int64()), ("_before", pa.int64())])
CELL_TYPE = "_block long, _cell long, _first long, _starts array<int>"
CELLS = pa.schema(
    [("_block", pa.int64()), ("_cell", pa.int64()), ("_first", pa.int64()), ("_starts", pa.list_(pa.int32()))]
)


class Jump(NamedTuple):
    """A step function of thresholds: one below line start `at[i]` and not below `at[i - 1]` becomes `to[i]`
    after `chunks[i]` chunks. Thresholds from `last`, the last line's start, on stay as they are.

    No threshold comes in at `reach` or beyond, so steps behind that are left out.
    """

    reach: int
    last: int
    at: np.ndarray
    to: np.ndarray
    chunks: np.ndarray

    def apply(self, threshold: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = np.searchsorted(self.at, threshold, side="right")
        inside = threshold < self.last
        place = np.minimum(place, len(self.at) - 1)
        return np.where(inside, self.to[place], threshold), np.where(inside, self.chunks[place], 0)

    def then(self, later: Jump) -> Jump:
        to, more = later.apply(self.to)
        at, chunks = self.at, self.chunks + more
        if self.last < self.reach:
            # Thresholds behind this part's last line go into the next part as they are.
            at, to = np.concatenate([at, later.at]), np.concatenate([to, later.to])
            chunks = np.concatenate([chunks, later.chunks])
        return cut(Jump(self.reach, later.last, at, to, chunks))


def cut(jump: Jump) -> Jump:
    """Without steps beyond reach, and neighbouring steps with one result as one."""
    used = np.searchsorted(jump.at, jump.reach, side="right") + 1
    at, to, chunks = jump.at[:used], jump.to[:used], jump.chunks[:used]
    ends = np.flatnonzero(np.concatenate([(to[1:] != to[:-1]) | (chunks[1:] != chunks[:-1]), [True]]))
    return Jump(jump.reach, jump.last, at[ends], to[ends], chunks[ends])


def block_jump(starts: np.ndarray, size: int) -> Jump:
    """The jump function of lines with these starts."""
    n = len(starts)
    following = np.searchsorted(starts, starts + size, side="right")
    to, chunks = starts + size, np.ones(n, np.int64)
    # Chains are followed for all lines at once, each round twice as far.
    link = np.append(following, n)
    steps = np.append(chunks, 0)
    last = np.append(np.arange(n), n)
    while (link[:n] < n).any():
        onward = link < n
        steps = np.where(onward, steps + steps[link], steps)
        last = np.where(onward, last[link], last)
        link = link[link]
    return cut(Jump(int(starts[0]) + size, int(starts[-1]), starts, to[last[:n]], steps[:n]))


def chunk_starts(starts: np.ndarray, size: int, threshold: int) -> np.ndarray:
    """Numbers of the lines of a block at which chunks begin, for the threshold that comes in."""
    found, place = [], int(np.searchsorted(starts, threshold, side="right"))
    while place < len(starts):
        found.append(place)
        place = int(np.searchsorted(starts, starts[place] + size, side="right"))
    return np.array(found, np.int64)


def _groups(batches: Iterable[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    rows = (row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns]))
    yield from groupby(rows, key=lambda row: row[:keys])


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, list[int]]]:
    """(bytes of its lines, values of the block) of each block, from lines sorted by block and row.

    The first column is a line's bytes, the others hold one value per block, first its number.
    """
    held, own = [], None
    for batch in batches:
        sizes, numbers, *others = (c.to_numpy() for c in batch.columns)
        edges = [0, *(np.flatnonzero(numbers[1:] != numbers[:-1]) + 1).tolist(), len(numbers)]
        for a, b in zip(edges, edges[1:]):
            if a == b:
                continue
            if own is not None and numbers[a] != own[0]:
                yield np.concatenate(held), own
                held = []
            own = [int(numbers[a]), *(int(v[a]) for v in others)]
            held.append(sizes[a:b])
    if held:
        yield np.concatenate(held), own


def _starts(first: int, sizes: np.ndarray) -> np.ndarray:
    return first + np.concatenate([[0], np.cumsum(sizes[:-1])]).astype(np.int64)


Job = Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _batch(schema: pa.Schema, *columns: Iterable) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _jumps(size: int) -> Job:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for sizes, (block, first) in _blocks(batches):
            jump = block_jump(_starts(first, sizes), size)
            yield _batch(STEPS, [block], *([v] for v in jump))

    return run


def _jump_of(row: tuple) -> Jump:
    reach, last, *steps = row
    return Jump(reach, last, *(np.array(s, np.int64) for s in steps))


def _composed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (group,), rows in _groups(batches, 1):
        whole = None
        for _, _, *row in rows:
            jump = _jump_of(row)
            whole = jump if whole is None else whole.then(jump)
        yield _batch(STEPS, [group], *([v] for v in whole))


def _entered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The threshold and number of chunks before each block, from those before its group."""
    for _, rows in _groups(batches, 1):
        threshold = before = None
        found = []
        for _, entry, chunks, block, *row in rows:
            if threshold is None:
                threshold, before = entry, chunks
            found.append((block, threshold, before))
            to, more = _jump_of(row).apply(np.array([threshold]))
            threshold, before = int(to[0]), before + int(more[0])
        yield _batch(ENTRY, *zip(*found))


def _cells(size: int, entries: DataFrame, lines: DataFrame) -> DataFrame:
    """Per cell of lines the number of its first line's chunk, and the lines of it at which others begin."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for sizes, (block, first, threshold, before) in _blocks(batches):
            starts = _starts(first, sizes)
            begins = chunk_starts(starts, size, threshold)
            firsts = np.arange(0, len(starts), CELL_LINES)
            number = before + np.searchsorted(begins, firsts, side="right") - 1
            bounds = np.searchsorted(begins, np.append(firsts, len(starts)), side="left")
            # A chunk that begins with the cell is its first line's own.
            own = np.searchsorted(begins, firsts, side="right")
            inner = [(begins[a:b] - f).tolist() for a, b, f in zip(own, bounds[1:], firsts)]
            yield _batch(CELLS, [block] * len(firsts), range(len(firsts)), number, inner)

    joined = lines.join(entries, "_block").repartition("_block").sortWithinPartitions("_block", "_row")
    return joined.select("_bytes", "_block", "_offset", "_threshold", "_before").mapInArrow(run, CELL_TYPE)


def chained_chunks(lines: DataFrame, size: int, fan: int = FAN) -> DataFrame:
    """(_block, _cell, _first, _starts) of cells of lines, for lines (_block, _row, _offset, _bytes).

    Blocks are numbered from 0 in order without gaps, rows count within a block, and `_offset` is the
    block's first byte. A line's chunk is `_first` plus the number of `_starts` up to its place in the cell.
    """
    aligned = lines.repartition("_block").sortWithinPartitions("_block", "_row")
    levels = [stage(aligned.select("_bytes", "_block", "_offset").mapInArrow(_jumps(size), STEPS_TYPE), "jumps")]
    while (levels[-1].agg(F.max("_block")).first()[0] or 0) > 0:
        group = F.call_function("div", "_block", F.lit(fan)).alias("_group")
        members = levels[-1].select(group, "*").repartition("_group").sortWithinPartitions("_group", "_block")
        levels.append(stage(members.mapInArrow(_composed, STEPS_TYPE), "jumps"))
    entries = levels[-1].select("_block", F.lit(BEFORE).cast("long").alias("_threshold"), F.lit(0).cast("long").alias("_before"))
    for level in reversed(levels[:-1]):
        group = F.call_function("div", "_block", F.lit(fan)).alias("_group")
        members = level.select(group, "*").join(
            entries.select(F.col("_block").alias("_group"), "_threshold", "_before"), "_group"
        )
        ordered = members.select("_group", "_threshold", "_before", "_block", "_reach", "_last", "_at", "_to", "_chunks")
        ordered = ordered.repartition("_group").sortWithinPartitions("_group", "_block")
        entries = stage(ordered.mapInArrow(_entered, ENTRY_TYPE), "chunk-entries")
    return _cells(size, entries, lines)


def with_chained_chunks(
    rows: DataFrame, size: int, row: str, weight: str, blocks: str, offset: str, name: str
) -> DataFrame:
    """Rows with their chunk `name`. Of each file, `row` counts the rows, `blocks` and `offset` are the blocks
    and bytes before it; `weight` is a line's bytes."""
    nth = F.call_function("div", row, F.lit(BLOCK_LINES))
    keyed = rows.withColumns({"_block": F.col(blocks) + nth, "_row": F.col(row) % BLOCK_LINES})
    narrow = keyed.select(blocks, offset, "_block", "_row", F.col(weight).cast("long").alias("_bytes"))
    sums = narrow.groupBy(blocks, offset, "_block").agg(F.sum("_bytes").alias("_sum"))
    before = Window.partitionBy(blocks).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    first = F.col(offset) + F.coalesce(F.sum("_sum").over(before), F.lit(0))
    starts, small = stage_sized(sums.select("_block", first.alias("_offset")), "blocks")
    lines = narrow.drop(blocks, offset).join(F.broadcast(starts) if small else starts, "_block")
    cells, few = stage_sized(chained_chunks(lines, size), "cells")
    cell = F.call_function("div", "_row", F.lit(CELL_LINES))
    found = keyed.withColumn("_cell", cell).join(F.broadcast(cells) if few else cells, ["_block", "_cell"])
    place = F.col("_row") % CELL_LINES
    return found.withColumn(name, (F.col("_first") + F.size(F.filter("_starts", lambda s: s <= place))).cast("long"))
