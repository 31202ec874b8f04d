"""Hard negatives by exact integer products, many candidates packed into one wide integer."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagemill.llm.common import batched, read_table
from pagemill.sources.storage import stage

POSITIVES = 5
NEGATIVES = 10
# A negative's score, in percent of the positive's, lies between these.
LEAST, MOST = 30, 90
SCALE = 256
# Candidates whose components share one integer.
PACKED = 2048
# Bytes of components of the anchors that go through the driver and to the executors at a time.
PASS_BYTES = 16 * 1024 * 1024
# Candidate rows that one task scores. Fewer tasks leave fewer partial results to merge.
TASK_ROWS = 65_536
# Null ids come last among equal scores; no id is larger.
NO_ID = 2**63 - 1

ROW = "_row long, _id long, _label long, _parts binary"
LONG = range(-(2**63), 2**63)


class Vector(NamedTuple):
    """A row; `packed` holds its components as `_scaled` writes them."""

    row: int
    id: int | None
    label: int
    packed: bytes


def _scaled(values: np.ndarray) -> bytes:
    """floor(256 x) of each component: a byte for the width, then little-endian signed integers of it."""
    with np.errstate(over="ignore"):
        floors = np.floor(values * float(SCALE))
    if not np.isfinite(floors).all():
        whole = [int(x * SCALE // 1) if abs(x) < 1 else int(x) * SCALE for x in values.tolist()]
    elif np.abs(floors).max(initial=0) < 2**31:
        return b"\x04" + floors.astype("<i4").tobytes()
    else:
        whole = [int(x) for x in floors.tolist()]
    width = max(x.bit_length() for x in whole) // 8 + 1
    return bytes((width,)) + b"".join(x.to_bytes(width, "little", signed=True) for x in whole)


def _parts(packed: bytes) -> list[int]:
    width, body = packed[0], packed[1:]
    if width == 4:
        return np.frombuffer(body, "<i4").tolist()
    return [int.from_bytes(body[i : i + width], "little", signed=True) for i in range(0, len(body), width)]


def _quantise(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("_row", pa.int64()), ("_id", pa.int64()), ("_label", pa.int64()), ("_parts", pa.binary())])

    def rows() -> Iterator[tuple]:
        for batch in batches:
            row, key, label, vectors = batch.columns
            values, ends = vectors.flatten().to_numpy(zero_copy_only=False), np.cumsum([len(v) for v in vectors])
            for i, end in enumerate(ends):
                start = ends[i - 1] if i else 0
                yield row[i].as_py(), key[i].as_py(), label[i].as_py(), _scaled(values[start:end])

    return batched(rows(), schema, size=lambda r: len(r[3]))


def _width(most: int) -> int:
    """Bytes of a field that holds 0 to `most`: 4 or 8, or a multiple of 8."""
    return 4 if most < 2**32 else -(-most.bit_length() // 64) * 8


class Packed:
    """Candidates with, for each component, one integer that has a field per candidate.

    Components are biased so that every field is at least zero. A product with one anchor component
    multiplies all fields at once. Fields of the sum of products may be negative and borrow from the next,
    which adding `half` to each of them undoes before they are read.
    """

    def __init__(self, candidates: list[Vector], reach: int) -> None:
        """`reach` is the largest sum of absolute components of an anchor."""
        self.rows = np.array([c.row for c in candidates])
        self.ids = np.array([NO_ID if c.id is None else c.id for c in candidates])
        vectors = [_parts(c.packed) for c in candidates]
        length = max(map(len, vectors))
        self.bias = -min(min(v, default=0) for v in vectors + [[0]])
        most = max(max(v, default=0) for v in vectors) + self.bias
        self.half = max(reach, 1) * max(most, 0)
        self.width = _width(2 * self.half)
        count, bias = len(candidates), self.bias
        if self.width <= 8:
            fields = np.full((length, count), bias, dtype=f"<u{self.width}")
            for j, v in enumerate(vectors):
                fields[: len(v), j] = np.array(v, dtype=np.int64) + bias
            columns = [column.tobytes() for column in fields]
        else:
            columns = [
                b"".join(((v[i] if i < len(v) else 0) + bias).to_bytes(self.width, "little") for v in vectors)
                for i in range(length)
            ]
        self.wide = [int.from_bytes(column, "little") for column in columns]
        self.halves = int.from_bytes(self.half.to_bytes(self.width, "little") * count, "little")

    def scores(self, anchor: Vector) -> np.ndarray:
        """The inner product of an anchor with every candidate; components that one of them lacks are 0."""
        total, weight = self.halves, 0
        for a, wide in zip(_parts(anchor.packed), self.wide):
            if a:
                total += a * wide
                weight += a
        body = total.to_bytes(self.width * len(self.rows), "little")
        # Each field is half + sum of a * (c + bias).
        shift = self.half + self.bias * weight
        if self.width <= 8 and shift < 2**63 and 2 * self.half < 2**63:
            return np.frombuffer(body, f"<u{self.width}").astype(np.int64) - shift
        w = self.width
        fields = (int.from_bytes(body[i : i + w], "little") for i in range(0, len(body), w))
        return np.array([field - shift for field in fields], dtype=object)


def _first(scores: np.ndarray, ids: np.ndarray, wanted: int) -> np.ndarray:
    """Places of the first `wanted` by falling score and rising id."""
    if len(scores) > 4 * wanted and scores.dtype != object:
        edge = np.partition(scores, len(scores) - wanted)[len(scores) - wanted]
        near = np.flatnonzero(scores >= edge)
    else:
        near = np.arange(len(scores))
    if scores.dtype == object:
        return near[sorted(range(len(near)), key=lambda k: (-scores[k], ids[k]))[:wanted]]
    return near[np.lexsort((ids[near], -scores[near]))[:wanted]]


class Best:
    """The first few (score, id) of one list seen so far."""

    def __init__(self, wanted: int) -> None:
        self.wanted, self.kept = wanted, []

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(scores):
            first = _first(scores, ids, self.wanted)
            self.kept += [(int(scores[i]), int(ids[i])) for i in first]
            self.kept = sorted(self.kept, key=lambda pair: (-pair[0], pair[1]))[: self.wanted]


def _blocks(batches: Iterable[pa.RecordBatch], reach: int) -> Iterator[tuple[int, Packed]]:
    """Candidates of one label, PACKED at a time."""
    held: dict[int, list[Vector]] = {}
    for batch in batches:
        for row, key, label, packed in zip(*[c.to_pylist() for c in batch.columns]):
            block = held.setdefault(label, [])
            block.append(Vector(row, key, label, packed))
            if len(block) == PACKED:
                yield label, Packed(held.pop(label), reach)
    for label, block in held.items():
        yield label, Packed(block, reach)


def _text(scores: Iterable[int]) -> list[str]:
    """Scores may be larger than any column of numbers."""
    return [str(s) for s in scores]


Job = Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]
FOUND = pa.schema([
    ("_anchor", pa.int64()), ("_positive", pa.int32()), ("_ids", pa.list_(pa.int64())),
    ("_scores", pa.list_(pa.string())),
])
FOUND_TYPE = "_anchor long, _positive int, _ids array<long>, _scores array<string>"


def _positives(content, wanted: int) -> Job:
    """Per anchor the first candidates of its own label that one task has."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, reach = content.value
        best: dict[int, Best] = {}
        for label, block in _blocks(batches, reach):
            for anchor, _ in anchors:
                if anchor.label != label:
                    continue
                scores = block.scores(anchor)
                others = block.rows != anchor.row
                best.setdefault(anchor.row, Best(wanted)).add(scores[others], block.ids[others])
        rows = ((row, 0, [i for _, i in b.kept], _text(s for s, _ in b.kept)) for row, b in best.items())
        return batched(rows, FOUND)

    return run


def _negatives(content, wanted: int, least: int, most: int) -> Job:
    """Per anchor and positive the first candidates of other labels within its bounds that one task has."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, reach = content.value
        best: dict[tuple[int, int], Best] = {}
        for label, block in _blocks(batches, reach):
            for anchor, positives in anchors:
                if anchor.label == label or not positives:
                    continue
                scores = block.scores(anchor)
                bounds = [(-(-least * p // 100), most * p // 100) for p in positives]
                near = (scores >= min(low for low, _ in bounds)) & (scores <= max(high for _, high in bounds))
                scores, ids = scores[near.astype(bool)], block.ids[near.astype(bool)]
                for k, (low, high) in enumerate(bounds):
                    within = ((scores >= low) & (scores <= high)).astype(bool)
                    if within.any():
                        best.setdefault((anchor.row, k), Best(wanted)).add(scores[within], ids[within])
        rows = ((row, k, [i for _, i in b.kept], _text(s for s, _ in b.kept)) for (row, k), b in best.items())
        return batched(rows, FOUND)

    return run


def _merged(found: DataFrame, wanted: int) -> DataFrame:
    """(_anchor, _positive, _rank, _id, _score): the first of all tasks' lists."""
    pairs = found.select("_anchor", "_positive", F.explode(F.arrays_zip("_scores", "_ids")).alias("_pair"))
    score = F.col("_pair._scores")
    # Whole numbers as text: by sign, then by length and digits.
    size = F.length(score)
    below = score.startswith("-")
    order = [
        below.asc(),
        F.when(below, size).otherwise(-size).asc(),
        F.when(below, score).asc_nulls_first(),
        F.when(~below, score).desc_nulls_first(),
        F.col("_pair._ids").asc(),
    ]
    rank = F.row_number().over(Window.partitionBy("_anchor", "_positive").orderBy(*order))
    ranked = pairs.withColumn("_rank", rank).filter(F.col("_rank") <= wanted)
    return ranked.select("_anchor", "_positive", "_rank", F.col("_pair._ids").alias("_id"), score.alias("_score"))


def _usable(df: DataFrame, key: str, vector: str, label: Column) -> DataFrame:
    values = F.col(f"`{vector}`").cast("array<double>")
    rows = df.select(
        F.col(f"`{key}`").cast("long").alias("_id"), label.cast("long").alias("_label"), values.alias("_values")
    )
    rows = rows.filter(F.col("_label").isNotNull() & F.col("_values").isNotNull())
    return rows.filter(~F.exists("_values", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))))


def _passes(anchors: DataFrame, pass_bytes: int) -> Iterator[list]:
    """Anchors in groups of bounded size; one group at a time is at the driver."""
    held, size = [], 0
    for row in anchors.toLocalIterator():
        held.append(Vector(row["_row"], row["_id"], row["_label"], bytes(row["_parts"])))
        size += 64 + len(row["_parts"])
        if size >= pass_bytes:
            yield held
            held, size = [], 0
    if held:
        yield held


def hard_negatives(
    df: DataFrame,
    is_anchor: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    label: Column | str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least: int = LEAST,
    most: int = MOST,
    pass_bytes: int = PASS_BYTES,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every anchor and positive.

    `is_anchor` and `label` are columns over `_id`, the key, and `df`'s label. A score is the inner product
    of components floor(256 x), exact at any size. Anchors go out in passes of bounded size; every task
    scores its candidates for all anchors of a pass, packed by label, first those of the anchor's label,
    then the others, whose bounds follow from the positives. Tasks return their first few per list, which
    are merged; no list is cut before.

    Rows with a null label, a null vector, or a null or non-finite component take no part. Null keys may be
    candidates and come last among equal scores, as null. Rows that repeat, keys included, are rows of their
    own: each is an anchor of its own and another row to its copies. A vector lacks components as 0; an
    empty one scores 0. Scores that no long can hold are null in the result, yet compared exactly. Without
    anchors, or with an empty table, there are no rows. Other columns are not looked at.
    """
    spark = df.sparkSession
    usable = _usable(df, key, vector, F.col(label) if isinstance(label, str) else label)
    numbered = usable.select(F.monotonically_increasing_id().alias("_row"), "_id", "_label", "_values")
    rows = stage(numbered.mapInArrow(_quantise, ROW), "candidates")
    anchors = rows.filter(F.coalesce(is_anchor, F.lit(False)))
    total = rows.count()
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // task_rows))
    candidates = stage(rows.repartition(tasks), "candidate-blocks")
    parts = []
    for group in _passes(anchors, pass_bytes):
        reach = max(sum(map(abs, _parts(a.packed))) for a in group)
        content = spark.sparkContext.broadcast(([(a, ()) for a in group], reach))
        found = candidates.mapInArrow(_positives(content, positives), FOUND_TYPE)
        near = stage(_merged(found, positives), "positives")
        # Of the anchors of one pass, a bounded number.
        of_anchor: dict[int, list[tuple[int, int | None, int]]] = {}
        for r in near.collect():
            of_anchor.setdefault(r["_anchor"], []).append((r["_rank"], r["_id"], int(r["_score"])))
        scored = [(a, tuple(s for _, _, s in sorted(of_anchor.get(a.row, []), key=lambda t: t[0]))) for a in group]
        content = spark.sparkContext.broadcast((scored, reach))
        found = candidates.mapInArrow(_negatives(content, negatives, least, most), FOUND_TYPE)
        lists = _merged(found, negatives)
        ids = rows.select(F.col("_row").alias("_anchor"), F.col("_id").alias("anchor_id"))
        positive = near.select(
            "_anchor", (F.col("_rank") - 1).alias("_positive"), F.col("_id").alias("positive_id"),
            F.col("_score").alias("positive_score"),
        )
        parts.append(stage(lists.join(positive, ["_anchor", "_positive"]).join(ids, "_anchor"), "hard-negatives"))
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not parts:
        return spark.createDataFrame([], schema)
    found = parts[0]
    for part in parts[1:]:
        found = found.unionAll(part)
    return found.select(
        "anchor_id",
        F.nullif("positive_id", F.lit(NO_ID)).alias("positive_id"),
        F.col("_rank").alias("rank"),
        F.nullif("_id", F.lit(NO_ID)).alias("negative_id"),
        F.col("positive_score").try_cast("long").alias("positive_score"),
        F.col("_score").try_cast("long").alias("negative_score"),
    )


def shifted_label(key: str = "vec_id", label: str = "label") -> Column:
    """Labels of every seventh row, one further."""
    moved = F.when(F.col(key) % 7 == 0, (F.col(label) + 1) % 10)
    return F.coalesce(moved, F.col(label))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth embedding."""
    table = read_table(spark, sf_dir, "embeddings")
    return hard_negatives(table, F.col("_id") % 100 == 0, label=shifted_label())


OP12_SQL = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(x::DOUBLE * 256)::BIGINT) AS parts
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), components AS (
  SELECT vec_id, label, unnest(parts) AS x, generate_subscripts(parts, 1) AS k FROM usable
), scores AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, sum(a.x * c.x)::BIGINT AS score
  FROM components a JOIN components c USING (k)
  WHERE a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id GROUP BY ALL
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
  (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""
