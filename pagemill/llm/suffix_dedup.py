"""Removal of byte strings that occur earlier, by sorting suffixes.

Two equal windows of `LENGTH` bytes have their least `GRAM`-byte string, by hash, at the same place: the
leftmost such place is the window's anchor. Windows with one anchor are a run; the bytes that a run
covers are its context. Contexts are dealt to shards by the hash at the anchor, so that equal windows
meet in a shard and shards need not be merged. Of equal contexts only the first is sorted, and only
where contexts with one anchor hash differ. A shard sorts the suffixes of its contexts by induction
from their ends, lined up at the anchors (see `induced_sort`).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill.llm.common import OUT_BYTES, batched, bytes_of, read_table
from pagemill.llm.induced_sort import TextStore, induce, later_ones
from pagemill.llm.numbering import identified
from pagemill.llm.sentence_dedup import BASE, BASE_INVERSE, Powers, mixed
from pagemill.sources.storage import stage, stage_sized

LENGTH = 100
GRAM = 32
STARTS = LENGTH - GRAM + 1  # places of the anchor in a window
WIDTH = LENGTH + STARTS - 1  # bytes of a context at most
# Bytes of contexts in a shard on average.
SHARD_BYTES = 64 * 1024 * 1024


def sliding_least(values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Least value of each `width` neighbours, and its leftmost place."""
    place = np.arange(len(values))
    done = 1
    while done < width:
        step = min(done, width - done)
        left, right = values[:-step], values[step:]
        later = right < left
        place = np.where(later, place[step:], place[:-step])
        values = np.where(later, right, left)
        done += step
    return values, place


def runs_of(body: bytes, up: Powers, down: Powers) -> tuple[np.ndarray, ...] | None:
    """(hash at the anchor, hash of the context, first start, last start, anchor) of each run of windows."""
    n = len(body)
    if n < LENGTH:
        return None
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((np.frombuffer(body, np.uint8).astype(np.uint64) + np.uint64(1)) * up.first(n), out=sums[1:])
    back = down.first(n + 1)
    grams = mixed((sums[GRAM:] - sums[:-GRAM]) * back[: n - GRAM + 1])
    least, anchor = sliding_least(grams, STARTS)
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    last = np.concatenate([first[1:], [len(anchor)]]) - 1
    anchor = anchor[first]
    context = (sums[last + LENGTH] - sums[first]) * back[first]
    shape = ((last - first) << 8 | (anchor - first)).astype(np.uint64)
    return least[first], mixed(context + shape), first, last, anchor


RUNS = pa.schema(
    [("gram", pa.int64()), ("context", pa.int64()), ("doc_id", pa.int64()), ("place", pa.int64()), ("shape", pa.int64())]
)


def runs(documents: DataFrame) -> DataFrame:
    """(gram, context, doc_id, place, shape) of all runs of windows.

    `shape` holds the windows of the run less one, the anchor's distance, and 1 for runs that equal ones
    in the same chunk of rows precede; these need no further look, so neighbours are put together and
    dealt out evenly. Of a passage that a third of all documents hold, a chunk sends each run once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up, down = Powers(BASE), Powers(BASE_INVERSE)

        def chunks():
            held, held_bytes = [], 0
            for batch in batches:
                for doc_id, body in zip(batch.column(0), batch.column(1)):
                    found = runs_of(body.as_py() or b"", up, down)
                    if found is None:
                        continue
                    gram, context, first, last, anchor = found
                    shape = ((last - first) << 8 | (anchor - first)) << 1
                    held.append((gram, context, first, shape, doc_id.as_py()))
                    held_bytes += 48 * len(gram)
                    if held_bytes >= OUT_BYTES:
                        yield held
                        held, held_bytes = [], 0
            if held:
                yield held

        for held in chunks():
            gram, context, place, shape = (np.concatenate([h[k] for h in held]) for k in range(4))
            lengths = [len(h[0]) for h in held]
            doc_id = np.repeat(np.array([h[4] for h in held], np.int64), lengths)
            order = np.lexsort((place, doc_id, context, gram))
            gram, context, place, shape, doc_id = (v[order] for v in (gram, context, place, shape, doc_id))
            same = (gram[1:] == gram[:-1]) & (context[1:] == context[:-1])
            equal_row = (doc_id[1:] == doc_id[:-1]) & (place[1:] == place[:-1])
            later = np.concatenate([[False], same & ~equal_row])
            for n in np.flatnonzero(same & equal_row) + 1:
                later[n] = later[n - 1]
            own = [v[~later] for v in (gram, context, doc_id, place, shape)]
            spans = joined_runs(*(v[later] for v in (doc_id, place, shape)))
            columns = [np.concatenate(pair) for pair in zip(own, spans)]
            for n in range(0, len(columns[0]), 100_000):
                gram, context, doc_id, place, shape = (v[n : n + 100_000] for v in columns)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(gram.view(np.int64)), pa.array(context.view(np.int64)), pa.array(doc_id),
                        pa.array(place.astype(np.int64)), pa.array(shape.astype(np.int64)),
                    ],
                    schema=RUNS,
                )

    rows = documents.select("doc_id", bytes_of().alias("body"))
    return rows.mapInArrow(run, "gram long, context long, doc_id long, place long, shape long")


def joined_runs(doc_id, place, shape) -> tuple[np.ndarray, ...]:
    """Later runs of one text that touch or overlap, as one; with a hash of their place for a hash."""
    order = np.lexsort((place, doc_id))
    doc_id, place, shape = (v[order] for v in (doc_id, place, shape))
    behind = place + (shape >> 9) + LENGTH
    if len(place):
        touch = (doc_id[1:] == doc_id[:-1]) & (place[1:] <= behind[:-1])
        starts = np.flatnonzero(np.concatenate([[True], ~touch]))
        ends = np.concatenate([starts[1:], [len(place)]]) - 1
        doc_id, place = doc_id[starts], place[starts]
        shape = (behind[ends] - place - LENGTH) << 9 | 1
    gram = mixed(doc_id.astype(np.uint64) * np.uint64(BASE) + place.astype(np.uint64))
    return gram, np.zeros(len(gram), np.uint64), doc_id, place, shape


def compared(found: DataFrame) -> DataFrame:
    """Runs that come later than an equal one (`sort` false), and the first of each context where
    contexts of one anchor hash differ (`sort` true)."""
    firsts = Window.partitionBy("gram", "context").orderBy("doc_id", "place")
    group = Window.partitionBy("gram")
    ranked = found.withColumns(
        {
            "rank": F.rank().over(firsts), "number": F.row_number().over(firsts),
            "differ": F.min("context").over(group) != F.max("context").over(group),
        }
    )
    later = (F.col("rank") > 1) | (F.col("shape") % 2 == 1)
    return ranked.withColumn("sort", ~later).filter(later | (F.col("differ") & (F.col("number") == 1))).select(
        "gram", "doc_id", "place", "shape", "sort"
    )


def spans_of_later(later: DataFrame) -> DataFrame:
    """(doc_id, first, behind): the bytes that whole runs cover."""
    behind = F.col("place") + F.shiftright("shape", 9) + LENGTH
    return later.select("doc_id", F.col("place").alias("first"), behind.alias("behind"))


def contexts(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """(gram, doc_id, place, shape, bytes) of the wanted runs, cut from the documents' texts."""
    per_text = wanted.groupBy("doc_id").agg(F.collect_list(F.struct("gram", "place", "shape")).alias("runs"))
    keys, small = stage_sized(wanted.select("doc_id").distinct(), "texts")
    rows = documents.select("doc_id", "text")
    if small:
        rows = rows.join(F.broadcast(keys), "doc_id", "left_semi")
    joined = rows.dropDuplicates(["doc_id"]).join(per_text, "doc_id")
    one = F.explode("runs").alias("run")
    start = F.col("run.place").cast("int")
    length = (F.shiftright("run.shape", 9) + LENGTH).cast("int")
    return joined.select("doc_id", F.col("text").cast("binary").alias("body"), one).select(
        "run.gram", "doc_id", "run.place", "run.shape", F.substring("body", start + 1, length).alias("bytes")
    )


def sorted_shards(found: DataFrame) -> DataFrame:
    """(doc_id, first, behind): bytes of windows that equal an earlier window of their shard.

    Each partition is a shard. Its texts, and the tuples of the sort, lie in files without names beyond
    a bound. The numbers of its contexts do not: a task holds some ten whole arrays of them and a row
    per hit, about as many bytes as the texts have. All contexts of one anchor are in one shard, so an
    anchor between very many different neighbours has to fit a task.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("first", pa.int64()), ("behind", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = TextStore(WIDTH)
        kept = [[], [], []]  # id, place, shape
        for batch in batches:
            doc_id, place, shape, body = (batch.column(k) for k in range(4))
            rows = np.zeros((batch.num_rows, WIDTH), np.uint8)
            far = np.asarray(shape) >> 1 & 0xFF
            for n, value in enumerate(body):
                value = np.frombuffer(value.as_py(), np.uint8)
                # Anchors stand below each other in column STARTS - 1.
                begin = STARTS - 1 - far[n]
                rows[n, begin : begin + len(value)] = value
            texts.append(rows)
            kept[0].append(np.asarray(doc_id))
            kept[1].append(np.asarray(place))
            kept[2].append(np.asarray(shape))
        if not texts.rows:
            return
        doc_id, place, shape = (np.concatenate(k) for k in kept)
        table = texts.table()
        far, spare = shape >> 1 & 0xFF, shape >> 9
        begin = STARTS - 1 - far
        end = begin + spare + LENGTH
        # Numbers follow the order of documents and places, so the smallest of a run is the first.
        order = np.lexsort((place, doc_id))
        number = np.empty(len(order), np.int32)
        number[order] = np.arange(len(order), dtype=np.int32)
        hit = np.zeros((len(order), STARTS), bool)
        layer = iter([(np.arange(len(order), dtype=np.int32), np.zeros(len(order), np.int32))])
        for column in range(WIDTH - 1, -1, -1):

            def first(numbers: np.ndarray, column=column) -> np.ndarray:
                rows = order[numbers]
                inside = (begin[rows] <= column) & (column < end[rows])
                return np.where(inside, table[rows, column].astype(np.uint16) + 1, 0).astype(np.uint16)

            queue = induce(layer, first, LENGTH)
            layer = queue.blocks()
            if column < STARTS:
                for later in later_ones(queue.blocks(), LENGTH):
                    hit[later, column] = True
        yield from batched(hit_spans(hit, order, begin, doc_id, place), schema, lambda row: 48)

    return found.select("doc_id", "place", "shape", "bytes").mapInArrow(
        run, "doc_id long, first long, behind long"
    )


def hit_spans(hit, order, begin, doc_id, place) -> Iterator[tuple]:
    """Neighbouring windows of a context as one span of bytes."""
    edges = np.diff(np.pad(hit.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    first_rows, first_columns = np.nonzero(edges == 1)
    _, behind_columns = np.nonzero(edges == -1)
    for n, a, b in zip(first_rows.tolist(), first_columns.tolist(), behind_columns.tolist()):
        row = order[n]
        shift = int(place[row]) - int(begin[row])
        yield int(doc_id[row]), a + shift, b - 1 + shift + LENGTH


def repeated_bytes(documents: DataFrame) -> DataFrame:
    """(doc_id, first, behind): bytes that lie in a string of `LENGTH` bytes which starts earlier, too."""
    found = stage(compared(runs(documents)), "runs")
    wanted = found.filter("sort")
    shards = max(1, wanted.count() * WIDTH // SHARD_BYTES, wanted.sparkSession.sparkContext.defaultParallelism)
    cut = contexts(documents, wanted).repartition(shards, "gram")
    return spans_of_later(found.filter("not sort")).unionByName(sorted_shards(cut))


def dedup_bytes(documents: DataFrame) -> DataFrame:
    """`documents` with `kept` (the remaining bytes), `spans` (maximal removed runs, first and behind last)
    and `n_bytes`.

    Each byte goes that a string of `LENGTH` bytes covers which also starts earlier, in a smaller doc_id
    (null first) or earlier in the document; strings may overlap and are judged on the input. Matches never
    cross documents. Null text is empty. Rows equal in id and text are one document with equal results; rows
    with one id and different texts are different documents. Other columns stay; old columns with
    the new names are replaced.
    """
    documents = documents.drop("kept", "spans", "n_bytes")
    rows = identified(documents)
    gone = repeated_bytes(rows).groupBy("doc_id").agg(F.collect_list(F.struct("first", "behind")).alias("gone"))
    joined = rows.join(gone, "doc_id", "left").select("row", "gone")
    names, text_at = documents.columns, documents.columns.index("text")
    span = pa.list_(pa.struct([("first", pa.int64()), ("behind", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, spans, sizes = [], [], []
            columns = batch.column(0).flatten()
            for text, runs in zip(columns[text_at], batch.column(1)):
                body = (text.as_py() or "").encode()
                merged = merged_spans([(r["first"], r["behind"]) for r in runs.as_py() or ()])
                left.append(b"".join(body[a:b] for a, b in between(merged, len(body))))
                spans.append([{"first": a, "behind": b} for a, b in merged])
                sizes.append(len(body))
            columns += [pa.array(left, pa.binary()), pa.array(spans, span), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "kept", "spans", "n_bytes"])

    pair = T.StructType().add("first", "long").add("behind", "long")
    schema = T.StructType(list(documents.schema.fields))
    schema = schema.add("kept", "binary").add("spans", T.ArrayType(pair)).add("n_bytes", "long")
    return joined.mapInArrow(run, schema)


def merged_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[list[int]] = []
    for first, behind in sorted(spans):
        if merged and first <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], behind)
        else:
            merged.append([first, behind])
    return [tuple(m) for m in merged]


def between(spans: list[tuple[int, int]], size: int) -> Iterator[tuple[int, int]]:
    at = 0
    for first, behind in spans:
        yield at, first
        at = behind
    yield at, size


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the strings of 100 bytes that start earlier."""
    found = dedup_bytes(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["behind"] - s["first"])
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


OP3_SQL = """
    WITH d AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
    -- Windows are compared as text only where their hashes meet.
    k AS MATERIALIZED (
        SELECT doc_id, s, hash(substr(h, 2 * s + 1, 200)) AS k
        FROM (SELECT doc_id, h, unnest(range(len(h) // 2 - 99)) AS s FROM d WHERE len(h) >= 200)
    ),
    met AS (SELECT k FROM k GROUP BY k HAVING count(*) > 1),
    w AS MATERIALIZED (
        SELECT doc_id, s, substr(h, 2 * s + 1, 200) AS win FROM k SEMI JOIN met USING (k) JOIN d USING (doc_id)
    ),
    f AS (SELECT win, min((doc_id, s)) AS place FROM w GROUP BY win HAVING count(*) > 1),
    later AS (
        SELECT doc_id, s FROM w JOIN f USING (win) WHERE (doc_id, s) <> place
    ),
    run AS (
        SELECT doc_id, s, sum(CASE WHEN s - before > 100 OR before IS NULL THEN 1 ELSE 0 END)
            OVER (PARTITION BY doc_id ORDER BY s) AS n
        FROM (SELECT doc_id, s, lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS before FROM later)
    ),
    span AS (SELECT doc_id, n, min(s) AS a, max(s) + 100 AS b FROM run GROUP BY ALL),
    gap AS (
        SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b FROM span
        UNION ALL SELECT doc_id, max(b), NULL FROM span GROUP BY doc_id
    ),
    kept AS (
        SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * (coalesce(b, len(h) // 2) - a)), '' ORDER BY a) AS k
        FROM gap JOIN d USING (doc_id) GROUP BY doc_id
    ),
    n AS (SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans FROM span GROUP BY doc_id)
    SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed,
        coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(k, h))) AS kept_sha256
    FROM d LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)"""
