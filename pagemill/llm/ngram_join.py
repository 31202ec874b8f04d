"""Exact Jaccard join on word n-grams by vertical partitioning, and groups of linked documents.

All n-grams stand in one global order and that order is cut into fragments. A document's set is so
cut into segments; what two documents share is counted fragment by fragment and summed per pair.

1. Over the first fragments, those n-grams of each set are counted that any other set holds as
   well. A set with too many of its own cannot reach the threshold with any other and is done.
2. For the sets that are left, n-grams get their final order: first those of one set only, then the
   shared ones, then very common ones, each by hash. Two linked sets share an n-gram among the first
   |x| - ceil(0.8 |x|) + 1 of each.
3. Sets that meet in such an n-gram are paired only with the one that has the fewest members of its own:
   the likeliest centre of a group of near copies. Exact bounds on what a pair can share drop most; the
   others are counted fragment by fragment.
4. Pairs that meet beside that one and are not yet in one component are counted the same way.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagemill.llm.common import OUT_BYTES, blank_words, bytes_of, read_table
from pagemill.llm.components import connected_components
from pagemill.llm.sentence_dedup import mixed
from pagemill.sources.storage import stage, stage_sized

WORDS = 5
# Two sets link when 100 * shared >= PERCENT * union.
PERCENT = 80
# The order of n-grams, a 62-bit hash, is cut into so many fragments; step 1 reads the first of them.
FRAGMENTS = 10
FIRST_FRAGMENTS = 3
HASH_BITS = 62
FRAGMENT_SIZE = (1 << HASH_BITS) // FRAGMENTS + 1
# An n-gram in more sets than this is very common: it comes last in the order.
COMMON = 32
KEPT_WORDS = 500_000
FACTORS = [np.uint64(pow(0x9E3779B97F4A7C15, n + 1, 1 << 64) | 1) for n in range(WORDS)]


class WordHashes(dict):
    """64-bit hashes of words; common ones are remembered."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) >= KEPT_WORDS:
            self.clear()
        if len(word) <= 48:
            self[word] = value
        return value


_HASHES = WordHashes()


def shingle_set(body: bytes | None) -> np.ndarray:
    """The sorted distinct hashes of all runs of five words, or of the whole text if it has fewer."""
    words = blank_words(body)
    if not words:
        return np.empty(0, np.int64)
    hashes = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    size = min(WORDS, len(words))
    n = len(words) - size + 1
    total = np.full(n, size, np.uint64)
    for k in range(size):
        total += mixed(hashes[k : k + n] + FACTORS[k]) * FACTORS[k]
    return np.unique((mixed(total) >> np.uint64(64 - HASH_BITS)).view(np.int64))


def needed(n: int) -> int:
    """How many of n members a set must share at least with any set it links to."""
    return (PERCENT * n + 99) // 100


def set_id(members: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(members.tobytes(), digest_size=8).digest(), "little") >> 1


def early(members: np.ndarray) -> int:
    """Members that lie in the first fragments, but at least as many as must hold a shared one."""
    n = len(members)
    return max(int(np.searchsorted(members, FIRST_FRAGMENTS * FRAGMENT_SIZE)), n - needed(n) + 1)


def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for doc_id, body in zip(batch.column(0), batch.column(1)):
            yield doc_id.as_py(), body.as_py()


def _rows(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), bytes_of().alias("body"))


def members_of(documents: DataFrame) -> DataFrame:
    """(doc_id, sid, n, early) of every row; sid names the set, and is null where there are no words."""
    schema = pa.schema([("doc_id", pa.int64()), ("sid", pa.int64()), ("n", pa.int64()), ("early", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for body in batch.column(1):
                members = shingle_set(body.as_py())
                n = len(members)
                found.append((set_id(members), n, early(members)) if n else (None, 0, 0))
            columns = [pa.array([f[k] for f in found], pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], schema=schema)

    return _rows(documents).mapInArrow(run, "doc_id long, sid long, n long, early long")


def first_postings(documents: DataFrame) -> DataFrame:
    """(gram, sid, weight) of the first fragments, put together over chunks of rows.

    A gram of one set of the chunk gives a row of weight 1. A gram of several gives two rows of weight
    0, however many sets hold it, and is counted in the row of each set, whose weight is -1 less
    that count. So a gram that a third of all documents hold gives two rows per chunk.
    """
    schema = pa.schema([("gram", pa.int64()), ("sid", pa.int64()), ("weight", pa.int32())])

    def chunks(batches):
        held, held_bytes = {}, 0
        for _, body in _bodies(batches):
            members = shingle_set(body)
            if len(members):
                sid = set_id(members)
                if sid not in held:
                    held[sid] = members[: early(members)].copy()
                    held_bytes += held[sid].nbytes + 128
            if held_bytes >= OUT_BYTES:
                yield held
                held, held_bytes = {}, 0
        if held:
            yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in chunks(batches):
            sids = np.fromiter(held, np.int64, len(held))
            grams = np.concatenate(list(held.values()))
            owner = np.repeat(np.arange(len(sids)), [len(m) for m in held.values()])
            order = np.argsort(grams, kind="stable")
            grams, owner = grams[order], owner[order]
            same = grams[1:] == grams[:-1]
            shared = np.concatenate([[False], same]) | np.concatenate([same, [False]])
            first = shared & ~np.concatenate([[False], same])
            last = shared & ~np.concatenate([same, [False]])
            local = np.bincount(owner[shared], minlength=len(sids))
            marks = first | last
            yield from _batches(
                schema,
                np.concatenate([grams[~shared], grams[marks], mixed(sids.view(np.uint64)).view(np.int64)]),
                np.concatenate([sids[owner[~shared]], sids[owner[marks]], sids]),
                np.concatenate(
                    [np.ones((~shared).sum(), np.int32), np.zeros(marks.sum(), np.int32), -1 - local.astype(np.int32)]
                ),
            )

    return _rows(documents).mapInArrow(run, "gram long, sid long, weight int")


def _batches(schema: pa.Schema, *columns: np.ndarray, rows: int = 100_000) -> Iterator[pa.RecordBatch]:
    for n in range(0, len(columns[0]), rows):
        yield pa.RecordBatch.from_arrays([pa.array(c[n : n + rows]) for c in columns], schema=schema)


def may_link(documents: DataFrame, members: DataFrame) -> DataFrame:
    """(sid, doc_id): the sets that step 1 leaves, each with its smallest document."""
    together = Window.partitionBy("gram")
    shared = F.min("sid").over(together) != F.max("sid").over(together)
    counted = (
        first_postings(documents).withColumn("shared", shared)
        .groupBy("sid")
        .agg(
            F.sum(F.when(F.col("weight") < 0, -F.col("weight") - 1).when(F.col("shared"), F.col("weight")).otherwise(0))
            .alias("held"),
            F.sum(F.when(F.col("weight") < 0, 1)).alias("chunks"),
        )
        # Each chunk that holds the set has counted the same.
        .select("sid", (F.col("held") / F.col("chunks")).alias("held"))
    )
    sets = members.filter("sid is not null").groupBy("sid").agg(
        F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("early").alias("early")
    )
    own = F.col("early") - F.col("held")
    return sets.join(counted, "sid").filter(own <= F.col("n") - _needed(F.col("n"))).select("sid", "doc_id")


def _needed(n: Column) -> Column:
    return F.floor((n * PERCENT + 99) / 100)


def segments_of(documents: DataFrame) -> DataFrame:
    """(sid, n, fragment, grams) of every row: the set's members by fragment of the global order."""
    schema = pa.schema(
        [("sid", pa.int64()), ("n", pa.int64()), ("fragment", pa.int32()), ("grams", pa.list_(pa.int64()))]
    )
    cuts = np.arange(FRAGMENTS + 1) * FRAGMENT_SIZE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_bytes = [], 0
        for _, body in _bodies(batches):
            members = shingle_set(body)
            if not len(members):
                continue
            sid, ends = set_id(members), np.searchsorted(members, cuts)
            held += [
                (sid, len(members), f, members[ends[f] : ends[f + 1]])
                for f in range(FRAGMENTS) if ends[f] < ends[f + 1]
            ]
            held_bytes += members.nbytes
            if held_bytes >= OUT_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held), schema)], schema=schema)
                held, held_bytes = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held), schema)], schema=schema)

    return _rows(documents).mapInArrow(run, "sid long, n long, fragment int, grams array<long>")


def prefixes(segments: DataFrame) -> DataFrame:
    """(sid, n, own, prefix): shared members among the first of each set, in the final order.

    `own` members of no other set come before them. Keys of very common n-grams lie above all others.
    """
    grams = segments.select("sid", "n", F.explode("grams").alias("gram"))
    # The table of counts has one row per gram, so a gram of very many sets is hot on one side only.
    counts = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("sets")).filter("sets > 1")
    key = F.col("gram") + F.when(F.col("sets") > COMMON, F.lit(1 << HASH_BITS)).otherwise(F.lit(0))
    keys = grams.join(counts, "gram").groupBy("sid", "n").agg(F.sort_array(F.collect_list(key)).alias("keys"))
    own = F.col("n") - F.size("keys")
    spare = F.col("n") - _needed(F.col("n")) + 1 - own
    return keys.withColumn("own", own).filter(spare > 0).select(
        "sid", "n", "own", F.slice("keys", F.lit(1), spare.cast("int")).alias("prefix")
    )


def can_link(x: str, y: str) -> Column:
    """Exact bounds for a pair of rows of `prefixes`: sizes, members no other set has, and what both
    share among the first members, with the rest of the smaller one after the place compared."""
    n_x, n_y = F.col(f"{x}.n"), F.col(f"{y}.n")
    own_x, own_y = F.col(f"{x}.own"), F.col(f"{y}.own")
    prefix_x, prefix_y = F.col(f"{x}.prefix"), F.col(f"{y}.prefix")
    sizes = F.least(n_x, n_y) * 100 >= F.greatest(n_x, n_y) * PERCENT

    def enough(shared: Column) -> Column:
        return shared * (100 + PERCENT) >= (n_x + n_y) * PERCENT

    rest = F.least(n_x - own_x, n_y - own_y)
    last = F.least(F.element_at(prefix_x, -1), F.element_at(prefix_y, -1))
    seen_x = own_x + F.size(F.filter(prefix_x, lambda k: k <= last))
    seen_y = own_y + F.size(F.filter(prefix_y, lambda k: k <= last))
    common = F.size(F.array_intersect(prefix_x, prefix_y))
    return sizes & enough(rest) & enough(common + F.least(n_x - seen_x, n_y - seen_y))


def verified(pairs: DataFrame, segments: DataFrame) -> DataFrame:
    """The links among `pairs(a, b)`: shared members are counted in each fragment and summed per pair."""
    pairs, small = stage_sized(pairs, "pairs")
    ends = pairs.select(F.col("a").alias("sid")).union(pairs.select(F.col("b").alias("sid"))).distinct()
    if small:
        own = segments.join(F.broadcast(ends), "sid", "left_semi")
        left = own.withColumnRenamed("sid", "a").join(F.broadcast(pairs), "a")
    else:
        own = segments.join(ends, "sid", "left_semi")
        left = own.withColumnRenamed("sid", "a").join(pairs, "a")
    right = own.select(F.col("sid").alias("b"), "fragment", F.col("grams").alias("others"))
    partial = left.select("a", "b", "fragment", "grams").join(right, ["b", "fragment"]).select(
        "a", "b", F.size(F.array_intersect("grams", "others")).alias("shared")
    )
    shared = partial.groupBy("a", "b").agg(F.sum("shared").alias("shared"))
    sizes = own.groupBy("sid").agg(F.first("n").alias("n"))
    return (
        shared.join(sizes.select(F.col("sid").alias("a"), F.col("n").alias("n_a")), "a")
        .join(sizes.select(F.col("sid").alias("b"), F.col("n").alias("n_b")), "b")
        .filter(F.col("shared") * (100 + PERCENT) >= (F.col("n_a") + F.col("n_b")) * PERCENT)
        .select("a", "b")
    )


def links_of(segments: DataFrame) -> DataFrame:
    """(a, b): links that hold the components of all links together."""
    rows = stage(prefixes(segments), "prefixes")
    postings = rows.select("sid", "own", F.explode("prefix").alias("gram"))
    central = F.min(F.struct("own", "sid"))["sid"]
    groups = postings.groupBy("gram").agg(central.alias("head"), F.count(F.lit(1)).alias("sets"))
    postings = postings.join(groups.filter("sets > 1"), "gram").filter("sid <> head")
    stars = postings.select(F.col("head").alias("a"), F.col("sid").alias("b")).distinct()
    first = stage(verified(_bounded(stars, rows), segments), "links")
    component = connected_components(first)
    placed = (
        postings.filter("sets > 2")
        .join(component.select(F.col("node").alias("sid"), "component"), "sid", "left")
        .join(
            component.select(F.col("node").alias("head"), F.col("component").alias("head_component")), "head", "left"
        )
        .select(
            "gram", "sid", F.coalesce("component", "sid").alias("component"),
            F.coalesce("head_component", "head").alias("head_component"),
        )
    )
    second = verified(_beside_heads(stage(placed, "postings"), rows), segments)
    return first.unionByName(second)


def _bounded(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    x = rows.withColumnRenamed("sid", "a").alias("x")
    y = rows.withColumnRenamed("sid", "b").alias("y")
    return pairs.join(x, "a").join(y, "b").filter(can_link("x", "y")).select("a", "b")


def _beside_heads(placed: DataFrame, rows: DataFrame) -> DataFrame:
    """Pairs in a group, without its head, of which one is not in the head's component, and not both
    in one. Each pair is met in the first n-gram that both prefixes hold."""
    loose = placed.filter("component <> head_component")
    others = placed.join(loose.select("gram").distinct(), "gram", "left_semi")
    x = loose.join(rows, "sid").alias("x")
    y = others.join(rows, "sid").alias("y")
    once = (F.col("y.component") == F.col("y.head_component")) | (F.col("x.sid") < F.col("y.sid"))
    first_met = F.element_at(F.array_intersect("x.prefix", "y.prefix"), 1) == F.col("x.gram")
    met = x.join(
        y,
        (F.col("x.gram") == F.col("y.gram")) & (F.col("x.component") != F.col("y.component")) & once
        & can_link("x", "y") & first_met,
    )
    return met.select(F.col("x.sid").alias("a"), F.col("y.sid").alias("b")).distinct()


def ngram_groups(documents: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row.

    A document's set holds its distinct runs of five words, A-Z in lower case; with fewer words, the whole
    sequence. Without words, or with null text, it is empty and linked with nothing. Documents link
    when their sets share 80 of 100 members of their union; component_id is the smallest doc_id
    that links reach. Equal sets are one: copies are never paired. Components are whole, whatever the
    number of documents that share an n-gram; the links themselves are not: pairs already in one
    component are skipped, so neither links nor their number can be had from here. Rows with a null doc_id take part;
    alone in their component they keep a null component_id. Repeated rows each give a row; other
    columns are ignored. Members are 62-bit hashes, sets are named by 63 bits.
    """
    members = stage(members_of(documents), "members")
    left, small = stage_sized(may_link(documents, members), "sets")
    wanted = left.select(F.col("doc_id").alias("_id")).distinct()
    rows = documents.select("doc_id", "text")
    rows = rows.join(
        F.broadcast(wanted) if small else wanted, F.col("doc_id").cast("long").eqNullSafe(F.col("_id")), "left_semi"
    )
    segments = stage(segments_of(rows).dropDuplicates(["sid", "fragment"]), "segments")
    component = connected_components(links_of(segments))
    # Members of a component are named by the smallest document of any of its sets.
    group = F.coalesce("component", "sid")
    placed = stage(
        members.join(
            component.withColumnRenamed("node", "sid"), "sid", "left"
        ).select("doc_id", "n", "sid", group.alias("group")),
        "placed",
    )
    names = placed.filter("sid is not null").groupBy("group").agg(F.min("doc_id").alias("name"))
    return placed.join(names, "group", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("sid").isNull(), F.col("doc_id")).otherwise(F.col("name")).alias("component_id"),
    )


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near duplicates among all documents."""
    return ngram_groups(read_table(spark, sf_dir, "documents"))


OP1_SQL = r"""
    WITH RECURSIVE d AS MATERIALIZED (
        SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') END AS w
        FROM documents
    ),
    g AS MATERIALIZED (
        SELECT DISTINCT doc_id, w[i : i + 4] AS gram
        FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)
    ),
    n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
    shared AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
        FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY ALL
    ),
    link AS MATERIALIZED (
        SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
        WHERE 100 * k >= 80 * (x.n + y.n - k)
    ),
    side AS MATERIALIZED (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
    reach AS (
        SELECT doc_id, doc_id AS other FROM d
        UNION SELECT r.doc_id, s.b FROM reach r JOIN side s ON s.a = r.other
    )
    SELECT doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(other) AS component_id
    FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id"""
