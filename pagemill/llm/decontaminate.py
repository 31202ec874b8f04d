"""Benchmark decontamination by a multi-pattern search over words that skips ahead."""

from __future__ import annotations

import hashlib
import math
from array import array
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm.common import WORDS_SQL, alnum_words, batched, bytes_of, id_and_bytes, pairs_of, read_table

# Words of a window; an item with fewer, but not none, is one window.
WINDOW = 10
# Words that decide how far the search may skip.
BLOCK = 2
# Slots of the shift table for each sequence; a slot is a byte.
SLOTS = 8
# Most bytes that the search may take in a worker, and how many it takes at most for a byte of benchmark
# text: words of one letter take up to 25, those of prose 6.
INDEX_BYTES = 384 * 1024 * 1024
INDEX_FACTOR = 25
# Bytes of benchmark text that are searched for in one pass over the documents.
PASS_BYTES = INDEX_BYTES // INDEX_FACTOR


class WindowSearch:
    """All places where one of many word sequences of one length occurs.

    Blocks of words are known by a slot, some bits of a hash; there are `SLOTS` times as many slots as
    sequences, or more, so few blocks share one. Neighbouring slots share a bucket.
    `shift` says for a slot how far the end of its blocks is at least from the end of any sequence, so the
    search jumps that far; blocks that are in no sequence mostly allow the longest jump. Slots of blocks
    that end a sequence have no shift: they have a bucket of the sequences with that ending, in the order
    of their hashes, and those with the hash of the words at hand are compared as text.

    Sequences are places in `text`, the words of all items with a blank behind each; `begin` says where
    words start. Only arrays are kept, whose size does not depend on how the words repeat.
    """

    def __init__(
        self, text: bytes, begin: array, starts: np.ndarray, owners: np.ndarray, length: int, blocks: np.ndarray
    ):
        """`starts` are the first words of the sequences, `owners` their items; `blocks` has a hash of the block
        that begins at each word."""
        self.text, self.begin, self.length = text, begin, length
        self.block = min(BLOCK, length)
        self.skip = length - self.block + 1
        size = 1 << max(4, len(starts).bit_length())
        self.mask = SLOTS * size - 1
        hashes = np.fromiter((hash(self._words_at(s)) for s in starts.tolist()), np.int64, len(starts))
        slots = (blocks[starts + (length - self.block)] & self.mask) // SLOTS
        order = np.lexsort((hashes, slots))
        first, owner, held, ends = array("i"), array("i"), array("q"), array("i")
        keys = array("q")
        for (slot, hashed), same in groupby(
            zip(slots[order].tolist(), hashes[order].tolist(), starts[order].tolist(), owners[order].tolist()),
            key=lambda row: row[:2],
        ):
            # Equal sequences become one with the items of all; a hash alone does not make them equal.
            found: dict[bytes, tuple[int, set[int]]] = {}
            for _, _, start, item in same:
                found.setdefault(self._words_at(start), (start, set()))[1].add(item)
            for start, items in found.values():
                first.append(start)
                held.append(hashed)
                keys.append(slot)
                owner.extend(sorted(items))
                ends.append(len(owner))
        self.first, self.owner, self.hashes, self.ends = first, owner, held, ends
        found_at = np.searchsorted(np.frombuffer(keys, np.int64), np.arange(size + 1)) if keys else np.zeros(size + 1)
        self.bucket = array("i", found_at.astype(np.int32).tobytes())
        shift = np.full(SLOTS * size, self.skip, np.uint8)
        # The shortest shift is written last.
        for end in range(self.block, length + 1):
            shift[blocks[starts + (end - self.block)] & self.mask] = length - end
        self.shift = bytearray(shift.tobytes())

    def _words_at(self, word: int) -> bytes:
        return self.text[self.begin[word] : self.begin[word + self.length] - 1]

    def nbytes(self) -> int:
        """Bytes of the arrays of this search; text and word starts are shared with the others."""
        arrays = (self.first, self.owner, self.hashes, self.ends, self.bucket)
        return len(self.shift) + sum(a.itemsize * len(a) for a in arrays)

    def places(self, words: list[bytes]) -> Iterator[tuple[int, array]]:
        """(first word, numbers of the items) of every occurrence."""
        shift, length, mask, n = self.shift, self.length, self.mask, len(words)
        end, key = length, hash
        if self.block == 2:
            while end <= n:
                slot = key((words[end - 2], words[end - 1])) & mask
                jump = shift[slot]
                if not jump:
                    yield from self._verified(slot, words, end - length)
                    jump = 1
                end += jump
        else:
            for start in range(n):
                slot = hash(words[start]) & mask
                if not shift[slot]:
                    yield from self._verified(slot, words, start)

    def _verified(self, slot: int, words: list[bytes], start: int) -> Iterator[tuple[int, array]]:
        here = b" ".join(words[start : start + self.length])
        wanted, bucket = hash(here), slot // SLOTS
        behind = self.bucket[bucket + 1]
        k = bisect_left(self.hashes, wanted, self.bucket[bucket], behind)
        while k < behind and self.hashes[k] == wanted:
            if self._words_at(self.first[k]) == here:
                yield start, self.owner[self.ends[k - 1] if k else 0 : self.ends[k]]
            k += 1


class Benchmark:
    """The items of one pass, as searches by length of window."""

    def __init__(self, items: list[tuple[int | None, bytes | None]], window: int):
        self.ids = [item_id for item_id, _ in items]
        starts: dict[int, tuple[array, array]] = defaultdict(lambda: (array("i"), array("i")))
        every: list[bytes] = []
        for number, (_, body) in enumerate(items):
            words, before = alnum_words(body), len(every)
            every += words
            length = min(window, len(words))
            n_starts = len(words) - length + 1 if words else 0
            starts[length][0].extend(range(before, before + n_starts))
            starts[length][1].extend([number] * n_starts)
        self.text = b"".join(word + b" " for word in every)
        ends = np.cumsum([0, *(len(word) + 1 for word in every)])
        small = len(self.text) < 1 << 31
        self.begin = array("i" if small else "q", ends.astype(np.int32 if small else np.int64).tobytes())
        singles = np.fromiter(map(hash, every), np.int64, len(every))
        pairs = np.fromiter(map(hash, zip(every, every[1:])), np.int64, max(0, len(every) - 1))
        self.searches = [
            WindowSearch(
                self.text, self.begin, np.array(firsts), np.array(owners), length, singles if length == 1 else pairs
            )
            for length, (firsts, owners) in sorted(starts.items()) if length
        ]

    def nbytes(self) -> int:
        return len(self.text) + self.begin.itemsize * len(self.begin) + sum(s.nbytes() for s in self.searches)

    def search(self, words: list[bytes]) -> tuple[list[tuple[int, int]], list[int]]:
        """Hit runs of words, and the item ids found, for one text."""
        places, found = [], set()
        for search in self.searches:
            for start, items in search.places(words):
                places.append((start, start + search.length))
                found.update(items)
        places.sort()
        runs: list[list[int]] = []
        for start, end in places:
            if runs and start <= runs[-1][1]:
                runs[-1][1] = max(runs[-1][1], end)
            else:
                runs.append([start, end])
        return [tuple(r) for r in runs], sorted({self.ids[n] for n in found if self.ids[n] is not None})


class Items:
    """The items of one pass as they are broadcast. A worker process keeps a broadcast value for all its
    tasks, and with it the search that the first of them builds."""

    def __init__(self, items: list[tuple[int | None, bytes | None]], window: int):
        self.items, self.window, self.built = items, window, None

    def benchmark(self) -> Benchmark:
        if self.built is None:
            self.built = Benchmark(self.items, self.window)
        return self.built


def find_benchmark(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, pass_bytes: int = PASS_BYTES
) -> DataFrame:
    """(doc_id, n_words, runs, items) of every row of `documents`: merged runs [first, behind last) of
    words that lie in an occurrence of a benchmark window, and the ids of the items that occur.

    The benchmark's size is measured; beyond `pass_bytes` it is dealt to several passes over the
    documents, whose runs and items are put together per row. Nothing else is shuffled. Null texts
    have no words; items without words occur nowhere; an item with a null id marks words but is not
    listed; items with the same id count as one. Repeated rows keep a result each. Other columns
    are ignored.
    """
    spark = documents.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), bytes_of().alias("body"))
    total = items.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    passes = max(1, math.ceil(total / pass_bytes))
    rows = id_and_bytes(documents).withColumn("doc_id", F.col("doc_id").cast("long"))
    if passes == 1:
        return _search(spark, rows, items, window).drop("digest")
    found = None
    for n in range(passes):
        part = _search(spark, rows, items.filter(F.pmod(F.xxhash64("item_id", "body"), F.lit(passes)) == n), window)
        found = part if found is None else found.unionByName(part)
    # Equal rows have equal results in every pass, so sets of them stay small; their number is kept.
    merged = found.groupBy("doc_id", "digest", "n_words").agg(
        F.array_sort(F.flatten(F.collect_set("runs"))).alias("runs"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        F.floor(F.count(F.lit(1)) / passes).alias("copies"),
    )
    return merged.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).select(
        "doc_id", "n_words", _merged_runs("runs").alias("runs"), "items"
    )


def _merged_runs(column: str):
    """Sorted runs with those that touch or overlap put together."""
    empty = F.array().cast("array<struct<first:int,behind:int>>")

    def add(runs, run):
        last = F.try_element_at(runs, F.lit(-1))
        joined = F.struct(last["first"].alias("first"), F.greatest(last["behind"], run["behind"]).alias("behind"))
        earlier = F.slice(runs, 1, F.greatest(F.size(runs) - 1, F.lit(0)))
        return F.when(run["first"] <= last["behind"], F.concat(earlier, F.array(joined))).otherwise(
            F.concat(runs, F.array(run))
        )

    return F.aggregate(column, empty, add)


def _search(spark: SparkSession, rows: DataFrame, items: DataFrame, window: int) -> DataFrame:
    content = spark.sparkContext.broadcast(Items([tuple(r) for r in items.collect()], window))
    schema = pa.schema(
        [
            ("doc_id", pa.int64()), ("n_words", pa.int64()),
            ("runs", pa.list_(pa.struct([("first", pa.int32()), ("behind", pa.int32())]))),
            ("items", pa.list_(pa.int64())), ("digest", pa.binary()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        benchmark = content.value.benchmark()

        def found():
            for doc_id, body in pairs_of(batches):
                words = alnum_words(body)
                runs, ids = benchmark.search(words)
                yield doc_id, len(words), [{"first": a, "behind": b} for a, b in runs], ids, (
                    hashlib.blake2b(body or b"", digest_size=16).digest()
                )

        yield from batched(found(), schema, lambda row: 64 + 64 * len(row[2]) + 8 * len(row[3]))

    return rows.mapInArrow(
        run, "doc_id long, n_words long, runs array<struct<first:int,behind:int>>, items array<long>,"
        " digest binary",
    )


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents searched for all windows of ten words of the benchmark."""
    found = find_benchmark(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("runs", F.lit(0).cast("long"), lambda n, r: n + r["behind"] - r["first"])
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(names.cast("binary"), 256).alias("items_sha256"), (F.size("runs") > 0).alias("contaminated"),
    )


EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
OP5_SQL = f"""
    WITH d AS MATERIALIZED (
        SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE {WORDS_SQL.format("text")} END AS w FROM documents
    ),
    b AS (SELECT item_id, {WORDS_SQL.format("text")} AS w FROM benchmark WHERE text IS NOT NULL),
    item AS (SELECT item_id, w, least(len(w), 10) AS n FROM b WHERE len(w) > 0),
    wanted AS (
        SELECT DISTINCT item_id, n, w[i : i + n - 1] AS win
        FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM item)
    ),
    place AS (
        SELECT doc_id, i, n, w[i : i + n - 1] AS win
        FROM (
            SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
            FROM d, (SELECT DISTINCT n FROM wanted) WHERE len(w) >= n
        )
    ),
    found AS (SELECT doc_id, i, p.n, item_id FROM place p JOIN wanted USING (n, win)),
    hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (
        SELECT doc_id, unnest(range(i, i + n)) AS k FROM (SELECT DISTINCT doc_id, i, n FROM found)) GROUP BY 1),
    ids AS (SELECT doc_id, count(*) AS n_items, string_agg(v, ',' ORDER BY v) AS names FROM (
        SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS v FROM found) GROUP BY 1)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
        coalesce(sha256(names), '{EMPTY_SHA256}') AS items_sha256, n_hit IS NOT NULL AS contaminated
    FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN ids USING (doc_id)"""
