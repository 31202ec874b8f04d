"""Removal of repeated passages by sliding spans of sentences."""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill.llm.common import LOWER_ASCII, OUT_BYTES, batched, bytes_of, read_table
from pagemill.llm.numbering import identified

# A span is a run of at least so many sentences that holds at least so many words; hashed are the
# shortest that begin and the shortest that end at each sentence.
SPAN_SENTENCES = 3
SPAN_WORDS = 20
# Longer sentences are cut into clauses, after words that their own checksum picks; of so many words in a
# row of which none is picked, the one with the least checksum.
LONG_SENTENCE = 12
CLAUSE_WORDS = 5
CLAUSE_WINDOW = 8

# A sentence ends after . ! or ? before white space, or at the end of a line.
SENTENCE = re.compile(rb"[^\n.!?]*(?:[.!?]+(?!\s)[^\n.!?]*)*(?:[.!?]+\s+|\n\s*|$)")
WORD = re.compile(rb"\s*\S+\s*")
# Marks beyond ASCII that end a sentence or line whatever follows, with closing marks and blanks behind.
ENDS = "\u3002\uff0e\uff01\uff1f\uff61\u203c\u2047\u2048\u2049\u061f\u06d4\u0589\u0964\u0965\u0f0d\u0f0e\u104b\u1362\u1367\u1368\u17d4\u17d5\u2028\u2029"
CLOSING = "\u300d\u300f\uff09\u3011\u300b\u3009\u3015\uff3d\uff63\u2019\u201d\u00bb\u3000"
MARKED = re.compile(
    b"(?:%s)+(?:%s|\\s)*" % tuple(b"|".join(c.encode() for c in marks) for marks in (ENDS, CLOSING))
)
# The first bytes of these marks, and of the letters below.
BEYOND = re.compile(rb"[\xd6\xd8\xdb\xe0-\xf4]")
# Letters of scripts without blanks between words: each is a word, with the marks that belong to it.
_SPACELESS = [
    (0x0E01, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x2E80, 0x2FDF), (0x3005, 0x3007), (0x3021, 0x3029),
    (0x3031, 0x3035), (0x3041, 0x30FF), (0x3105, 0x312F), (0x31A0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF),
    (0xA000, 0xA4CF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x1B000, 0x1B16F), (0x20000, 0x3FFFF),
]
_MARKS = "".join(
    chr(c) for a, b in [*_SPACELESS[:3], (0x302A, 0x302F), (0x3099, 0x309A), (0xFE00, 0xFE0F), (0xE0100, 0xE01EF)]
    for c in range(a, b + 1) if unicodedata.category(chr(c)).startswith("M")
) + "\uff9e\uff9f"
_LETTERS = "".join(f"{chr(a)}-{chr(b)}" for a, b in _SPACELESS)
LETTER = re.compile(f"[{_LETTERS}]")
UNIT = re.compile(f"\\s*(?:[{_LETTERS}][{_MARKS}]*|[^\\s{_LETTERS}]+)\\s*")
# An odd multiplier for hashes of runs, and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
# A span's place is one number: its first sentence, its sentences, and whether its equal came before in
# the chunk. All sentences but the first of a text hold a word, so the shortest spans have at most
# SPAN_WORDS + 1 sentences.
SIZE_BITS = 6
START_AT = SIZE_BITS + 1


def words_of(piece: bytes) -> list[bytes]:
    """The words of a piece with the white space around them. Where a script has no blanks, its letters."""
    if BEYOND.search(piece) and LETTER.search(text := piece.decode("utf-8", "surrogateescape")):
        return [unit.encode("utf-8", "surrogateescape") for unit in UNIT.findall(text)]
    return WORD.findall(piece)


def count_words(piece: bytes) -> int:
    return len(words_of(piece)) if BEYOND.search(piece) else len(piece.split())


def clauses(words: list[bytes]) -> Iterator[bytes]:
    """The words put together up to those that are picked, by nothing but words near them, in lower case."""
    sums = [zlib.crc32(word.translate(LOWER_ASCII).strip()) for word in words]
    picked = [n for n, value in enumerate(sums) if value % CLAUSE_WORDS == 0]
    chosen, before = {*picked, len(words) - 1}, -1
    for behind in [*picked, len(words)]:
        best = -1
        for last in range(before + CLAUSE_WINDOW, behind):
            # The least of the window that ends here; of equal ones the last.
            if best <= last - CLAUSE_WINDOW:
                best = min(range(last, last - CLAUSE_WINDOW, -1), key=sums.__getitem__)
            elif sums[last] <= sums[best]:
                best = last
            chosen.add(best)
        before = behind
    first = 0
    for n in sorted(chosen):
        yield b"".join(words[first : n + 1])
        first = n + 1


def sentences(body: bytes) -> list[bytes]:
    """The text cut into sentences and clauses, each with the white space behind it."""
    found = []
    for line in SENTENCE.findall(body):
        for piece in _marked(line) if BEYOND.search(line) else [line]:
            # A word and its blank have two bytes; so has a letter, or more.
            if len(piece) > 2 * LONG_SENTENCE and len(words := words_of(piece)) > LONG_SENTENCE:
                found.extend(clauses(words))
            elif piece:
                found.append(piece)
    return found


def _marked(line: bytes) -> Iterator[bytes]:
    first = 0
    for mark in MARKED.finditer(line):
        yield line[first : mark.end()]
        first = mark.end()
    yield line[first:]


class Powers:
    """Powers of a number modulo 2**64, as many as were asked for so far."""

    def __init__(self, base: int):
        self.base = np.uint64(base)
        self.known = np.ones(1, np.uint64)

    def first(self, n: int) -> np.ndarray:
        if n > len(self.known):
            factors = np.full(max(n, 4096), self.base, np.uint64)
            factors[0] = 1
            self.known = np.multiply.accumulate(factors)
        return self.known[:n]


def mixed(values: np.ndarray) -> np.ndarray:
    """Every bit of a 64-bit value spread over all bits."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def span_hashes(body: bytes, up: Powers, down: Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first sentence, behind last sentence) of the shortest spans that begin or end at a sentence.

    These cover every longer run: from its first sentence on, the shortest spans that begin in it and do
    not pass its end; what they leave at its end lies in the shortest span that ends there.
    """
    digests, counts = [], []
    for piece in sentences(body):
        words = piece.translate(LOWER_ASCII).split()
        counts.append(len(words_of(piece)) if BEYOND.search(piece) else len(words))
        digests.append(xxhash.xxh3_64_intdigest(b" ".join(words)))
    n = len(counts)
    words_before = np.zeros(n + 1, np.int64)
    np.cumsum(counts, out=words_before[1:])
    start = np.arange(n)
    behind = np.searchsorted(words_before, words_before[:-1] + SPAN_WORDS)
    behind = np.maximum(behind, start + SPAN_SENTENCES)
    start, behind = start[behind <= n], behind[behind <= n]
    ends = np.arange(1, n + 1)
    begins = np.searchsorted(words_before, words_before[1:] - SPAN_WORDS, side="right") - 1
    begins = np.minimum(begins, ends - SPAN_SENTENCES)
    ends, begins = ends[begins >= 0], begins[begins >= 0]
    both = np.unique(np.concatenate([start * (n + 1) + behind, begins * (n + 1) + ends]))
    start, behind = both // (n + 1), both % (n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(np.array(digests, np.uint64) * up.first(n), out=sums[1:])
    hashes = (sums[behind] - sums[start]) * down.first(n)[start]
    return mixed(hashes + (behind - start).astype(np.uint64)), start, behind


SPANS = pa.schema([("hash", pa.int64()), ("doc_id", pa.int64()), ("place", pa.int64())])


def spans(documents: DataFrame) -> DataFrame:
    """(hash, doc_id, place): spans that may be the first of their kind, one per hash and chunk of rows, and
    spans that are not, with an even or odd `place`.

    `place` holds the first sentence and the number of sentences, and a last bit for a span whose equal
    came before in the chunk. Those need no further look; their hash is
    drawn from their place, so that they do not meet.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up, down = Powers(BASE), Powers(BASE_INVERSE)

        def chunks():
            held, held_bytes = [], 0
            for batch in batches:
                for doc_id, body in zip(batch.column(0), batch.column(1)):
                    body = body.as_py() or b""
                    hashes, start, behind = span_hashes(body, up, down)
                    if len(hashes):
                        place = start << START_AT | (behind - start) << 1
                        held.append((hashes, place, doc_id.as_py()))
                        held_bytes += 32 * len(hashes)
                    if held_bytes >= OUT_BYTES:
                        yield held
                        held, held_bytes = [], 0
            if held:
                yield held

        for held in chunks():
            hashes, place = (np.concatenate([h[k] for h in held]) for k in range(2))
            lengths = [len(h[0]) for h in held]
            doc_id = np.repeat(np.array([h[2] for h in held], np.int64), lengths)
            order = np.lexsort((place, doc_id, hashes))
            hashes, place, doc_id = (v[order] for v in (hashes, place, doc_id))
            later = np.zeros(len(hashes), bool)
            # Equal rows of the table are equally first.
            later[1:] = (hashes[1:] == hashes[:-1]) & ~((doc_id[1:] == doc_id[:-1]) & (place[1:] == place[:-1]))
            same = np.flatnonzero(~later[1:] & (hashes[1:] == hashes[:-1])) + 1
            for n in same:
                later[n] = later[n - 1]
            own = mixed(doc_id.astype(np.uint64) * np.uint64(BASE) + place.astype(np.uint64))
            hashes = np.where(later, own, hashes)
            yield from _span_batches(hashes, doc_id, place + later)

    rows = documents.select("doc_id", bytes_of().alias("body"))
    return rows.mapInArrow(run, "hash long, doc_id long, place long")


def _span_batches(hashes, doc_id, place, rows: int = 100_000) -> Iterator[pa.RecordBatch]:
    for n in range(0, len(hashes), rows):
        part = slice(n, n + rows)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(hashes[part].view(np.int64)), pa.array(doc_id[part]), pa.array(place[part].astype(np.int64))
            ],
            schema=SPANS,
        )


def repeated_spans(documents: DataFrame) -> DataFrame:
    """(doc_id, first, behind): runs of sentences that repeat a span which came before.

    Before means a smaller doc_id, or the same and an earlier sentence. Equal spans meet
    in one shuffle, after at most one per chunk of rows is left of each: a span that a third of all
    documents hold gives a row per chunk, not per document.
    """
    order = Window.partitionBy("hash").orderBy("doc_id", "place")
    ranked = spans(documents).withColumn("rank", F.rank().over(order))
    later = ranked.filter((F.col("rank") > 1) | (F.col("place") % 2 == 1))
    first = F.shiftright("place", START_AT)
    size = F.shiftright("place", 1).bitwiseAND(F.lit((1 << SIZE_BITS) - 1))
    return later.select("doc_id", first.alias("first"), (first + size).alias("behind"))


def dedup_sentences(documents: DataFrame) -> DataFrame:
    """`documents` with repeated passages removed from `text`, and `n_sentences`, `n_removed`, `words_removed`.

    Sentences end at marks of many scripts and at the ends of lines. Those of more than `LONG_SENTENCE`
    words are cut into clauses of `CLAUSE_WINDOW` words at most, but for the ends, by their words in lower
    case. A letter of a script without blanks counts as a word.

    Every run of `SPAN_SENTENCES` or more consecutive sentences with `SPAN_WORDS` words or more counts, by
    its lower-case words; sentences in a run that is not the first of its kind go, with the white space
    behind them. The shortest runs that begin and that end at each sentence are hashed; together they
    cover every longer one. Runs are judged on the input, not on what is left. A passage that repeats
    loses all but the pieces of sentences at its ends; a copy of a whole text loses all. Null text stays null and has no sentences; rows that
    are equal in id and text are one document and have equal results; rows with one id and different
    texts are different documents. Other columns stay as they are; old columns with the new names
    are replaced. Hashes have 64 bits. Any number of rows may share a passage.
    """
    documents = documents.drop("n_sentences", "n_removed", "words_removed")
    rows = identified(documents)
    packed = (F.shiftleft(F.col("first"), 32) + F.col("behind")).alias("run")
    removed = repeated_spans(rows).select("doc_id", packed).groupBy("doc_id").agg(F.collect_set("run").alias("runs"))
    joined = rows.join(removed, "doc_id", "left").select("row", "runs")
    names, text_at = documents.columns, documents.columns.index("text")
    numbers = ("n_sentences", "n_removed", "words_removed")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts = [], []
            columns = batch.column(0).flatten()
            for text, runs in zip(columns[text_at], batch.column(1)):
                left, *found = without_runs(text.as_py(), runs.as_py())
                texts.append(left)
                counts.append(found)
            columns[text_at] = pa.array(texts, pa.string())
            columns += [pa.array([c[k] for c in counts], pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, *numbers])

    schema = T.StructType(list(documents.schema.fields))
    for name in numbers:
        schema = schema.add(name, "long")
    return joined.mapInArrow(run, schema)


def without_runs(text: str | None, runs: list[int] | None) -> tuple[str | None, int, int, int]:
    """The text without the sentences of the runs; its sentences, those removed, and their words."""
    if text is None:
        return None, 0, 0, 0
    pieces = sentences(text.encode())
    gone = np.zeros(len(pieces) + 1, np.int64)
    for packed in runs or ():
        gone[packed >> 32] += 1
        gone[packed & 0xFFFFFFFF] -= 1
    gone = np.cumsum(gone) > 0
    left = b"".join([p for p, g in zip(pieces, gone) if not g])
    words = sum(count_words(p) for p, g in zip(pieces, gone) if g)
    return left.decode(), len(pieces), int(gone.sum()), words


def op7_sentence_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the sentences of spans that came before."""
    found = dedup_sentences(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_sentences", "n_removed", "words_removed", "text")
