"""Token counts by byte-pair merging, without making identifiers."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm.common import batched, id_and_bytes, pairs_of, read_table
from pagemill.llm.merges import Vocabulary, merge_symbols, parse_vocabulary

# Fixed value: the pattern by which the vocabulary's encoder cuts text before merging.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def latin_pattern(pattern: str) -> re.Pattern:
    """The same pattern for texts of Latin-1 characters only, with its classes written out: a faster search."""
    latin = [chr(c) for c in range(256)]
    classes = {
        r"\p{L}": [c for c in latin if unicodedata.category(c)[0] == "L"],
        r"\p{N}": [c for c in latin if unicodedata.category(c)[0] == "N"],
        r"\s": list("\t\n\v\f\r \x85\xa0"),
        r"\S": [c for c in latin if c not in "\t\n\v\f\r \x85\xa0"],
    }
    inside = {name: "".join(map(re.escape, members)) for name, members in classes.items()}
    for name, members in inside.items():
        # Within a class the members stand alone; elsewhere they need brackets.
        parts = re.split(r"(\[[^\]]*\])", pattern)
        pattern = "".join(
            part.replace(name, members) if part.startswith("[") else part.replace(name, f"[{members}]")
            for part in parts
        )
    return re.compile(pattern)


# Pieces whose counts a worker remembers, and the longest that it does remember.
KEPT_PIECES = 1_000_000
KEPT_LENGTH = 48
# Texts beyond this many characters are cut piece by piece, not into one list.
LISTED_CHARS = 4_000_000

TOKEN_LIMIT = 512

SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])


def is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class PieceCounts(dict):
    """Tokens by piece. A piece not seen yet is merged; common ones are remembered."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, piece: str) -> int:
        symbols = [self.vocabulary.byte_ids[b] for b in piece.encode()]
        count = len(symbols) - merge_symbols(symbols, self.vocabulary.merges)[1]
        if len(piece) <= KEPT_LENGTH:
            if len(self) >= KEPT_PIECES:
                self.clear()
            self[piece] = count
        return count


class TextCounter:
    """Counts the tokens of texts; one per vocabulary and worker."""

    _made: dict[int, TextCounter] = {}

    def __init__(self, vocabulary: Vocabulary, content: bytes):
        from tokenizers import Tokenizer

        self.counts = PieceCounts(vocabulary)
        # Only its cutting rule is used, for characters beyond Latin-1: classes of rare characters
        # differ from one edition of the character tables to the next.
        self.cutter = Tokenizer.from_buffer(content).pre_tokenizer
        self.latin_pieces = latin_pattern(PIECES)
        self.specials = re.compile("|".join(map(re.escape, vocabulary.specials)) or r"(?!)")

    @classmethod
    def of(cls, content: bytes) -> TextCounter:
        vocabulary = parse_vocabulary(content)
        if id(vocabulary) not in cls._made:
            cls._made.clear()
            cls._made[id(vocabulary)] = cls(vocabulary, content)
        return cls._made[id(vocabulary)]

    def count(self, text: str) -> int:
        total, start = 0, 0
        for special in self.specials.finditer(text):
            total += self._between(text[start : special.start()]) + 1
            start = special.end()
        return total + self._between(text[start:])

    def _between(self, text: str) -> int:
        count = self.counts.__getitem__
        if not is_latin(text):
            return sum(count(text[a:b]) for _, (a, b) in self.cutter.pre_tokenize_str(text))
        if len(text) > LISTED_CHARS:
            return sum(count(m.group()) for m in self.latin_pieces.finditer(text))
        return sum(map(count, self.latin_pieces.findall(text)))


def token_counts(documents: DataFrame, vocabulary_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row, in the rows' own partitions: nothing is shuffled.

    Special tokens found in a text count one each, as the encoder does by default. Null texts count
    as empty; a null key stays null; repeated rows are counted each. Other columns are ignored. A
    piece of any length is merged in n log n steps. The vocabulary file is read on the driver and
    broadcast; its size does not grow with the data.
    """
    spark = documents.sparkSession
    with open(vocabulary_path, "rb") as file:
        content = spark.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TextCounter.of(content.value)

        def rows():
            for doc_id, body in pairs_of(batches):
                body = body or b""
                yield doc_id, len(body), counter.count(body.decode("utf-8", "replace"))

        yield from batched(rows(), SCHEMA)

    rows = id_and_bytes(documents, key, text).withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents with the 50k byte-level vocabulary."""
    import public_tokenizers

    counted = token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)
