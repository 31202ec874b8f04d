"""Byte-pair encoding by guessing and checking, and decoding."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm.common import batched, id_and_bytes, pairs_of, read_table
from pagemill.llm.merges import Vocabulary, byte_letters, merge_symbols, parse_vocabulary
from pagemill.llm.token_counts import is_latin, latin_pattern

# Fixed value: the pattern by which the vocabulary's encoder finds words in normalised text.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Words whose tokens a worker remembers, and the longest that it does remember.
KEPT_WORDS = 600_000
KEPT_LENGTH = 48

IDS = pa.list_(pa.int32())
ENCODED = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", IDS)])
DECODED = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])


class PairCheck:
    """Says for many pairs of tokens at once whether the exact encoder would leave both side by side.

    Tokens a and b stay as they are if no merge crosses the place where they touch. Undoing the
    merges of both from the last to the first shows every pair of parts that ever touched there; a
    pair that has a merge of its own, earlier than the next merge of either part, would have been
    merged. Among merges of one rank the left place goes first.
    """

    def __init__(self, vocabulary: Vocabulary):
        size = max(vocabulary.ids.values()) + 1
        self.made_at = np.full(size, -1, np.int64)  # rank of the merge that makes the token
        self.left = np.zeros(size, np.int64)
        self.right = np.zeros(size, np.int64)
        keys = np.empty(len(vocabulary.merges), np.int64)
        for n, ((left, right), (rank, token)) in enumerate(vocabulary.merges.items()):
            self.made_at[token], self.left[token], self.right[token] = rank, left, right
            keys[n] = left << 32 | right
        ranks = np.fromiter((rank for rank, _ in vocabulary.merges.values()), np.int64, len(keys))
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], ranks[order]
        # A token is sound if the exact encoder makes it from its own letters.
        made = np.flatnonzero(self.made_at >= 0)
        self.sound = np.ones(size, bool)
        self.sound[made] = self._compatible(self.left[made], self.right[made], self.made_at[made])
        while True:
            parts = self.sound[self.left[made]] & self.sound[self.right[made]]
            if (self.sound[made] <= parts).all():
                break
            self.sound[made] &= parts

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair, or a very high one where there is none."""
        none = np.iinfo(np.int64).max
        if not len(self.keys):
            return np.full(len(left), none)
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], none)

    def _compatible(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray) -> np.ndarray:
        result = np.ones(len(a), bool)
        open_ = np.arange(len(a))
        a, b, limit = a.copy(), b.copy(), limit.copy()
        while len(open_):
            crossed = self.rank_of(a, b) < limit
            result[open_[crossed]] = False
            made_a, made_b = self.made_at[a], self.made_at[b]
            going = ~crossed & (np.maximum(made_a, made_b) >= 0)
            undo_left = made_a > made_b
            limit = np.where(undo_left, made_a, made_b + 1)[going]
            a, b = np.where(undo_left, self.right[a], a)[going], np.where(undo_left, b, self.left[b])[going]
            open_ = open_[going]
        return result

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each pair: do a and b stand side by side in the exact encoding of both texts joined?"""
        pairs, where = np.unique(a << 32 | b, return_inverse=True)
        none = np.full(len(pairs), np.iinfo(np.int64).max)
        return self._compatible(pairs >> 32, pairs & 0xFFFFFFFF, none)[where]


class Encoder:
    """Encodes and decodes texts; one per vocabulary and worker."""

    _made: dict[int, Encoder] = {}

    def __init__(self, vocabulary: Vocabulary, content: bytes):
        from tokenizers import Tokenizer

        self.vocabulary = vocabulary
        self.letters = byte_letters()
        self.longest = max(len(t.removesuffix(vocabulary.end_of_word)) for t in vocabulary.ids)
        # Length of the longest token by its first three letters.
        self.reach: dict[str, int] = {}
        for token in vocabulary.ids:
            token = token.removesuffix(vocabulary.end_of_word)
            self.reach[token[:3]] = max(self.reach.get(token[:3], 2), len(token))
        self.latin_words = latin_pattern(WORDS)
        self.specials = re.compile("|".join(map(re.escape, vocabulary.specials)) or r"(?!)")
        self.check = PairCheck(vocabulary)
        self.known: dict[str, list[int]] = {}
        # Only these are used of it: the normaliser beyond ASCII, the cutting rule beyond Latin-1,
        # as classes of rare characters differ from one edition of the character tables to the next.
        described = Tokenizer.from_buffer(content)
        self.normalizer, self.cutter = described.normalizer, described.pre_tokenizer
        self.tokens = vocabulary.tokens
        # Per word its packed ids and its decoded text, for round trips.
        self.packed: dict[str, bytes] = {}
        self.decoded: dict[str, str] = {}
        self.exact_words = 0

    @classmethod
    def of(cls, content: bytes) -> Encoder:
        vocabulary = parse_vocabulary(content)
        if id(vocabulary) not in cls._made:
            cls._made.clear()
            cls._made[id(vocabulary)] = cls(vocabulary, content)
        return cls._made[id(vocabulary)]

    def cut(self, text: str) -> list[list[str]]:
        """Words of the parts between special tokens, each special token as a part of its own."""
        parts, start = [], 0
        for special in self.specials.finditer(text):
            parts.append(self._words(text[start : special.start()]))
            parts.append([special.group()])
            start = special.end()
        parts.append(self._words(text[start:]))
        return parts

    def _words(self, part: str) -> list[str]:
        if part.isascii():
            return self.latin_words.findall(part.lower())
        part = self.normalizer.normalize_str(part)
        if is_latin(part):
            return self.latin_words.findall(part)
        return [part[a:b] for _, (a, b) in self.cutter.pre_tokenize_str(part)]

    def propose(self, word: str) -> list[int]:
        """Greedy longest match from the left; the last token ends the word."""
        ids, end = self.vocabulary.ids, self.vocabulary.end_of_word
        letters = "".join([self.letters[b] for b in word.encode()])
        found, at, n = [], 0, len(letters)
        while at < n:
            if n - at <= self.longest and (token := ids.get(letters[at:] + end)) is not None:
                found.append(token)
                break
            for stop in range(min(n - 1, at + self.reach.get(letters[at : at + 3], 2)), at, -1):
                if (token := ids.get(letters[at:stop])) is not None:
                    break
            found.append(token)
            at = stop
        return found

    def exact(self, word: str) -> list[int]:
        body = word.encode()
        symbols = [self.vocabulary.byte_ids[b] for b in body[:-1]]
        symbols.append(self.vocabulary.final_byte_ids[body[-1]])
        return [s for s in merge_symbols(symbols, self.vocabulary.merges)[0] if s >= 0]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Tokens of each word: all are guessed, all touching pairs are checked at once, and the
        words that fail are merged exactly."""
        guesses = [self.propose(word) for word in words]
        flat = np.fromiter((t for g in guesses for t in g), np.int64)
        lengths = np.fromiter(map(len, guesses), np.int64, len(guesses))
        owner = np.repeat(np.arange(len(guesses)), lengths)
        good = np.ones(len(guesses), bool)
        good[owner[~self.check.sound[flat]]] = False
        touching = np.flatnonzero(owner[1:] == owner[:-1])
        if len(touching):
            fits = self.check.compatible(flat[touching], flat[touching + 1])
            good[owner[touching[~fits]]] = False
        for n in np.flatnonzero(~good):
            guesses[n] = self.exact(words[n])
            self.exact_words += 1
        return guesses

    def encode_batch(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Token ids of each text. Words not seen yet are encoded for all texts together."""
        cut = [self.cut(text) for text in texts]
        specials = self.vocabulary.specials
        if len(self.known) > KEPT_WORDS:
            self.known.clear()
        new = {w for parts in cut for part in parts for w in part} - self.known.keys() - specials.keys()
        new = list(new)
        table = {w: [i] for w, i in specials.items()}
        for start in range(0, len(new), 50_000):
            some = new[start : start + 50_000]
            for word, ids in zip(some, self.encode_words(some)):
                (self.known if len(word) <= KEPT_LENGTH else table)[word] = ids
        for parts in cut:
            ids: list[int] = []
            for part in parts:
                if len(part) == 1 and part[0] in table:
                    ids += table[part[0]]
                    continue
                for word in part:
                    ids += self.known[word] if word in self.known else table[word]
            yield np.array(ids, np.int32)

    def round_trip(self, texts: list[str]) -> Iterator[tuple[bytes, str]]:
        """Of each text its ids, as little-endian unsigned 32-bit integers, and the text they decode to.

        Both are made per word, once, and put together per text: tokens never cross words, and
        decoding sets a blank between any two tokens.
        """
        cut = [list(chain.from_iterable(self.cut(text))) for text in texts]
        packed, decoded = self.packed, self.decoded
        if len(packed) > KEPT_WORDS:
            packed.clear()
            decoded.clear()
        new = list(set().union(*cut) - packed.keys())
        special = [w for w in new if w in self.vocabulary.specials]
        for word in special:
            self._remember(word, [self.vocabulary.specials[word]])
        plain = [w for w in new if w not in self.vocabulary.specials]
        for start in range(0, len(plain), 50_000):
            some = plain[start : start + 50_000]
            for word, ids in zip(some, self.encode_words(some)):
                self._remember(word, ids)
        for words in cut:
            # A word without tokens leaves no blank.
            text = " ".join(filter(None, map(decoded.__getitem__, words)))
            yield b"".join(map(packed.__getitem__, words)), text
        for word in new:
            if len(word) > KEPT_LENGTH:
                del packed[word], decoded[word]

    def _remember(self, word: str, ids: list[int]) -> None:
        self.packed[word] = np.array(ids, "<u4").tobytes()
        self.decoded[word] = self.decode(ids)

    def decode(self, ids) -> str:
        """Token texts with a blank between, as the encoder's library joins tokens without a decoder."""
        tokens = self.tokens
        return " ".join([tokens[i] for i in ids])


def texts_by_size(rows: Iterator[tuple], chars: int = 4_000_000) -> Iterator[tuple[list, list]]:
    """Keys and texts in runs of bounded length; null is empty."""
    keys, texts, held = [], [], 0
    for key, body in rows:
        keys.append(key)
        texts.append((body or b"").decode("utf-8", "replace"))
        held += len(texts[-1])
        if held >= chars:
            yield keys, texts
            keys, texts, held = [], [], 0
    if keys:
        yield keys, texts


def _shared(spark: SparkSession, path: str):
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def bpe_encode(documents: DataFrame, vocabulary_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids) of every row, in the rows' own partitions: nothing is shuffled.

    Null and blank texts have no tokens; a null key stays null; repeated rows are encoded each; other
    columns are ignored. Special tokens found in a text become their ids. The vocabulary file is
    read on the driver and broadcast; its size does not grow with the data.
    """
    content = _shared(documents.sparkSession, vocabulary_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(content.value)

        def rows():
            for keys, texts in texts_by_size(pairs_of(batches)):
                for doc_id, ids in zip(keys, encoder.encode_batch(texts)):
                    yield doc_id, len(ids), ids

        yield from batched(rows(), ENCODED, lambda row: 64 + row[2].nbytes)

    rows = id_and_bytes(documents, key, text).withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids array<int>")


def bpe_decode(encoded: DataFrame, vocabulary_path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids). Null ids decode to the empty text."""
    content = _shared(encoded.sparkSession, vocabulary_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(content.value)
        rows = ((doc_id, encoder.decode(ids or [])) for doc_id, ids in pairs_of(batches))
        yield from batched(rows, DECODED, lambda row: 64 + 2 * len(row[1]))

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def bpe_round_trip(documents: DataFrame, vocabulary_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): digests of the ids, as little-endian unsigned
    32-bit integers, and of the text that they decode to, in one pass. Rules for odd rows are those of
    `bpe_encode`.
    """
    content = _shared(documents.sparkSession, vocabulary_path)
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(content.value)

        def rows():
            for keys, texts in texts_by_size(pairs_of(batches)):
                for doc_id, (ids, decoded) in zip(keys, encoder.round_trip(texts)):
                    yield (
                        doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(),
                        hashlib.sha256(decoded.encode()).hexdigest(),
                    )

        yield from batched(rows(), schema, lambda row: 256)

    rows = id_and_bytes(documents, key, text).withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op8_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of all documents with the 49k word vocabulary, and the digest of what they decode to."""
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe_round_trip(read_table(spark, sf_dir, "documents"), path)
