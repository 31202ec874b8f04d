"""Bloom filters of text keys: a large side drops, where it is read, the rows that no key can match."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits for each key, and how many of the 64 of its word a key sets; about one of 100 other keys passes.
BITS_PER_KEY = 16
PICKS = 4
# Most words of a filter, which bounds what is broadcast to about 50 MB. From 4 million keys on the bits
# for each shrink: at 8 million one of 15 other keys passes, at 16 million one of 4.
MOST_WORDS = 1 << 20
# Keys from which on most of what a filter could drop would pass.
MOST_KEYS = 32_000_000


def _hashed(key: str | Column, words: int) -> tuple[Column, Column]:
    """The word of a key and the bits that it sets there."""
    place = F.pmod(F.xxhash64(key), F.lit(words))
    picks = F.xxhash64(F.lit(1), key)
    one = F.lit(1).cast("long")
    bits = [
        F.call_function("shiftleft", one, F.shiftright(picks, 6 * i).bitwiseAND(F.lit(63)).cast("int"))
        for i in range(PICKS)
    ]
    return place, reduce(Column.bitwiseOR, bits)


@dataclass(frozen=True)
class KeyFilter:
    """Says of a key that it is surely not, or perhaps, among those the filter was made of.

    All bits of a key lie in one word of 64, so the filter is a table of words that is made by one
    aggregate, merged by another, and looked up by one join with a table of bounded size.
    """

    table: DataFrame
    words: int

    @classmethod
    def of(cls, keys: DataFrame, on: str, expected: int, most_words: int = MOST_WORDS) -> KeyFilter:
        """A filter of the keys in column `on`, sized for `expected` different ones; NULL is none."""
        wanted = max(1, expected * BITS_PER_KEY // 64)
        words = min(1 << (wanted - 1).bit_length(), most_words)
        word, bits = _hashed(on, words)
        rows = keys.where(F.col(on).isNotNull()).select(word.alias("_word"), bits.alias("_bits"))
        return cls(rows.groupBy("_word").agg(F.bit_or("_bits").alias("_bits")), words)

    def merged(self, other: KeyFilter) -> KeyFilter:
        """The filter of the keys of both; they must have the same number of words."""
        if self.words != other.words:
            raise ValueError(f"filters of {self.words} and {other.words} words")
        both = self.table.unionAll(other.table)
        return KeyFilter(both.groupBy("_word").agg(F.bit_or("_bits").alias("_bits")), self.words)

    def keep_possible(self, df: DataFrame, on: str) -> DataFrame:
        """The rows of `df` whose key is perhaps among those of the filter. Rows are not shuffled."""
        word, bits = _hashed(on, self.words)
        probed = df.where(F.col(on).isNotNull()).withColumn("_word", word)
        found = probed.join(F.broadcast(self.table), "_word")
        return found.where(F.col("_bits").bitwiseAND(bits) == bits).select(*df.columns)
