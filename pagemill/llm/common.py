"""Helpers that the operators of this package share."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows of results that a task holds before it hands them on, in rows and in bytes of payload.
OUT_ROWS = 4096
OUT_BYTES = 16 * 1024 * 1024

# A-Z to a-z, all other bytes as they are.
LOWER_ASCII = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
# As before, and every ASCII byte that is neither letter nor digit becomes a blank.
LOWER_ALNUM = bytes(
    b if chr(b).isalnum() or b >= 0x80 else 0x20 for b in LOWER_ASCII
)


# The same words in SQL.
WORDS_SQL = (
    r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    r" '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bytes_of(text: str = "text") -> Column:
    """A text column as its UTF-8 bytes. Null stays null."""
    return F.col(f"`{text}`").cast("binary")


def id_and_bytes(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Just the key and the bytes of the text, whatever other columns there are."""
    return df.select(F.col(f"`{key}`").alias("doc_id"), bytes_of(text).alias("body"))


def blank_words(body: bytes | None) -> list[bytes]:
    """Words between white space (space, tab to carriage return), A-Z in lower case."""
    return [] if body is None else body.translate(LOWER_ASCII).split()


def alnum_words(body: bytes | None) -> list[bytes]:
    """Runs of ASCII letters and digits and of characters beyond ASCII, A-Z in lower case."""
    return [] if body is None else body.translate(LOWER_ALNUM).split()


def hash64(value: bytes) -> int:
    """A 64-bit digest that is the same in every process."""
    return int.from_bytes(hashlib.blake2b(value, digest_size=8).digest(), "little")


def batched(rows: Iterable[tuple], schema: pa.Schema, size=lambda row: 64) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of bounded length and payload."""
    held, held_bytes = [], 0
    for row in rows:
        held.append(row)
        held_bytes += size(row)
        if len(held) >= OUT_ROWS or held_bytes >= OUT_BYTES:
            yield record_batch(held, schema)
            held, held_bytes = [], 0
    if held:
        yield record_batch(held, schema)


def record_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(values, type=field.type) for values, field in zip(columns, schema)], schema=schema
    )


def pairs_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of two-column batches, one after the other."""
    for batch in batches:
        first, second = batch.column(0), batch.column(1)
        for i in range(batch.num_rows):
            yield first[i].as_py(), second[i].as_py()
