"""First-n and exact-size samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from pagemill.sources.storage import BROADCAST_BYTES, planned_bytes, stage

# Keeps every digit that a timestamp has.
_LOSSLESS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}

# Hexadecimal digits that one counting pass looks at: 4,096 counts reach the driver.
DIGITS = 3
# Rows of one digit group whose digests may be sorted together.
SORTED_ROWS = 100_000
# Size of the quantile sketches, which tell a rank to about 0.13 % of the rows, and the margin around the cut.
SKETCH_K = 4096
MARGIN = 0.005
# The digests of a pool that is surely no larger than this are written as they are.
SMALL_BYTES = BROADCAST_BYTES
# Sketches are merged in this many tasks first and then once.
SKETCH_BRANCHES = 64
# Bits of `monotonically_increasing_id` that count the rows of a partition.
_ROW_BITS = 33


def take_first_n(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The first `n` rows by `order`."""
    return df.orderBy(*order).limit(n)


def sample_exact(
    df: DataFrame,
    n: int,
    key: str,
    seed: int = 42,
    short: str = "raise",
    sorted_rows: int = SORTED_ROWS,
) -> DataFrame:
    """Exactly `n` rows without replacement: those whose seeded MD5 of `key` comes first.

    Rows of one key are ordered by the MD5 of the whole row, and rows that are equal in all columns are
    taken in any order. The keys of `df` are read twice: for a quantile sketch that brackets the cut, and for
    the digests in the bracket. Only if rows of one key lie on both sides of the cut, whole rows
    of that key are looked at. The result then is a filter. Hand in a table or a staged result. All
    rows of the result are rows of `df`, whatever `sorted_rows` is. A pool with fewer than `n` rows is an error,
    or with `short="all"` is returned whole.
    """
    if n == 0:
        return df.limit(0)
    by_key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    by_row = F.md5(F.to_json(F.struct(*df.columns), _LOSSLESS))
    size, near, before = _bracket(df, by_key, n)
    if size < n:
        if short == "all":
            return df
        raise ValueError(f"sample of {n} is larger than the pool of {size}")
    last, need, ties = _nth(near, n - before, sorted_rows)
    earlier, same = by_key < last, by_key == last
    if need < ties:
        rows = stage(df.where(same).select(by_row.alias("digest")), "row_digests")
        last, need, ties = _nth(rows, need, sorted_rows)
        earlier, same = earlier | (same & (by_row < last)), same & (by_row == last)
    if need == ties:
        return df.where(earlier | same)
    return df.where(earlier).unionAll(_any_rows(df.where(same), need))


def _bracket(df: DataFrame, digest: Column, n: int) -> tuple[int, DataFrame, int]:
    """Rows of `df`, a staged table (digest) of those around the `n`-th, and the number of rows before these."""
    if planned_bytes(df) <= SMALL_BYTES:
        whole = stage(df.select(digest.alias("digest")), "digests")
        return whole.count(), whole, 0
    place = F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
    branch = F.pmod(F.spark_partition_id(), F.lit(SKETCH_BRANCHES))
    sketches = df.select(place.alias("place"), branch.alias("branch")).groupBy("branch").agg(
        F.kll_sketch_agg_bigint("place", SKETCH_K).alias("sketch"), F.count("*").alias("rows")
    )
    merged = sketches.agg(F.kll_merge_agg_bigint("sketch", SKETCH_K).alias("sketch"), F.sum("rows").alias("rows"))
    # A sketch of fixed size reaches the driver: ranks have to be constants.
    row = merged.first()
    size = row["rows"] or 0
    if size < n:
        return size, df.select(digest.alias("digest")), 0
    sketch, rank = F.lit(bytes(row["sketch"])), n / size
    ends = [F.lit(float(r)) for r in (max(0.0, rank - MARGIN), min(1.0, rank + MARGIN))]
    low, high = df.sparkSession.range(1).select(*[F.kll_sketch_get_quantile_bigint(sketch, r) for r in ends]).first()
    # Filter and write are one stage, each of whose tasks counts once.
    counts = Observation("sample")
    watched = df.select(digest.alias("digest"), place.alias("place")).observe(
        counts,
        F.count_if(F.col("place") < low).alias("before"),
        F.count_if(F.col("place").between(low, high)).alias("within"),
    )
    near = stage(watched.where(F.col("place").between(low, high)).select("digest"), "digests")
    before, within = counts.get["before"], counts.get["within"]
    if before < n <= before + within:
        return size, near, before
    # The sketch was off by more than the margin.
    return size, stage(df.select(digest.alias("digest")), "digests"), 0


def _nth(near: DataFrame, need: int, sorted_rows: int) -> tuple[str, int, int]:
    """The `need`-th digest of `near` in order; how many rows of it are needed, and how many there are.

    Counts per prefix narrow the rows down until few enough to be sorted are left.
    """
    prefix, rows = "", near.count()
    while rows > sorted_rows and len(prefix) < 32:
        counts = _counts(near, F.col("digest"), len(prefix))
        digits, passed = _cut(counts, need)
        need, rows, prefix = need - passed, counts[digits], prefix + digits
        near = near.where(F.col("digest").startswith(prefix))
    if len(prefix) == 32:
        return prefix, need, rows
    last = near.orderBy("digest").limit(need).agg(F.max("digest")).first()[0]
    passed, ties = near.agg(F.count_if(F.col("digest") < last), F.count_if(F.col("digest") == last)).first()
    return last, need - passed, ties


def _any_rows(copies: DataFrame, need: int) -> DataFrame:
    """`need` of rows that are all equal: whole partitions, and the first rows of one more."""
    numbered = copies.withColumn("_number", F.monotonically_increasing_id())
    part = F.shiftright("_number", _ROW_BITS)
    counts = dict(map(tuple, numbered.groupBy(part).count().collect()))
    for last in sorted(counts):
        if need <= counts[last]:
            break
        need -= counts[last]
    within = F.col("_number").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) < need
    return numbered.where((part < last) | ((part == last) & within)).drop("_number")


def _counts(df: DataFrame, digest: Column, start: int) -> dict[str, int]:
    digits = F.substring(digest, start + 1, DIGITS).alias("digits")
    return {row["digits"]: row["count"] for row in df.groupBy(digits).count().collect()}


def _cut(counts: dict[str, int], need: int) -> tuple[str, int]:
    """The digit group in which the `need`-th row lies, and the rows before it."""
    before = 0
    for digits in sorted(counts):
        if before + counts[digits] >= need:
            return digits, before
        before += counts[digits]
    raise AssertionError("fewer rows than needed")
