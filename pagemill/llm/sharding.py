"""Global shuffle into shards in two passes, with DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagemill.llm.common import read_table
from pagemill.sources.storage import BROADCAST_BYTES, stage

# Bytes of records that one bucket holds on average; a bucket is shuffled in memory.
BUCKET_BYTES = 32 * 1024 * 1024
ROW_OVERHEAD = 8
# Runs of this many buckets are summed on their own before the sums are added up; copies of one
# record are numbered in runs of as many.
RUN = 4096
# Bytes per bucket of the table of bucket starts, which is copied to every executor only within
# the general bound for that.
START_BYTES = 32
MOST_PARTITIONS = 100_000
# Records of a file of a shard.
FILE_ROWS = 100_000


def record_size(text: str = "text") -> Column:
    """UTF-8 bytes of the text (null: none) plus eight."""
    return F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)).cast("long") + F.lit(ROW_OVERHEAD)


def shuffled_shards(
    df: DataFrame, n_shards: int, seed: int = 42, bucket_bytes: int = BUCKET_BYTES, text: str = "text"
) -> DataFrame:
    """`df` with `shard` and `slot`: a seeded uniform shuffle, dealt to shards whose row counts differ
    by one at most; slots of a shard count from 0 without gaps.

    Pass 1 scatters the records into buckets of about `bucket_bytes` by a seeded hash of the whole
    record, so a hot key or source does not meet in one bucket. Pass 2 draws a seeded Fisher-Yates
    permutation of each bucket (`shuffle` does one over an array) from records in a fixed order, so a
    lost task gives the same rows when it runs again. A record's place in the global order, the
    rows of earlier buckets plus its place in the bucket, gives shard and slot. The records are
    shuffled once.

    Columns of `df` may have any names and may be null; equal rows all stay; an empty table gives
    no rows. Old columns `shard` and `slot` are replaced. Columns of a type that cannot be hashed or
    sorted (maps) are not supported.
    """
    df = df.drop("shard", "slot")
    size = record_size(text)
    columns = [F.col(f"`{c}`") for c in df.columns]
    records = df.select(
        F.struct(*columns).alias("_record"), F.xxhash64(F.lit(seed), *columns).alias("_digest"), size.alias("_size")
    )
    total = records.agg(F.sum("_size")).first()[0] or 0
    n_buckets = max(1, math.ceil(total / bucket_bytes))
    scattered = _with_copies(records, seed, bucket_bytes).select(
        F.pmod("_spot", F.lit(n_buckets)).cast("int").alias("_bucket"), "_spot", "_record"
    )
    starts = _bucket_starts(scattered.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_rows")))
    if n_buckets * START_BYTES <= BROADCAST_BYTES:
        starts = F.broadcast(starts)
    # One partition per bucket, not by its hash; equal spots are put in order by the record itself.
    ordered = F.sort_array(F.collect_list(F.struct("_spot", "_record")))
    buckets = (
        scattered.repartitionById(min(n_buckets, MOST_PARTITIONS), "_bucket")
        .groupBy("_bucket").agg(ordered.alias("_rows"))
        .sortWithinPartitions("_bucket")
        .select("_bucket", F.shuffle("_rows", seed).alias("_rows"))
    )
    placed = buckets.join(starts, "_bucket").select("_start", F.posexplode("_rows").alias("_place", "_row"))
    place = F.col("_start") + F.col("_place")
    return placed.select(
        *[F.col("_row")["_record"][n].alias(n) for n in df.columns],
        (place % n_shards).cast("int").alias("shard"),
        F.floor(place / n_shards).alias("slot"),
    )


def _with_copies(records: DataFrame, seed: int, bucket_bytes: int) -> DataFrame:
    """The records with their spot, by which they are scattered.

    Records so often repeated that their copies would fill a good part of a bucket are counted
    before they are shuffled, and each copy gets a spot of its own. There are at most four of them
    per bucket, mostly none: then nothing is joined.
    """
    heavy = (
        records.groupBy("_digest")
        .agg(F.count(F.lit(1)).alias("_n"), F.sum("_size").alias("_bytes"))
        .filter((F.col("_n") > 1) & (F.col("_bytes") > bucket_bytes // 4))
    )
    heavy = stage(heavy.select("_digest"), "repeated-records")
    spread = records.select("_record", F.col("_digest").alias("_spot"))
    if heavy.isEmpty():
        return spread
    copies = (
        records.join(heavy, "_digest", "left_semi").groupBy("_record").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_block", F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / RUN))))
        .withColumn(
            "_copy",
            F.explode(F.sequence(F.col("_block") * RUN, F.least(F.col("_n"), (F.col("_block") + 1) * RUN) - 1)),
        )
        .select("_record", F.xxhash64(F.lit(seed), "_copy", "_record").alias("_spot"))
    )
    others = records.join(heavy, "_digest", "left_anti").select("_record", F.col("_digest").alias("_spot"))
    return others.unionByName(copies)


def _bucket_starts(counts: DataFrame) -> DataFrame:
    """(_bucket, _start): rows of all earlier buckets. Sums are taken over runs of buckets first."""
    runs = counts.withColumn("_run", F.floor(F.col("_bucket") / RUN))
    before = Window.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    run_starts = (
        runs.groupBy("_run").agg(F.sum("_rows").alias("_run_rows"))
        .select("_run", F.coalesce(F.sum("_run_rows").over(before), F.lit(0)).alias("_run_start"))
    )
    within = Window.partitionBy("_run").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return runs.join(run_starts, "_run").select(
        "_bucket", (F.col("_run_start") + F.coalesce(F.sum("_rows").over(within), F.lit(0))).alias("_start")
    )


def write_shards(sharded: DataFrame, path: str, file_rows: int = FILE_ROWS) -> None:
    """Writes `sharded` below `path`: a folder per shard, in it one per block of `file_rows` slots, in it
    one file with the records in the order of their slots.

    Blocks are the unit of work, so the number of shards does not bound the number of tasks. A task that
    runs again writes the same files. An old column `block` is replaced. An empty table has no folders.
    """
    blocks = sharded.withColumn("block", F.floor(F.col("slot") / file_rows))
    (
        blocks.repartition("shard", "block").sortWithinPartitions("shard", "block", "slot")
        .write.partitionBy("shard", "block").parquet(path)
    )


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, shuffled and dealt to 24 shards by the law `rows`."""
    sharded = shuffled_shards(read_table(spark, sf_dir, "documents"), 24)
    return sharded.select(
        "doc_id",
        record_size().alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
