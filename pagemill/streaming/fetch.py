"""Fetching that goes on where a run before it ended."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill.sources.fetch import fetch_map

# Keys of one file of the list. Whole files are what a micro-batch is made of.
LISTED_KEYS = 1_000
# Files that become a micro-batch, the unit in which results are committed.
BATCH_FILES = 64
_FETCHED = ("key", "body", "error", "attempt")


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


class FetchLog:
    """Bodies by key in a shared folder, which every run adds to.

    `listed` has the keys to fetch, each once per attempt. A stream reads its files and appends what it
    fetched to `fetched`. Spark commits both sides of a micro-batch together, so a key of a
    committed one is never fetched again, whatever becomes of the application; only those of the
    micro-batch under way are. One run at a time may use the folder.
    """

    def __init__(self, spark: SparkSession, folder: str, key: T.DataType, inputs: tuple[T.DataType, ...] = ()) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        fields = [T.StructField("key", key), T.StructField("attempt", T.IntegerType())]
        self.inputs = tuple(f"input_{i}" for i in range(len(inputs)))
        self.listing = T.StructType(fields + [T.StructField(n, t) for n, t in zip(self.inputs, inputs)])
        text = [T.StructField(name, T.StringType()) for name in ("body", "error")]
        self.results = T.StructType([fields[0], *text, fields[1]])

    def _read(self, name: str, schema: T.StructType) -> DataFrame:
        path = f"{self.folder}/{name}"
        if not _exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def listed(self) -> DataFrame:
        """(key, attempt, input_0, ...) of all that was ever asked for."""
        return self._read("listed", self.listing)

    def fetched(self) -> DataFrame:
        """(key, body, error, attempt) of all committed attempts."""
        return self._read("fetched", self.results)

    def add(self, rows: DataFrame, keys_per_file: int = LISTED_KEYS) -> None:
        """List rows of `listing` whose key and attempt are not listed yet, one for each."""
        known = self.listed().select(F.col("key").alias("_key"), F.col("attempt").alias("_attempt"))
        once = rows.groupBy("key", "attempt").agg(F.min(F.struct(F.lit(0).alias("_"), *self.inputs)).alias("row"))
        same = F.col("key").eqNullSafe(F.col("_key")) & (F.col("attempt") == F.col("_attempt"))
        fresh = once.join(known, same, "left_anti").select("key", "attempt", *[f"row.{name}" for name in self.inputs])
        fresh.write.mode("append").option("maxRecordsPerFile", keys_per_file).parquet(f"{self.folder}/listed")

    def run(self, fetch: Callable[..., str], chunks: int | None, threads: int, batch_files: int) -> None:
        """Fetch what is listed and not committed, then return."""
        # A file of the list counts however long ago it was written.
        keys = (
            self.spark.readStream.schema(self.listing).option("maxFilesPerTrigger", batch_files)
            .option("maxFileAge", "36500d").parquet(f"{self.folder}/listed")
        )
        found = fetch_map(keys, "key", fetch, chunks, self.inputs, threads, keep=("attempt",))
        query = (
            found.select(*_FETCHED).writeStream.format("parquet")
            .option("checkpointLocation", f"{self.folder}/checkpoint")
            .trigger(availableNow=True)
            .start(f"{self.folder}/fetched")
        )
        query.awaitTermination()

    def failed(self, attempt: int) -> DataFrame:
        """Rows of `listing` for one more try of the keys that failed in this attempt."""
        lost = self.fetched().where(F.col("error").isNotNull() & (F.col("attempt") == attempt)).select("key")
        rows = self.listed().where(F.col("attempt") == attempt).alias("listed")
        same = F.col("listed.key").eqNullSafe(F.col("lost.key"))
        return rows.join(lost.alias("lost"), same, "left_semi").withColumn("attempt", F.lit(attempt + 1))

    def outcome(self) -> DataFrame:
        """(key, body, error, attempt), one row per key: the body, or the error of the last attempt.

        A key is tried again only after a failure, so bodies need no shuffle; only errors and keys have one.
        """
        fetched = self.fetched()
        good = fetched.where(F.col("error").isNull())
        last = F.max(F.struct("attempt", "error")).alias("last")
        errors = fetched.where(F.col("error").isNotNull()).groupBy("key").agg(last)
        later = good.where(F.col("attempt") > 1).select(F.col("key").alias("_key"))
        open_errors = errors.join(later, F.col("key").eqNullSafe(F.col("_key")), "left_anti")
        nothing = F.lit(None).cast("string").alias("body")
        return good.unionByName(open_errors.select("key", nothing, "last.error", "last.attempt"))


def fetch_resumable(
    df: DataFrame,
    key: str,
    fetch: Callable[..., str],
    folder: str,
    chunks: int | None = None,
    inputs: tuple[str, ...] = (),
    threads: int = 10,
    attempts: int = 1,
    batch_files: int = BATCH_FILES,
    keys_per_file: int = LISTED_KEYS,
) -> DataFrame:
    """(key, body, error, attempt), one row for every key of `df` and of earlier runs with this `folder`.

    As `fetch_map`, but keys that an earlier run has committed are not fetched again, be it that it
    ended early or had a shorter list. Keys that fail are tried up to `attempts` times in all; to try
    more often, call again with more. Of rows with one key the least inputs count. A null
    key is a key; an empty list gives what earlier runs found.
    """
    rows = df.select(key, *inputs)
    types = [field.dataType for field in rows.schema.fields]
    log = FetchLog(df.sparkSession, folder, types[0], tuple(types[1:]))
    named = rows.toDF("key", *log.inputs).withColumn("attempt", F.lit(1))
    log.add(named, keys_per_file)
    log.run(fetch, chunks, threads, batch_files)
    for attempt in range(1, attempts):
        again = log.failed(attempt)
        if not again.isEmpty():
            log.add(again, keys_per_file)
            log.run(fetch, chunks, threads, batch_files)
    return log.outcome().withColumnRenamed("key", key)
