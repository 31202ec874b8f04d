"""Incremental ingest of listing batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pagemill.sources import load_category_listing, load_page_listing, stage
from pagemill.sources.listing_chain import batch_links, breaks_of, token_counts
from pagemill.sources.listings import LISTING_SCHEMAS

_LOADERS = {"pages": load_page_listing, "categories": load_category_listing}
# Seconds between two looks at the progress of a query, which keeps that of its last 100 micro-batches.
_LOOK = 1
# What is kept of each token.
COUNTS = "batches bigint, named bigint, ends bigint, next string"
METRICS = ("batches", "broken", "final_batches", "entries")


def ingest_batches(
    spark: SparkSession,
    source: str,
    sink: str,
    checkpoint: str,
    kind: str = "pages",
    files_per_trigger: int | None = None,
) -> dict[str, int]:
    """Append the listing rows of every new batch file below `source` to the Parquet table `sink`.

    Processes what is there and returns. The checkpoint plays the part of a continuation token: the
    next run goes on behind the last committed file, and each file counts exactly once.

    Returns counts of this run, taken by the job that writes: `batches` read; `broken`, those without a listing;
    `final_batches`, unbroken ones without a token; `entries` listed. All are 0 if nothing was new.
    """
    reader = spark.readStream.schema(LISTING_SCHEMAS[kind])
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    read = reader.json(source)
    listing = F.col("query")[read.schema["query"].dataType.fields[0].name]
    batches = read.observe(
        "listing",
        F.count(F.lit(1)).alias("batches"),
        F.count_if(listing.isNull()).alias("broken"),
        F.count_if(listing.isNotNull() & F.col("continue").isNull()).alias("final_batches"),
        F.sum(F.coalesce(F.size(listing), F.lit(0))).alias("entries"),
    )
    query = (
        _LOADERS[kind](batches).writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(sink)
    )
    seen: dict[int, dict[str, int]] = {}
    while not query.awaitTermination(_LOOK):
        seen |= _observed(query)
    seen |= _observed(query)
    return {name: sum(counts[name] for counts in seen.values()) for name in METRICS}


def _observed(query: StreamingQuery) -> dict[int, dict[str, int]]:
    """Counts by micro-batch; one without new files has none."""
    found = {}
    for progress in query.recentProgress:
        counts = progress.observedMetrics.get("listing")
        if counts is not None:
            found[progress.batchId] = {name: counts[name] or 0 for name in METRICS}
    return found


def track_listing(
    spark: SparkSession,
    source: str,
    table: str,
    checkpoint: str,
    kind: str = "pages",
    begins: Column | None = None,
    files_per_trigger: int | None = None,
) -> None:
    """Follow the continuation tokens of every new batch file below `source`, in whatever order files come.

    Spark's state store keeps the counts of each token across micro-batches and runs, so no batch is read
    again. The counts that a micro-batch changed go to `table`, in a folder of its number, which a
    repeated micro-batch overwrites. `tracked_breaks` tells what is still open.
    """
    reader = spark.readStream.schema(LISTING_SCHEMAS[kind])
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)

    def save(changed: DataFrame, number: int) -> None:
        changed.write.mode("overwrite").parquet(f"{table}/micro_batch={number}")

    query = (
        token_counts(batch_links(reader.json(source), begins))
        .writeStream.outputMode("update")
        .foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def tracked_breaks(spark: SparkSession, table: str) -> DataFrame:
    """(problem, token): the breaks of all batches that `track_listing` has seen, as `listing_breaks` names them.

    While batches are still to come, the open ends are the missing batches and several starts.
    """
    columns = ("batches", "named", "ends", "next")
    changes = spark.read.schema(f"token string, {COUNTS}, micro_batch bigint").parquet(table)
    last = changes.groupBy("token").agg(F.max_by(F.struct(*columns), "micro_batch").alias("last"))
    return breaks_of(stage(last.select("token", "last.*"), "tokens"))
