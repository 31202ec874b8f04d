"""Whether the batches of a listing follow each other without a gap, from their continuation tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.sources.storage import stage

MISSING, REPEATED, FORKED = "missing batch", "repeated batch", "repeated continuation"
STARTS, NO_START = "several starts", "no start"
ENDINGS, NO_ENDING = "several endings", "no ending"
EMPTY, CYCLE = "empty batch", "cycle"
BREAK = "problem string, token string"


def _only_field(batches: DataFrame, column: str) -> str:
    return batches.schema[column].dataType.fields[0].name


def first_title(batches: DataFrame) -> Column:
    """Title of the first entry of a batch."""
    listing = _only_field(batches, "query")
    entry = F.get(F.col("query")[listing], F.lit(0))
    # Pages are structs with a title; categories are maps.
    kind = batches.schema["query"].dataType.fields[0].dataType.elementType.typeName()
    return F.try_element_at(entry, F.lit("*")) if kind == "map" else entry["title"]


def as_token(title: Column) -> Column:
    """Tokens write blanks of titles as underscores."""
    return F.replace(title.cast("string"), F.lit(" "), F.lit("_"))


def batch_links(batches: DataFrame, begins: Column | None = None) -> DataFrame:
    """(begin, next) of every batch: what it begins with, and the token of the one that follows, or NULL.

    `begins` is a column of `batches` in place of the first entry's title.
    """
    token = F.col("continue")[_only_field(batches, "continue")]
    return batches.select(
        as_token(first_title(batches) if begins is None else begins).alias("begin"), as_token(token).alias("next")
    )


def _cyclic(links: DataFrame, batches: int) -> DataFrame:
    """The beginnings of batches from which no ending is reached, by pointers that reach twice as far each round."""
    pointers, reach = links, 1
    while reach < batches:
        further = pointers.select(F.col("begin").alias("next"), F.col("next").alias("beyond"))
        # An ending has no pointer, and what points to it has none after this round.
        pointers = stage(pointers.join(further, "next", "left").select("begin", F.col("beyond").alias("next")), "pointers")
        reach *= 2
    return pointers.where(F.col("next").isNotNull()).select("begin")


def token_counts(links: DataFrame) -> DataFrame:
    """(token, batches, named, ends, next): how many batches begin with a token and how many name it as the
    next one, how many that begin with it have no token, and the least token of the others.

    One aggregate that is combined before the shuffle; `links` may be a stream. Token NULL stands for
    batches without entries.
    """

    def event(token: str, batches: int, named: int, ends: Column, following: Column) -> Column:
        return F.struct(
            F.col(token).alias("token"), F.lit(batches).alias("batches"), F.lit(named).alias("named"),
            ends.cast("int").alias("ends"), following.cast("string").alias("next"),
        )

    begun = event("begin", 1, 0, F.col("next").isNull(), F.col("next"))
    named = F.when(F.col("next").isNotNull(), event("next", 0, 1, F.lit(0), F.lit(None)))
    events = links.select(F.explode(F.array_compact(F.array(begun, named))).alias("event")).select("event.*")
    sums = [F.sum(c).alias(c) for c in ("batches", "named", "ends")]
    return events.groupBy("token").agg(*sums, F.min("next").alias("next"))


def breaks_of(counts: DataFrame) -> DataFrame:
    """The breaks, as `listing_breaks` gives them, of written `token_counts`."""
    spark = counts.sparkSession
    token = F.col("token").isNotNull()
    start = token & (F.col("named") == 0)
    starts, endings, batches = counts.agg(F.count_if(start), F.sum("ends"), F.sum("batches")).first()

    def problem(rows: DataFrame, name: str) -> DataFrame:
        return rows.select(F.lit(name).alias("problem"), "token")

    found = [
        problem(counts.where(token & (F.col("batches") == 0)), MISSING),
        problem(counts.where(token & (F.col("batches") > 1)), REPEATED),
        problem(counts.where(F.col("named") > 1), FORKED),
        problem(
            counts.where(~token).select("token", F.explode(F.sequence(F.lit(1), F.col("batches").cast("int")))), EMPTY
        ),
    ]
    for n, rows, several, none in ((starts, start, STARTS, NO_START), (endings, F.col("ends") > 0, ENDINGS, NO_ENDING)):
        if not n:
            found.append(spark.createDataFrame([(none, None)], BREAK))
        elif n > 1:
            found.append(problem(counts.where(rows), several))
    breaks = found[0]
    for more in found[1:]:
        breaks = breaks.unionAll(more)
    breaks = stage(breaks, "breaks")
    if breaks.isEmpty():
        links = counts.select(F.col("token").alias("begin"), "next")
        circle = _cyclic(links, batches).agg(F.min("begin").alias("token")).where(F.col("token").isNotNull())
        return problem(circle, CYCLE)
    return breaks


def listing_breaks(batches: DataFrame, begins: Column | None = None) -> DataFrame:
    """(problem, token): every place where the listing is not one chain from a start to an ending.

    A token that no batch begins with is a missing batch; a beginning that several batches have, a token
    that several batches end with, more than one batch that no token names or none, more than one without
    a token or none, and batches without entries are problems as well. If there is none of these, batches
    that only follow each other in a circle are looked for; `token` is then that of one of them. No rows: the
    listing is whole. Only beginnings and tokens are shuffled.
    """
    return breaks_of(stage(token_counts(batch_links(batches, begins)), "tokens"))


def listing_complete(batches: DataFrame, begins: Column | None = None) -> DataFrame:
    """One row: batches seen, batches without a token, and whether all of them are one chain without a break."""
    whole = listing_breaks(batches, begins).isEmpty()
    finals = F.count_if(F.col("continue").isNull())
    return batches.agg(F.count("*").alias("batches"), finals.alias("final_batches"), F.lit(whole).alias("complete"))
