"""Joins on titles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.operators.dedup import dedup_keep_first
from pagemill.operators.skew import HOT_ROWS, lookup_join
from pagemill.sources.storage import BROADCAST_BYTES


def exclude_known_titles(
    titles: DataFrame,
    known: DataFrame,
    on: str = "title",
    known_on: str | None = None,
    limit: int = BROADCAST_BYTES,
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """Rows whose title is not among the known ones.

    Repeated titles stay repeated, NULL titles stay, and a NULL among the known removes nothing.
    """
    names = known.select(F.col(known_on or on).alias(on)).where(F.col(on).isNotNull()).distinct()
    return lookup_join(titles, names, on, "left_anti", limit, min_rows)


def attach_entity_id(
    pages: DataFrame,
    entities: DataFrame,
    order: list[str],
    title: str = "page_title",
    limit: int = BROADCAST_BYTES,
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add `wikidata_id`: the id of the first entity, by `order`, whose name is the page's title."""
    first = dedup_keep_first(entities.where(F.col("name").isNotNull()), "name", order)
    lookup = first.select(F.col("name").alias(title), F.col("id").alias("wikidata_id"))
    return lookup_join(pages, lookup, title, "left", limit, min_rows)
