"""The category table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill import functions as fn
from pagemill.schemas import CATEGORY_TABLE
from pagemill.sources import load_category_listing, records_to_table


def build_category_table(batches: DataFrame) -> DataFrame:
    """(category, size, num_pages, num_subcat, num_files) of all categories in the batches."""
    listed = load_category_listing(batches).select(
        fn.strip_blanks("title").alias("category"),
        "size",
        F.col("pages").alias("num_pages"),
        F.col("subcats").alias("num_subcat"),
        F.col("files").alias("num_files"),
    )
    return records_to_table(listed, CATEGORY_TABLE)
