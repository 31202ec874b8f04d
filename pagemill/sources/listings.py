"""Page and category listings: JSON batches and delimited text lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.functions import category_fields, format_line, title_from_line
from pagemill.schemas import CATEGORY_LISTING, PAGE_LISTING

LISTING_SCHEMAS = {"pages": PAGE_LISTING, "categories": CATEGORY_LISTING}


def read_listing_batches(spark: SparkSession, path: str, kind: str = "pages") -> DataFrame:
    """Saved listing batches, one JSON document per line, under a declared schema."""
    return spark.read.schema(LISTING_SCHEMAS[kind]).json(path)


def parse_listing_batches(df: DataFrame, body: str = "body", kind: str = "pages") -> DataFrame:
    """Listing batches held as JSON text in a column."""
    return df.select(F.from_json(body, LISTING_SCHEMAS[kind]).alias("_batch")).select("_batch.*")


def load_page_listing(batches: DataFrame) -> DataFrame:
    """(page_id, title) of every page in the batches."""
    return batches.select(F.explode("query.allpages").alias("_page")).select(
        F.col("_page.pageid").alias("page_id"), F.col("_page.title").alias("title")
    )


def load_category_listing(batches: DataFrame) -> DataFrame:
    """(size, pages, files, subcats, title) of every category in the batches."""

    def field(name: str) -> Column:
        return F.try_element_at("_category", F.lit(name))

    counts = [field(n).try_cast("int").alias(n) for n in ("size", "pages", "files", "subcats")]
    return batches.select(F.explode("query.allcategories").alias("_category")).select(
        *counts, field("*").alias("title")
    )


def read_title_list(lines: DataFrame, column: str = "value", keep_rest: bool = False) -> DataFrame:
    """Titles of `pageid; title` lines; lines without separator give NULL. Other columns stay."""
    others = [c for c in lines.columns if c != column]
    return lines.select(title_from_line(column, keep_rest).alias("title"), *others)


def read_category_list(lines: DataFrame, column: str = "value", keep_rest: bool = False) -> DataFrame:
    """The typed category table of category lines in either separator form."""
    return lines.select(category_fields(column, keep_rest).alias("_fields")).select("_fields.*")


def to_delimited(df: DataFrame, columns: list[str], sep: str = "; ") -> DataFrame:
    """One text column `value` of delimited lines."""
    return df.select(format_line(*columns, sep=sep).alias("value"))


def write_delimited(df: DataFrame, path: str, columns: list[str], sep: str = "; ") -> None:
    to_delimited(df, columns, sep).write.text(path)


def batch_count(batches: DataFrame) -> DataFrame:
    """One row with the number of batches."""
    return batches.agg(F.count("*").alias("batches"))
