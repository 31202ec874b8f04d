"""Row filters and column selection on page tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.constants import DISAMBIGUATION_CATEGORIES


def select_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*columns)


def drop_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.drop(*columns)


def parse_ok(responses: DataFrame) -> DataFrame:
    """Responses that hold a page.

    A generator yields no row for a failed response. A filter on the struct would be pushed below the
    projection that decodes it, and would decode every body a second time.
    """
    others = [c for c in responses.columns if c != "parse"]
    found = responses.select(*others, F.explode(F.array_compact(F.array("parse"))).alias("parse"))
    return found.select(*responses.columns)


def title_not_null(pages: DataFrame, title: str = "page_title") -> DataFrame:
    return pages.where(F.col(title).isNotNull())


def split_redirects(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pages reached directly, pages reached through a redirect)."""
    redirected = F.col("redirects_page").isNotNull()
    return pages.where(~redirected), pages.where(redirected)


def resolve_redirect_title(pages: DataFrame) -> DataFrame:
    """Redirected pages take the title of the redirect's target."""
    return pages.withColumn("page_title", F.coalesce("redirects_page", "page_title"))


def drop_disambiguation(
    df: DataFrame,
    category: Column | str = "category",
    names: tuple[str, ...] = DISAMBIGUATION_CATEGORIES,
) -> DataFrame:
    """Remove pages in one of the named categories, and pages for which that is unknown.

    An empty list keeps the page; a NULL list, or an unmatched list with a NULL item, drops it.
    """
    for name in names:
        df = df.where(~F.array_contains(category, name))
    return df


def main_pages(
    listing: DataFrame, ns: int = 0, redirects: bool = False, ns_column: str = "ns",
    redirect_column: str = "is_redirect",
) -> DataFrame:
    """Pages of one namespace that are (not) redirects."""
    wanted = F.col(redirect_column) if redirects else ~F.col(redirect_column)
    return listing.where((F.col(ns_column) == ns) & wanted)


def suffix_filter(df: DataFrame, column: str, suffix: str = ".jpg") -> DataFrame:
    return df.where(F.col(column).endswith(suffix))


def to_page_table(records: DataFrame, variant: str = "pages") -> DataFrame:
    """Rename extracted fields to the page table's names and put them in its order.

    `variant` is "pages", "games" (with `wikidata_id`) or "sample" (without id and redirect).
    """
    names = {"categories": "category", "redirects": "redirects_page"}
    renamed = records.withColumnsRenamed(names)
    columns = ["page_title", "page_text", "category", "links", "external_links", "sections"]
    if variant != "sample":
        columns = ["page_id", *columns, "redirects_page"]
    if variant == "games":
        columns.append("wikidata_id")
    return renamed.select(*columns)
