"""Page records from parsed responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill import functions as fn
from pagemill.operators import drop_disambiguation
from pagemill.sources import load_parse_responses, load_parsed_pages


def _fields(title: str, engine: str, names: tuple[str, str] = ("category", "redirects_page")) -> list[Column]:
    category, redirect = names
    return [
        fn.page_id("parse").alias("page_id"),
        fn.page_title("title", "parse", title).alias("page_title"),
        fn.response_text("parse", engine).alias("page_text"),
        fn.visible_categories("parse.categories").alias(category),
        fn.link_titles("parse.links").alias("links"),
        fn.external_links("parse").alias("external_links"),
        fn.section_names("parse.sections").alias("sections"),
        fn.first_redirect_target("parse.redirects").alias(redirect),
    ]


def extract_pages(
    responses: DataFrame,
    *extra: str,
    title: str = "requested",
    engine: str = "native",
    without_disambiguation: bool = False,
) -> DataFrame:
    """The page table of (title, body) responses; failed responses give no row.

    `extra` names further columns of `responses` to keep. Disambiguation pages are dropped on the
    category list alone, before any page text is computed.
    """
    pages = load_parsed_pages(responses)
    if without_disambiguation:
        pages = drop_disambiguation(pages, fn.visible_categories("parse.categories"))
    return pages.select(*_fields(title, engine), *extra)


def extract_page_info(responses: DataFrame, engine: str = "native") -> DataFrame:
    """One record per response with the resolved title; a failed response gives a row of NULLs."""
    parsed = load_parse_responses(responses)
    # One array element per response, so that the body is decoded once for all fields.
    once = parsed.select("title", F.explode(F.array("parse")).alias("parse"))
    return once.select(*_fields("resolved", engine, ("categories", "redirects")))
