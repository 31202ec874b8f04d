"""Column functions over the `parse` struct of a page response. Missing keys give NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagemill.functions.html import paragraph_text
from pagemill.functions.text import ColumnLike, as_column


def _label(entry: Column) -> Column:
    return F.try_element_at(entry, F.lit("*"))


def visible_categories(categories: ColumnLike) -> Column:
    """Names of the categories that have no `hidden` key, whatever its value."""
    shown = F.filter(as_column(categories), lambda c: ~F.map_contains_key(c, "hidden"))
    return F.transform(shown, _label)


def link_titles(links: ColumnLike) -> Column:
    return F.transform(as_column(links), _label)


def external_links(parse: ColumnLike) -> Column:
    return as_column(parse)["externallinks"]


def section_names(sections: ColumnLike) -> Column:
    return as_column(sections)["line"]


def first_redirect_target(redirects: ColumnLike) -> Column:
    return F.get(as_column(redirects), F.lit(0))["to"]


def page_id(parse: ColumnLike) -> Column:
    return as_column(parse)["pageid"].cast("string")


def page_title(requested: ColumnLike, parse: ColumnLike, title: str = "requested") -> Column:
    """The title that was asked for, or with `title="resolved"` the one the response carries."""
    if title == "requested":
        return as_column(requested)
    if title == "resolved":
        return as_column(parse)["title"]
    raise ValueError(f"unknown title choice: {title}")


def response_text(parse: ColumnLike, engine: str = "native") -> Column:
    return paragraph_text(_label(as_column(parse)["text"]), engine)
