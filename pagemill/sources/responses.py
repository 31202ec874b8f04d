"""Saved page responses: one JSON body per requested title."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.schemas import PARSE_RESPONSE


def load_parse_responses(df: DataFrame, body: str = "body") -> DataFrame:
    """Replace the JSON body by a `parse` struct, NULL for failed or broken responses."""
    others = [c for c in df.columns if c != body]
    return df.select(*others, F.from_json(body, PARSE_RESPONSE)["parse"].alias("parse"))


def load_parsed_pages(df: DataFrame, body: str = "body") -> DataFrame:
    """The responses that hold a page, with their `parse` struct.

    The body is decoded in a generator that yields no row for a failed response. A filter on the
    struct would be pushed below the projection and decode every body a second time.
    """
    others = [c for c in df.columns if c != body]
    parse = F.from_json(body, PARSE_RESPONSE)["parse"]
    return df.select(*others, F.explode(F.array_compact(F.array(parse))).alias("parse"))
