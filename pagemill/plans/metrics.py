"""Counts of a run, taken by the job that does the work."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from pagemill.plans.extract import extract_pages


class PageMetrics:
    """Counts of a page table, known once the first action on it has ended; `get` waits for that.

    A task that is computed again after its executor was lost may be counted again; the table is not
    affected.
    """

    def __init__(self) -> None:
        self.asked, self.made = Observation(), Observation()

    def get(self) -> dict[str, int]:
        """`responses`; `no_body`, those without one; `pages` made; `dropped`, all that gave no page
        (failed, broken or disambiguation); `no_text`, pages without text; `chars`, code points of text."""
        found = {name: value or 0 for name, value in {**self.asked.get, **self.made.get}.items()}
        return found | {"dropped": found["responses"] - found["pages"]}


def metered_pages(responses: DataFrame, *extra: str, **options) -> tuple[DataFrame, PageMetrics]:
    """`extract_pages`, and its counts. No other job and no second reading is needed for them."""
    metrics = PageMetrics()
    asked = responses.observe(
        metrics.asked, F.count(F.lit(1)).alias("responses"), F.count_if(F.col("body").isNull()).alias("no_body")
    )
    pages = extract_pages(asked, *extra, **options)
    length = F.length("page_text")
    counts = [
        F.count(F.lit(1)).alias("pages"),
        F.count_if(F.coalesce(length, F.lit(0)) == 0).alias("no_text"),
        F.sum(length).alias("chars"),
    ]
    return pages.observe(metrics.made, *counts), metrics
