"""Arrow UDF for paragraph text, built on the standard tag parser."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from pagemill.constants import PARAGRAPH_BREAKERS


class _Paragraphs(HTMLParser):
    """Collects the text of `p` elements; any block-level tag closes the open one."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.found: list[list[str]] = []
        self.open = False

    def handle_starttag(self, tag, attrs):
        if tag in PARAGRAPH_BREAKERS:
            self.open = tag == "p"
            if self.open:
                self.found.append([])

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag in PARAGRAPH_BREAKERS:
            self.open = False

    def handle_data(self, data):
        if self.open:
            self.found[-1].append(data)


def text_of_paragraphs(html: str | None) -> str | None:
    if html is None:
        return None
    parser = _Paragraphs()
    parser.feed(html)
    parser.close()
    return "".join(" " + "".join(parts) for parts in parser.found).replace("\n", ".")


@F.pandas_udf(StringType())
def paragraph_text_udf(html: pd.Series) -> pd.Series:
    return html.map(text_of_paragraphs)
