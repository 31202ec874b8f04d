"""Paragraph text of HTML as built-in expressions, with a parser-based variant for hard markup."""

from __future__ import annotations

import json
from html.entities import html5, name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagemill.constants import PARAGRAPH_BREAKERS
from pagemill.functions.text import ColumnLike, as_column, newline_to_dot

# Script and style content is plain text: its markup characters are written as references, which are
# decoded once at the end like all others.
_WRITTEN = {"&": "&amp;", "<": "&lt;"}
# A tag without meaning. It keeps apart the texts on both sides of what stood between them.
_GAP = "<!>"

# What follows the name of a tag, as its tokeniser goes: blanks and slashes; names; values in quotes, which
# begin behind `=` only and may hold `>`; values without. Every step is possessive, so a tag is read once.
_VALUE = r"(?:\"[^\"]*+(?:\"|\z)|'[^']*+(?:'|\z)|[^\s>]*+)"
_NAME = r"(?:=[^\s/>=]*+|[^\s/>=]++)"
_ATTRIBUTES = rf"(?:[\s/](?:[\s/]++|{_NAME}(?:\s*+=\s*+{_VALUE})?+)*+)?+"
# Attributes outside of groups, so that `$1$2...` leaves them out. Comments and raw content stay as they are.
WITH_ATTRIBUTES = (
    r"(?is)(<!--.*?(?:-->|\z))"
    rf"|(<script){_ATTRIBUTES}(>.*?(?:</script\s*>|\z)|\z)"
    rf"|(<style){_ATTRIBUTES}(>.*?(?:</style\s*>|\z)|\z)"
    rf"|(</?[a-z][^\s/>]*+){_ATTRIBUTES}(>|\z)"
)
# The patterns start with one fixed character, which the matcher looks for before anything else.
RAW_CONTENT = (
    r"(?is)<(?:script(?:>|\z).*?(?:</script\s*>|\z)"
    r"|style(?:>|\z).*?(?:</style\s*>|\z)"
    r"|!--.*?(?:-->|\z))"
)
RAW_TAGS = r"(?is)^<(?:script|style)(?:>|\z)|</(?:script|style)\s*>$"
PARAGRAPH_START = r"(?i)<p(?:[\s/][^>]*)?(?:>|\z)"
PARAGRAPH_END = r"(?is)</?(?:" + "|".join(PARAGRAPH_BREAKERS) + r")(?:[\s/][^>]*)?(?:>|\z).*\z"
TAG = r"(?s)<(?:/?[A-Za-z]|[!?])[^>]*(?:>|\z)"
REFERENCE = r"^(#[0-9]+|#[xX][0-9A-Fa-f]+|[A-Za-z][A-Za-z0-9]{1,30}(?=;))"

# Names that need no semicolon, by the rule of the standard table: those it lists without one as well.
OPEN_NAMES = {name: value for name, value in html5.items() if not name.endswith(";")}
# Those, the HTML 4 names and the XML apostrophe.
NAMED_CHARACTERS = {name: chr(code) for name, code in name2codepoint.items()} | {"apos": "'"} | OPEN_NAMES
# The longest of these names that a text begins with.
OPEN_NAME = "^(" + "|".join(sorted(OPEN_NAMES, key=lambda name: (-len(name), name))) + ")"


def _character(code: Column) -> Column:
    """Character of a code point, NULL when the number is not a character."""
    valid = ((code > 0) & (code < 0xD800)) | ((code > 0xDFFF) & (code <= 0x10FFFF))
    return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))


def decode_entities(text: ColumnLike) -> Column:
    """Replace named (HTML 4), decimal and hexadecimal character references, each exactly once.

    Numbers and the names of OPEN_NAMES need no semicolon: of an unknown name the longest of these that it
    begins with counts. Other names without semicolon, unknown names and invalid numbers stay as they are.
    """
    # One constant, which is folded into a map literal once per query.
    names = F.from_json(F.lit(json.dumps(NAMED_CHARACTERS)), "map<string,string>")
    pieces = F.transform(
        F.split(as_column(text), "&"),
        lambda piece: F.struct(
            piece.alias("piece"),
            F.regexp_extract(piece, REFERENCE, 1).alias("reference"),
            F.regexp_extract(piece, OPEN_NAME, 1).alias("open"),
        ),
    )

    def significant(reference: Column, start: int) -> Column:
        """Digits without leading zeros. Numbers of more than eight are no characters."""
        digits = F.ltrim(F.substr(reference, F.lit(start)), F.lit("0"))
        return F.when(F.length(digits) <= 8, F.when(digits == "", "0").otherwise(digits))

    def value(reference: Column) -> Column:
        hexadecimal = F.conv(significant(reference, 3), 16, 10).try_cast("bigint")
        decimal = significant(reference, 2).try_cast("bigint")
        return (
            F.when(reference.rlike("^#[xX]"), _character(hexadecimal))
            .when(reference.startswith("#"), _character(decimal))
            .otherwise(F.try_element_at(names, reference))
        )

    def behind(piece: Column, reference: Column) -> Column:
        """What follows a reference and its semicolon."""
        rest = F.substr(piece, F.length(reference) + F.lit(1))
        return F.when(rest.startswith(";"), F.substr(rest, F.lit(2))).otherwise(rest)

    def decoded(tail: Column) -> Column:
        return F.coalesce(
            F.concat(value(tail["reference"]), behind(tail["piece"], tail["reference"])),
            F.concat(F.try_element_at(names, tail["open"]), behind(tail["piece"], tail["open"])),
            F.concat(F.lit("&"), tail["piece"]),
        )

    # The first piece stands before any `&`.
    whole = F.transform(pieces, lambda p, i: F.when(i == 0, p["piece"]).otherwise(decoded(p)))
    return F.array_join(whole, "")


def _exchanged(text: Column, pairs: dict[str, str]) -> Column:
    for old, new in pairs.items():
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def without_attributes(html: ColumnLike) -> Column:
    """Markup whose tags have no attributes, so that each ends at its first `>`."""
    return F.regexp_replace(as_column(html), WITH_ATTRIBUTES, "$1$2$3$4$5$6$7")


def hold_raw_content(html: ColumnLike) -> Column:
    """Drop comments and turn script and style elements into text that holds no markup.

    Tags of script and style have no attributes here.
    """
    html = as_column(html)
    between = F.split(html, RAW_CONTENT)
    raw = F.regexp_extract_all(html, F.lit(RAW_CONTENT), F.lit(0))
    held = F.zip_with(
        between,
        raw,
        lambda text, element: F.concat(
            text,
            F.when(element.isNull(), F.lit(""))
            .when(element.startswith("<!--"), F.lit(_GAP))
            .otherwise(
                F.concat(
                    F.lit(_GAP), _exchanged(F.regexp_replace(element, RAW_TAGS, ""), _WRITTEN), F.lit(_GAP)
                )
            ),
        ),
    )
    return F.array_join(held, "")


def strip_tags(text: ColumnLike) -> Column:
    return F.regexp_replace(as_column(text), TAG, "")


def paragraph_text(html: ColumnLike, engine: str = "native") -> Column:
    """Text of all paragraphs in document order, each after one blank, newlines as dots.

    A paragraph ends at the next block-level tag, so unclosed paragraphs do not run together.
    `engine="native"` stays in the JVM; `engine="parser"` uses an Arrow UDF over a tag parser, which
    also follows elements nested in a paragraph.
    """
    if engine == "parser":
        from pagemill.functions.html_parser import paragraph_text_udf

        return paragraph_text_udf(as_column(html))
    if engine != "native":
        raise ValueError(f"unknown engine: {engine}")
    # Every step uses the one before it once: a repeated input would be computed again.
    pieces = F.split(hold_raw_content(without_attributes(html)), PARAGRAPH_START)
    # Texts between tags are decoded one by one, so that no reference reaches across a tag.
    texts = F.flatten(
        F.transform(
            pieces,
            lambda piece, i: F.when(i == 0, F.array().cast("array<string>")).otherwise(
                F.split(F.concat(F.lit(" "), F.regexp_replace(piece, PARAGRAPH_END, "")), TAG)
            ),
        )
    )
    decoded = F.transform(texts, lambda t: F.when(t.contains("&"), decode_entities(t)).otherwise(t))
    return newline_to_dot(F.array_join(decoded, ""))
