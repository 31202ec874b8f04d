"""Column functions over listing lines, list literals and identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagemill.constants import CATEGORY_SEPARATOR, ENTITY_PREFIX, TITLE_SEPARATOR

ColumnLike = Column | str


def as_column(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def strip_blanks(text: ColumnLike) -> Column:
    """Remove Unicode white space at both ends."""
    return F.regexp_replace(as_column(text), r"^(?U)\s+|(?U)\s+$", "")


def title_from_line(line: ColumnLike, keep_rest: bool = False) -> Column:
    """Title of a `pageid; title` line, NULL when the line has no separator.

    A second separator cuts the title unless `keep_rest` is set.
    """
    fields = F.split(as_column(line), TITLE_SEPARATOR, 2 if keep_rest else -1)
    return strip_blanks(F.get(fields, F.lit(1)))


def category_fields(line: ColumnLike, keep_rest: bool = False) -> Column:
    """Struct (category, size, num_pages, num_subcat, num_files) of a category line.

    Lines hold size, pages, files, subcategories, title; counts that are not numbers become NULL.
    """
    fields = F.split(as_column(line), CATEGORY_SEPARATOR, 5 if keep_rest else -1)

    def count(position: int) -> Column:
        return strip_blanks(F.get(fields, F.lit(position))).try_cast("int")

    return F.struct(
        strip_blanks(F.get(fields, F.lit(4))).alias("category"),
        count(0).alias("size"),
        count(1).alias("num_pages"),
        count(3).alias("num_subcat"),
        count(2).alias("num_files"),
    )


def format_line(*columns: ColumnLike, sep: str = TITLE_SEPARATOR) -> Column:
    """Join the values into one delimited line. NULLs are written as empty fields."""
    return F.concat_ws(sep, *[F.coalesce(as_column(c).cast("string"), F.lit("")) for c in columns])


def parse_list_literal(text: ColumnLike) -> Column:
    """Array from list-literal text such as `['a', 'b']`.

    Drops the outer brackets and every single quote, then splits on comma and blank. It keeps the
    known losses of that encoding: `[]` gives one empty string and commas inside items split them.
    """
    return F.split(F.regexp_replace(as_column(text), r"(^\[)|(\]$)|(')", ""), ", ")


def _quoted(item: Column) -> Column:
    escaped = F.replace(item, F.lit("\\"), F.lit("\\\\"))
    for char, code in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        escaped = F.replace(escaped, F.lit(char), F.lit(code))
    double = F.contains(item, F.lit("'")) & ~F.contains(item, F.lit('"'))
    single = F.concat(F.lit("'"), F.replace(escaped, F.lit("'"), F.lit("\\'")), F.lit("'"))
    return F.when(double, F.concat(F.lit('"'), escaped, F.lit('"'))).otherwise(single)


def to_list_literal(items: ColumnLike) -> Column:
    """List-literal text of an array, with the quoting rules of Python's `repr`."""
    quoted = F.transform(as_column(items), lambda item: F.coalesce(_quoted(item), F.lit("None")))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def newline_to_dot(text: ColumnLike) -> Column:
    return F.replace(as_column(text), F.lit("\n"), F.lit("."))


def strip_entity_prefix(identifier: ColumnLike, prefix: str = ENTITY_PREFIX) -> Column:
    """Remove the entity namespace wherever it occurs in the identifier."""
    return F.replace(as_column(identifier), F.lit(prefix), F.lit(""))


def content_length(body: ColumnLike) -> Column:
    """Number of characters of a body."""
    return F.length(as_column(body)).cast("bigint")


def cast_int(text: ColumnLike) -> Column:
    """Integer value of text with optional blanks around it, NULL when it is not a number."""
    return strip_blanks(text).try_cast("int")


def cast_string(value: ColumnLike) -> Column:
    return as_column(value).cast("string")


def square(value: ColumnLike) -> Column:
    return as_column(value) * as_column(value)
