"""Text, CSV and Parquet files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill.functions import parse_list_literal, to_list_literal
from pagemill.schemas import LIST_COLUMNS

# Columns that together give the order of lines or rows in a set of files.
FILE_ORDER = ("_file", "_block", "_sequence")


def _with_file_order(df: DataFrame) -> DataFrame:
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_sequence"),
    )


def read_lines(spark: SparkSession, path: str, ordered: bool = False) -> DataFrame:
    """Lines of text files, read as newline-aligned splits of `spark.sql.files.maxPartitionBytes`.

    With `ordered` the columns of FILE_ORDER are added. Sort by them to get the order in the files.
    """
    lines = spark.read.text(path)
    return _with_file_order(lines) if ordered else lines


# No text holds it, so only a field with nothing in it, not even quotes, is NULL.
_NO_NULL = "\u0000"


def read_csv(
    spark: SparkSession, path: str, escape: str = '"', columns: tuple[str, ...] | None = None
) -> DataFrame:
    """CSV with header; every column is text, blanks are kept.

    A quoted field may hold line breaks, so a file is one split: many files give many tasks. An
    empty field is NULL, an empty field in quotes the empty text. With `columns` the header of every
    file has to name them in that order; without, the header decides.
    """
    reader = spark.read.option("header", True).option("escape", escape).option("multiLine", True)
    reader = reader.option("nullValue", _NO_NULL)
    reader = reader.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    if columns is not None:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        reader = reader.schema(schema).option("enforceSchema", False)
    return reader.csv(path)


def read_query_result(
    spark: SparkSession, path: str, ordered: bool = False, columns: tuple[str, ...] | None = None
) -> DataFrame:
    """Columns id, idLabel and name of a saved graph query; `name` is NULL where the query has none.

    `columns` are the query's own, such as QUERY_RESULT_COLUMNS, if the files have to have them.
    """
    rows = read_csv(spark, path, columns=columns)
    if ordered:
        rows = _with_file_order(rows)
    return query_result_columns(rows, *(FILE_ORDER if ordered else ()))


def query_result_columns(rows: DataFrame, *extra: str) -> DataFrame:
    """Select the identifier, label and name of a query result, plus `extra` columns."""
    wanted = ["id", "idLabel", "name"]
    present = [
        F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in wanted
    ]
    return rows.select(*present, *extra)


def read_page_csv(
    spark: SparkSession, path: str, escape: str = '"', list_columns: tuple[str, ...] = ()
) -> DataFrame:
    """A page table saved as CSV; `list_columns` are turned back from list literals into arrays."""
    return parse_list_columns(read_csv(spark, path, escape), list_columns)


def parse_list_columns(df: DataFrame, columns: tuple[str, ...] = LIST_COLUMNS) -> DataFrame:
    """Replace list-literal text by arrays, in place."""
    return df.withColumns({c: parse_list_literal(c) for c in columns})


def lists_to_literals(df: DataFrame) -> DataFrame:
    """Replace every array-of-text column by list-literal text."""
    lists = [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]
    return df.withColumns({c: to_list_literal(c) for c in lists})


def write_csv_with_lists(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with header and `"` as escape; arrays become list literals, blanks are kept.

    Line breaks stay in quoted fields; NULL is an empty field, the empty text one in quotes.
    """
    writer = lists_to_literals(df).write.mode(mode).option("header", True).option("escape", '"')
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.csv(path)


def write_table(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Parquet; an existing path is an error unless `mode` says otherwise."""
    df.write.mode(mode).parquet(path)


def records_to_table(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of `schema`, matched by name and cast to its types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def list_files(spark: SparkSession, path: str, suffix: str = ".jpg") -> DataFrame:
    """(path, length) of the files below `path` whose name ends with `suffix`; contents stay unread."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    return files.option("pathGlobFilter", f"*{suffix}").load(path).select("path", "length")
