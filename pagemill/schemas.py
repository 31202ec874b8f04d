"""Declared schemas of everything that is read from or written to storage."""

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


def _lists(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.ArrayType(T.StringType())) for name in names]


LIST_COLUMNS = ("category", "links", "external_links", "sections")

PAGE_TABLE = T.StructType(
    _strings("page_id", "page_title", "page_text") + _lists(*LIST_COLUMNS) + _strings("redirects_page")
)
GAME_PAGE_TABLE = T.StructType(PAGE_TABLE.fields + _strings("wikidata_id"))
SAMPLE_PAGE_TABLE = T.StructType(
    [f for f in PAGE_TABLE.fields if f.name not in ("page_id", "redirects_page")]
)
CATEGORY_TABLE = T.StructType(
    _strings("category")
    + [T.StructField(n, T.IntegerType()) for n in ("size", "num_pages", "num_subcat", "num_files")]
)
QUERY_RESULT = T.StructType(
    _strings("id", "idLabel", "genreLabel", "publisherLabel", "esrbLabel", "idAltLabel", "name", "article")
)
TRIPLES = T.StructType(_strings("s", "p", "o", "lang"))
RESPONSES = T.StructType(_strings("title", "body"))

# `categories` and `links` stay maps: the test on a category is whether a key is present at all.
PARSE_RESPONSE = (
    "parse struct<pageid:string,title:string,"
    "categories:array<map<string,string>>,links:array<map<string,string>>,"
    "externallinks:array<string>,sections:array<struct<line:string>>,"
    "redirects:array<struct<`from`:string,`to`:string>>,text:map<string,string>>"
)
PAGE_LISTING = (
    "`continue` struct<apcontinue:string>, "
    "query struct<allpages:array<struct<pageid:bigint,title:string>>>"
)
CATEGORY_LISTING = (
    "`continue` struct<accontinue:string>, query struct<allcategories:array<map<string,string>>>"
)

# Columns of a saved games or series query, all text; the mapping query has no name.
QUERY_RESULT_COLUMNS = (
    "id", "idLabel", "genreLabel", "publisherLabel", "esrbLabel", "idAltLabel", "name", "article",
)
MAPPING_RESULT_COLUMNS = tuple(c for c in QUERY_RESULT_COLUMNS if c != "name")
