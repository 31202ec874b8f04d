"""Filters and column selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemill import functions as fn
from pagemill import operators as op
from pagemill import sources as src
from pagemill.registry import fixtures as fx
from pagemill.registry.base import joined_lists, query
from pagemill.schemas import CATEGORY_TABLE


@query("select_columns", "SELECT c_custkey, c_name FROM customer")
def _(spark, sf_dir):
    return op.select_columns(fx.table(spark, sf_dir, "customer"), ["c_custkey", "c_name"])


@query("drop_columns", "SELECT c_custkey, c_name, c_nationkey FROM customer")
def _(spark, sf_dir):
    return op.drop_columns(fx.table(spark, sf_dir, "customer"), ["c_acctbal", "c_mktsegment"])


@query(
    "records_to_table",
    "SELECT c_name AS category, CAST(c_custkey AS INTEGER) AS size, c_nationkey AS num_pages,"
    " CAST(NULL AS INTEGER) AS num_subcat, CAST(7 AS INTEGER) AS num_files FROM customer",
)
def _(spark, sf_dir):
    records = fx.table(spark, sf_dir, "customer").selectExpr(
        "c_custkey as size", "cast(c_nationkey as string) as num_pages", "'7' as num_files",
        "cast(null as string) as num_subcat", "c_name as category",
    )
    return src.records_to_table(records, CATEGORY_TABLE)


@query("suffix_filter", "SELECT page_id, url FROM pages WHERE url LIKE '%#top'")
def _(spark, sf_dir):
    return op.suffix_filter(fx.table(spark, sf_dir, "pages").select("page_id", "url"), "url", "#top")


@query(
    "namespace_nonredirect_filter",
    "SELECT page_id, url AS title FROM pages WHERE url NOT LIKE '%#%' AND url NOT LIKE 'http://%'",
)
def _(spark, sf_dir):
    return op.main_pages(fx.page_listing(spark, sf_dir)).select("page_id", "title")


@query("title_not_null", "SELECT CAST(c_custkey AS VARCHAR) AS page_title FROM customer WHERE c_nationkey < 5")
def _(spark, sf_dir):
    return op.title_not_null(fx.known_titles(spark, sf_dir))


CATEGORIES = (
    "CASE WHEN c_nationkey = 0 THEN NULL WHEN c_nationkey = 1 THEN [] WHEN c_nationkey = 2 THEN ['a', NULL]"
    " WHEN c_nationkey = 3 THEN [NULL, 'Disambiguation pages'] WHEN c_nationkey = 4 THEN ['Disambiguation_pages']"
    " WHEN c_nationkey = 5 THEN ['disambiguation pages'] ELSE [c_mktsegment] END"
)


@query(
    "drop_disambiguation",
    f"SELECT c_custkey, list_count(category) AS n_named FROM (SELECT c_custkey, {CATEGORIES} AS category"
    " FROM customer) WHERE category IS NOT NULL AND len(category) = list_count(category)"
    " AND NOT list_contains(category, 'Disambiguation pages')"
    " AND NOT list_contains(category, 'Disambiguation_pages')",
)
def _(spark, sf_dir):
    category = F.expr(CATEGORIES.replace("[]", "cast(array() as array<string>)").replace("[", "array(").replace("]", ")"))
    pages = fx.table(spark, sf_dir, "customer").select("c_custkey", category.alias("category"))
    kept = op.drop_disambiguation(pages)
    return kept.select("c_custkey", F.size(F.array_compact("category")).cast("bigint").alias("n_named"))


@query(
    "rename_to_page_schema",
    "SELECT CAST(c_custkey AS VARCHAR) AS page_id, c_name AS page_title, c_mktsegment AS page_text,"
    " c_mktsegment AS category, c_name AS links, c_name AS external_links, 'x' AS sections,"
    " CASE WHEN c_nationkey < 5 THEN c_name END AS redirects_page FROM customer",
)
def _(spark, sf_dir):
    records = fx.table(spark, sf_dir, "customer").selectExpr(
        "array(c_mktsegment) as categories", "cast(c_custkey as string) as page_id", "c_name as page_title",
        "array(c_name) as links", "array(c_name) as external_links", "array('x') as sections",
        "case when c_nationkey < 5 then c_name end as redirects", "c_mktsegment as page_text",
    )
    return joined_lists(op.to_page_table(records), "category", "links", "external_links", "sections")


REDIRECTED = (
    "SELECT page_id, url AS page_title, CASE WHEN url LIKE 'http://%' THEN"
    " regexp_replace(url, '^http://', 'https://') END AS redirects_page FROM pages"
)


def _redirected(spark, sf_dir):
    return fx.table(spark, sf_dir, "pages").selectExpr(
        "page_id", "url as page_title",
        f"case when url like 'http://%' then {fx.PAGE_TARGET} end as redirects_page",
    )


@query(
    "split_redirects",
    f"SELECT redirects_page IS NOT NULL AS redirected, count(*) AS n_pages FROM ({REDIRECTED}) GROUP BY 1",
)
def _(spark, sf_dir):
    direct, redirected = op.split_redirects(_redirected(spark, sf_dir))
    flagged = op.union_all_list(
        [df.select(F.lit(flag).alias("redirected")) for df, flag in ((direct, False), (redirected, True))]
    )
    return flagged.groupBy("redirected").agg(F.count("*").alias("n_pages"))


@query(
    "resolve_redirect_title",
    f"SELECT page_id, coalesce(redirects_page, page_title) AS page_title, redirects_page FROM ({REDIRECTED})",
)
def _(spark, sf_dir):
    return op.resolve_redirect_title(_redirected(spark, sf_dir))


@query("newline_to_dot", "SELECT doc_id, replace(text, chr(10), '.') AS text FROM documents")
def _(spark, sf_dir):
    return fx.table(spark, sf_dir, "documents").select("doc_id", fn.newline_to_dot("text").alias("text"))


@query("content_length", "SELECT page_id, length(html) AS length FROM pages")
def _(spark, sf_dir):
    return fx.table(spark, sf_dir, "pages").select("page_id", fn.content_length("html").alias("length"))
