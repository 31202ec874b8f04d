"""Listings, responses and graphs derived from whole given tables."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.constants import (
    ABOUT,
    ALT_LABEL,
    ARTICLE_SITE,
    DISAMBIGUATION_CATEGORIES,
    ENTITY_PREFIX,
    GENRE,
    IN_LANGUAGE,
    INSTANCE_OF,
    IS_PART_OF,
    LABEL,
    NAME,
    PUBLISHER,
    RATING,
    SERIES,
    SUBCLASS_OF,
)
from pagemill.operators import union_all_list
from pagemill.sources import Statement, spread_few_splits, triples_from

BATCH_ROWS = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def page_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages, spread over the cores where they come in few splits."""
    return spread_few_splits(table(spark, sf_dir, "pages"))


def title_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(p_partkey, value): `key; name` lines, some with a tail, blanks or no separator at all."""
    line = F.expr(
        "case when p_size > 45 then p_name else concat(p_partkey, '; ', p_name,"
        " case p_type when 'ECONOMY' then concat('; ', p_brand) when 'SMALL' then '  ' else '' end) end"
    )
    return table(spark, sf_dir, "part").select("p_partkey", line.alias("value"))


def category_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey", "p_type",
        "cast(floor(p_retailprice) as int) as size", "p_size as pages",
        "length(p_name) as files", "length(p_brand) as subcats",
        "concat(p_type, ' ', p_partkey) as title",
    )


def category_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(value): category lines, in both separator forms."""
    return category_rows(spark, sf_dir).selectExpr(
        "concat_ws(case when p_type in ('ECONOMY', 'SMALL') then '; ' else ';' end,"
        " size, pages, files, subcats, title) as value"
    )


def _batches(rows: DataFrame, entry: Column, listing: str, token: str) -> DataFrame:
    """(body): JSON batches of BATCH_ROWS rows; all but the last carry a continuation token."""
    last = rows.agg(F.max("p_partkey")).first()[0]
    batch = F.floor(F.col("p_partkey") / BATCH_ROWS).alias("batch")
    groups = rows.groupBy(batch).agg(
        F.array_sort(F.collect_list(F.struct("p_partkey", entry.alias("entry"))))["entry"].alias("entries")
    )
    following = (F.col("batch") + 1) * BATCH_ROWS
    more = F.when(following <= last, F.struct(following.cast("string").alias(token)))
    query = F.struct(F.col("entries").alias(listing))
    return groups.select(F.to_json(F.struct(more.alias("continue"), query.alias("query"))).alias("body"))


def page_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    entry = F.struct(F.col("p_partkey").alias("pageid"), F.col("p_name").alias("title"))
    return _batches(table(spark, sf_dir, "part"), entry, "allpages", "apcontinue")


def order_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(body): batches of one listing entry per order."""
    rows = table(spark, sf_dir, "orders").selectExpr("o_orderkey as p_partkey", "o_custkey")
    entry = F.struct(F.col("p_partkey").alias("pageid"), F.col("o_custkey").cast("string").alias("title"))
    return _batches(rows, entry, "allpages", "apcontinue")


def category_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    entry = F.struct("size", "pages", "files", "subcats", F.col("title").alias("*"))
    return _batches(category_rows(spark, sf_dir), entry, "allcategories", "accontinue")


def name_sources(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Three overlapping query results (id, idLabel, name, pos); the first repeats and misses names."""

    def source(name: str, key: str, label: str, title: str) -> DataFrame:
        return table(spark, sf_dir, name).selectExpr(
            f"concat('{ENTITY_PREFIX}', 'Q', {key}) as id", f"{label} as idLabel",
            f"cast({title} as string) as name", f"{key} as pos",
        )

    low = "case when o_orderpriority <> '5-LOW' then o_custkey end"
    return [
        source("orders", "o_orderkey", "o_orderpriority", low),
        source("customer", "c_custkey", "c_name", "c_custkey"),
        source("part", "p_partkey", "p_name", "p_partkey"),
    ]


def order_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr("o_orderkey as page_id", "cast(o_custkey as string) as title")


def known_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles of customers of five nations; NULL for all other customers."""
    return table(spark, sf_dir, "customer").selectExpr(
        "case when c_nationkey < 5 then cast(c_custkey as string) end as page_title"
    )


PAGE_LANG = "regexp_extract(html, '<html lang=\"([a-z]+)\"', 1)"
PAGE_TARGET = "regexp_replace(url, '^http://', 'https://')"
PAGE_ORIGIN = "regexp_extract(url, '^(https?://[^/]+)', 1)"


def responses(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """(title, body): a page response per page, an error for pages that are cut off.

    Pages with a query string or a fragment are disambiguation pages, `http:` pages redirects.
    """
    pages = page_table(spark, sf_dir)
    listed, plain = DISAMBIGUATION_CATEGORIES[1], DISAMBIGUATION_CATEGORIES[0]

    def category(name: Column, hidden: bool = False) -> Column:
        parts = [F.lit("sortkey"), F.lit(""), F.lit("*"), name]
        return F.create_map(*parts, *([F.lit("hidden"), F.lit("")] if hidden else []))

    categories = F.array_compact(
        F.array(
            category(F.concat(F.lit("Pages in "), F.expr(PAGE_LANG))),
            category(F.lit("Pages to check"), hidden=True),
            F.when(F.contains("url", F.lit("?")), category(F.lit(listed))),
            F.when(F.contains("url", F.lit("#")), category(F.lit(plain))),
        )
    )
    links = F.transform(
        F.expr("regexp_extract_all(html, '<a href=\"/([^\"]*)\"', 1)"),
        lambda target: F.create_map(F.lit("ns"), F.lit("0"), F.lit("*"), target),
    )
    sections = F.transform(
        F.expr("regexp_extract_all(html, '(?:<h1>|<b>)([^<]*)', 1)"), lambda s: F.struct(s.alias("line"))
    )
    hop = F.struct(F.col("url").alias("from"), F.expr(PAGE_TARGET).alias("to"))
    parse = F.struct(
        F.col("page_id").alias("pageid"),
        F.expr(PAGE_TARGET).alias("title"),
        categories.alias("categories"),
        links.alias("links"),
        F.array(F.expr(PAGE_ORIGIN)).alias("externallinks"),
        sections.alias("sections"),
        F.array_compact(F.array(F.when(F.col("url").startswith("http://"), hop))).alias("redirects"),
        F.create_map(F.lit("*"), F.col("html")).alias("text"),
    )
    failed = F.lit('{"error":{"code":"missingtitle"}}')
    body = F.when(F.col("html").endswith("</html>"), F.to_json(F.struct(parse.alias("parse"))))
    return pages.select(F.col("url").alias("title"), F.coalesce(body, failed).alias("body"), *extra)


def page_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, title, ns, is_redirect): pages with a fragment lie in another namespace."""
    return table(spark, sf_dir, "pages").selectExpr(
        "page_id", "url as title", "case when url like '%#%' then 1 else 0 end as ns",
        "url like 'http://%' as is_redirect",
    )


def game_sources(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Three overlapping query results over pages; each name comes twice, the last has no labels."""
    pages = table(spark, sf_dir, "pages")

    def source(letter: str, condition: str) -> DataFrame:
        return pages.where(condition).selectExpr(
            "explode(array(0, 1)) as copy", "page_id", "url as name", f"{PAGE_TARGET} as idLabel",
        ).selectExpr(
            f"concat('{ENTITY_PREFIX}', '{letter}', copy, '-', page_id) as id", "idLabel", "name",
            "copy", "page_id as pos",
        )

    return [
        source("Q", f"{PAGE_LANG} = 'de'"), source("S", "url like '%.com/%?%'"),
        source("M", f"{PAGE_LANG} = 'es'").drop("idLabel"),
    ]


def page_reply(title: str, html: str) -> str:
    """The reply to a request for a page: its JSON body, or an error for a page that is cut off."""
    if not html.endswith("</html>"):
        raise ValueError("page is cut off")
    names = [DISAMBIGUATION_CATEGORIES[1]] if "?" in title else ["Articles"]
    parse = {
        "pageid": len(html), "title": title, "categories": [{"*": n} for n in names], "links": [],
        "externallinks": [title], "sections": [], "redirects": [], "text": {"*": html},
    }
    return json.dumps({"parse": parse}, ensure_ascii=False)


def triples(spark: SparkSession, sf_dir: str, build: Callable[..., DataFrame] = triples_from) -> DataFrame:
    """Customers as entities, nations and regions as classes (with a cycle), orders as articles."""

    def when(condition: str, value: str) -> Column:
        return F.expr(f"case when {condition} then {value} end")

    customer = table(spark, sf_dir, "customer")
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    nation_node = F.expr("concat('n', c_nationkey)")
    entities = build(customer, F.expr("concat('c', c_custkey)"), [
        Statement(INSTANCE_OF, nation_node),
        Statement(INSTANCE_OF, when("c_acctbal > 9000", "'r1'")),
        Statement(GENRE, when("c_acctbal > 0", "concat('m', c_mktsegment)")),
        Statement(GENRE, when("c_acctbal > 5000", "concat('g', c_nationkey)")),
        Statement(PUBLISHER, when("c_acctbal < 4000", "concat('n', c_nationkey)")),
        Statement(RATING, when("c_acctbal > 7000", "concat('e', c_mktsegment)")),
        Statement(SERIES, when("c_acctbal > 3000", "concat('n', c_nationkey)")),
        Statement(SERIES, when("c_acctbal > 8000", "'r0'")),
        Statement(LABEL, "c_name", F.lit("en")),
        Statement(LABEL, when("c_nationkey < 10", "concat('Client ', c_custkey)"), F.lit("fr")),
        Statement(ALT_LABEL, "c_mktsegment", F.lit("en")),
        Statement(ALT_LABEL, when("c_acctbal > 0", "concat('alias ', c_custkey)"), F.lit("en")),
    ])
    segments = build(
        customer.select("c_mktsegment").distinct(), F.expr("concat('m', c_mktsegment)"),
        [Statement(LABEL, "c_mktsegment", F.lit("en"))],
    )
    nations = build(nation, F.expr("concat('n', n_nationkey)"), [
        Statement(SUBCLASS_OF, F.expr("concat('r', n_regionkey)")),
        Statement(LABEL, when("n_regionkey <> 2", "n_name"), F.lit("en")),
        Statement(LABEL, when("n_regionkey < 2", "concat('Pays ', n_nationkey)"), F.lit("fr")),
    ])
    regions = build(region, F.expr("concat('r', r_regionkey)"), [
        Statement(SUBCLASS_OF, F.lit("root")), Statement(LABEL, "r_name", F.lit("en")),
    ])
    cycle = build(region.where("r_regionkey = 0"), F.lit("root"), [Statement(SUBCLASS_OF, F.lit("r0"))])
    articles = build(table(spark, sf_dir, "orders"), F.expr("concat('a', o_orderkey)"), [
        Statement(ABOUT, F.expr("concat('c', o_custkey)")),
        Statement(IN_LANGUAGE, F.expr("if(o_orderstatus = 'F', 'fr', 'en')")),
        Statement(NAME, F.expr("concat('Order ', o_orderkey)")),
        Statement(
            IS_PART_OF, F.expr(f"if(o_orderpriority = '5-LOW', 'https://other.example/', '{ARTICLE_SITE}')")
        ),
    ])
    return union_all_list([entities, segments, nations, regions, cycle, articles])
