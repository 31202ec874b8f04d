"""Deduplication, joins on titles and unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemill import functions as fn
from pagemill import operators as op
from pagemill.constants import ENTITY_PREFIX
from pagemill.plans import game_names
from pagemill.registry import fixtures as fx
from pagemill.registry.base import query

PREFIX = f"'{ENTITY_PREFIX}Q'"
SOURCES = f"""
    SELECT 0 AS source_rank, {PREFIX} || o_orderkey AS id, o_orderpriority AS idLabel,
        CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_custkey AS VARCHAR) END AS name, o_orderkey AS pos
    FROM orders
    UNION ALL SELECT 1, {PREFIX} || c_custkey, c_name, CAST(c_custkey AS VARCHAR), c_custkey FROM customer
    UNION ALL SELECT 2, {PREFIX} || p_partkey, p_name, CAST(p_partkey AS VARCHAR), p_partkey FROM part"""
FIRST = f"""
    SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY name ORDER BY source_rank, pos) AS nth FROM ({SOURCES})
    ) WHERE nth = 1"""
KNOWN = "SELECT CASE WHEN c_nationkey < 5 THEN CAST(c_custkey AS VARCHAR) END AS page_title FROM customer"


@query("count_rows", "SELECT count(*) AS n_rows FROM lineitem")
def _(spark, sf_dir):
    return op.count_rows(fx.table(spark, sf_dir, "lineitem"))


@query("append_by_name", SOURCES)
def _(spark, sf_dir):
    return op.append_by_name(fx.name_sources(spark, sf_dir))


@query(
    "union_all_list",
    "SELECT CAST(o_orderkey AS BIGINT) AS key, o_orderpriority AS label FROM orders"
    " UNION ALL SELECT c_custkey, c_name FROM customer UNION ALL SELECT p_partkey, p_name FROM part"
    " UNION ALL SELECT p_partkey, p_name FROM part",
)
def _(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders").selectExpr("o_orderkey as key", "o_orderpriority as label")
    customers = fx.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    parts = fx.table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return op.union_all_list([orders, customers, parts, parts])


@query("dedup_keep_first", f"SELECT source_rank, id, idLabel, name, pos FROM ({FIRST})")
def _(spark, sf_dir):
    rows = op.append_by_name(fx.name_sources(spark, sf_dir))
    return op.dedup_keep_first(rows, "name", ["source_rank", "pos"])


@query("dedup_any", f"SELECT DISTINCT page_title FROM ({KNOWN})")
def _(spark, sf_dir):
    return op.dedup_any(fx.known_titles(spark, sf_dir), "page_title")


@query(
    "game_names",
    f"SELECT replace(id, '{ENTITY_PREFIX}', '') AS id, idLabel, name FROM ({FIRST})"
    " WHERE name IS NOT NULL",
)
def _(spark, sf_dir):
    return game_names(fx.name_sources(spark, sf_dir), ["pos"])


@query(
    "strip_entity_prefix",
    f"SELECT replace(id, '{ENTITY_PREFIX}', '') AS id, pos FROM ({SOURCES})",
)
def _(spark, sf_dir):
    rows = op.append_by_name(fx.name_sources(spark, sf_dir))
    return rows.select(fn.strip_entity_prefix("id").alias("id"), "pos")


@query(
    "exclude_known_titles",
    "SELECT o_orderkey AS page_id, CAST(o_custkey AS VARCHAR) AS title FROM orders"
    f" WHERE NOT EXISTS (SELECT 1 FROM ({KNOWN}) k WHERE k.page_title = CAST(o_custkey AS VARCHAR))",
)
def _(spark, sf_dir):
    return op.exclude_known_titles(
        fx.order_titles(spark, sf_dir), fx.known_titles(spark, sf_dir), "title", "page_title"
    ).select("page_id", "title")


@query(
    "attach_entity_id",
    "SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) AS page_title, f.id AS wikidata_id"
    f" FROM lineitem LEFT JOIN ({FIRST}) f ON f.name = CAST(l_partkey AS VARCHAR)",
)
def _(spark, sf_dir):
    pages = fx.table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "cast(l_partkey as string) as page_title"
    )
    entities = op.append_by_name(fx.name_sources(spark, sf_dir))
    return op.attach_entity_id(pages, entities, ["source_rank", "pos"])


@query(
    "exclude_known_titles_large",
    "SELECT o_orderkey AS page_id, CAST(o_custkey AS VARCHAR) AS title FROM orders"
    f" WHERE NOT EXISTS (SELECT 1 FROM ({KNOWN}) k WHERE k.page_title = CAST(o_custkey AS VARCHAR))",
)
def _(spark, sf_dir):
    """The same with a known side that counts as too large to copy, and hot titles spread."""
    return op.exclude_known_titles(
        fx.order_titles(spark, sf_dir), fx.known_titles(spark, sf_dir), "title", "page_title", limit=0, min_rows=1
    ).select("page_id", "title")


@query(
    "attach_entity_id_large",
    "SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) AS page_title, f.id AS wikidata_id"
    f" FROM lineitem LEFT JOIN ({FIRST}) f ON f.name = CAST(l_partkey AS VARCHAR)",
)
def _(spark, sf_dir):
    pages = fx.table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "cast(l_partkey as string) as page_title"
    )
    entities = op.append_by_name(fx.name_sources(spark, sf_dir))
    return op.attach_entity_id(pages, entities, ["source_rank", "pos"], limit=0, min_rows=1)


@query("square", "SELECT p_partkey, p_size * p_size AS squared FROM part")
def _(spark, sf_dir):
    return fx.table(spark, sf_dir, "part").select("p_partkey", fn.square("p_size").alias("squared"))


@query(
    "cast_int_string",
    "SELECT CAST(l_partkey AS VARCHAR) AS key_text, TRY_CAST(CAST(l_linenumber AS VARCHAR) AS INTEGER) AS line,"
    " TRY_CAST(l_returnflag AS INTEGER) AS flag FROM lineitem",
)
def _(spark, sf_dir):
    padded = F.concat(F.lit(" "), fn.cast_string("l_linenumber"), F.lit("\t"))
    return fx.table(spark, sf_dir, "lineitem").select(
        fn.cast_string("l_partkey").alias("key_text"), fn.cast_int(padded).alias("line"),
        fn.cast_int("l_returnflag").alias("flag"),
    )
