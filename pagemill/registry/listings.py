"""Listings, files and chunks."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemill import functions as fn
from pagemill import operators as op
from pagemill import sources as src
from pagemill.constants import ENTITY_PREFIX
from pagemill.plans import build_category_table
from pagemill.registry import fixtures as fx
from pagemill.registry.base import joined_lists, query
from pagemill.streaming import ingest_batches, track_listing, tracked_breaks

LINES = (
    "SELECT p_partkey, CASE WHEN p_size > 45 THEN p_name ELSE p_partkey || '; ' || p_name ||"
    " CASE p_type WHEN 'ECONOMY' THEN '; ' || p_brand WHEN 'SMALL' THEN '  ' ELSE '' END END AS value FROM part"
)
TITLE = "CASE WHEN p_size <= 45 THEN p_name END"
CATEGORY = (
    "SELECT p_type || ' ' || p_partkey AS category, CAST(floor(p_retailprice) AS INTEGER) AS size,"
    " p_size AS num_pages, CAST(length(p_brand) AS INTEGER) AS num_subcat,"
    " CAST(length(p_name) AS INTEGER) AS num_files FROM part"
)
# The fixtures' tokens are ids of pages.
FIRST_ID = "query.allpages[0].pageid"
PAGE_LISTING = "SELECT p_partkey AS page_id, p_name AS title FROM part"


def _batches(spark, sf_dir, kind="pages"):
    rows = fx.page_batches(spark, sf_dir) if kind == "pages" else fx.category_batches(spark, sf_dir)
    return src.parse_listing_batches(rows, kind=kind)


@query("load_page_listing", PAGE_LISTING)
def _(spark, sf_dir):
    return src.load_page_listing(_batches(spark, sf_dir))


@query(
    "load_category_listing",
    "SELECT CAST(floor(p_retailprice) AS INTEGER) AS size, p_size AS pages,"
    " CAST(length(p_name) AS INTEGER) AS files, CAST(length(p_brand) AS INTEGER) AS subcats,"
    " p_type || ' ' || p_partkey AS title FROM part",
)
def _(spark, sf_dir):
    return src.load_category_listing(_batches(spark, sf_dir, "categories"))


@query("read_title_list", f"SELECT p_partkey, {TITLE} AS title FROM part")
def _(spark, sf_dir):
    return src.read_title_list(fx.title_lines(spark, sf_dir))


@query("read_category_list", CATEGORY)
def _(spark, sf_dir):
    return src.read_category_list(fx.category_lines(spark, sf_dir))


@query("build_category_table", CATEGORY)
def _(spark, sf_dir):
    return build_category_table(_batches(spark, sf_dir, "categories"))


@query(
    "title_from_line",
    f"SELECT p_partkey, {TITLE} AS title, CASE WHEN p_size <= 45 THEN p_name ||"
    " CASE WHEN p_type = 'ECONOMY' THEN '; ' || p_brand ELSE '' END END AS title_with_rest FROM part",
)
def _(spark, sf_dir):
    return fx.title_lines(spark, sf_dir).select(
        "p_partkey", fn.title_from_line("value").alias("title"),
        fn.title_from_line("value", keep_rest=True).alias("title_with_rest"),
    )


@query("category_fields", CATEGORY)
def _(spark, sf_dir):
    lines = fx.category_lines(spark, sf_dir)
    return lines.select(fn.category_fields("value", keep_rest=True).alias("f")).select("f.*")


@query("format_line", "SELECT p_partkey || '; ' || p_name || '; ' || p_type AS line FROM part")
def _(spark, sf_dir):
    return fx.table(spark, sf_dir, "part").select(fn.format_line("p_partkey", "p_name", "p_type").alias("line"))


@query("write_delimited", "SELECT p_partkey || '; ' || p_name AS value FROM part")
def _(spark, sf_dir):
    path = src.work_path(spark, "titles")
    src.write_delimited(fx.table(spark, sf_dir, "part"), path, ["p_partkey", "p_name"])
    return src.read_lines(spark, path)


@query("read_lines_split", f"SELECT value FROM ({LINES})")
def _(spark, sf_dir):
    path = src.work_path(spark, "lines")
    fx.title_lines(spark, sf_dir).select("value").write.text(path)
    return src.read_lines(spark, path)


@query(
    "read_query_result",
    f"SELECT '{ENTITY_PREFIX}Q' || c_custkey AS id, c_name || ', \"' || c_mktsegment || '\"'"
    " AS idLabel, CASE WHEN c_acctbal > 0 THEN c_mktsegment || ' ' || c_nationkey END AS name FROM customer",
)
def _(spark, sf_dir):
    path = src.work_path(spark, "query")
    rows = fx.table(spark, sf_dir, "customer").selectExpr(
        f"concat('{ENTITY_PREFIX}', 'Q', c_custkey) as id",
        "concat(c_name, ', \"', c_mktsegment, '\"') as idLabel", "c_name as genreLabel",
        "case when c_acctbal > 0 then concat(c_mktsegment, ' ', c_nationkey) end as name",
    )
    src.write_csv_with_lists(rows, path)
    return src.read_query_result(spark, path)


def _page_rows(spark, sf_dir):
    """Pages whose lists hold quotes, commas and nothing at all."""
    return fx.table(spark, sf_dir, "part").selectExpr(
        "cast(p_partkey as string) as page_id", "concat('\"', p_name, '\", ', p_type) as page_title",
        "concat(' ', p_name, ', ', p_brand) as page_text",
        "array(p_brand, concat(p_type, '\\'s')) as category",
        "case when p_size > 45 then cast(array() as array<string>) else array(p_name) end as links",
    )


LITERALS = (
    "SELECT CAST(p_partkey AS VARCHAR) AS page_id, '\"' || p_name || '\", ' || p_type AS page_title,"
    " ' ' || p_name || ', ' || p_brand AS page_text,"
    " '[''' || p_brand || ''', \"' || p_type || '''s\"]' AS category,"
    " CASE WHEN p_size > 45 THEN '[]' ELSE '[''' || p_name || ''']' END AS links FROM part"
)


@query("to_list_literal", LITERALS)
def _(spark, sf_dir):
    return src.lists_to_literals(_page_rows(spark, sf_dir))


@query("write_csv_with_lists", LITERALS)
def _(spark, sf_dir):
    path = src.work_path(spark, "csv")
    src.write_csv_with_lists(_page_rows(spark, sf_dir), path)
    return src.read_page_csv(spark, path)


IMPORTED = (
    "SELECT CAST(p_partkey AS VARCHAR) AS page_id, '\"' || p_name || '\", ' || p_type AS page_title,"
    " ' ' || p_name || ', ' || p_brand AS page_text, p_brand || ' | \"' || p_type || 's\"' AS category,"
    " CASE WHEN p_size > 45 THEN '' ELSE p_name END AS links FROM part"
)


@query("read_page_csv", IMPORTED)
def _(spark, sf_dir):
    path = src.work_path(spark, "csv")
    src.write_csv_with_lists(_page_rows(spark, sf_dir), path)
    return joined_lists(src.read_page_csv(spark, path, list_columns=("category", "links")), "category", "links")


@query("overwrite_list_columns", IMPORTED)
def _(spark, sf_dir):
    literals = src.lists_to_literals(_page_rows(spark, sf_dir))
    return joined_lists(src.parse_list_columns(literals, ("category", "links")), "category", "links")


@query(
    "parse_list_literal",
    "SELECT p_partkey, p_brand || ' | \"' || p_type || 's\"' AS items, CAST(2 AS INTEGER) AS n_items FROM part",
)
def _(spark, sf_dir):
    text = F.expr("concat('[\\'', p_brand, '\\', \"', p_type, '\\'s\"]')")
    items = fx.table(spark, sf_dir, "part").select("p_partkey", fn.parse_list_literal(text).alias("items"))
    return joined_lists(items.withColumn("n_items", F.size("items")), "items")


@query("write_parquet", CATEGORY)
def _(spark, sf_dir):
    path = src.work_path(spark, "categories")
    src.write_table(src.read_category_list(fx.category_lines(spark, sf_dir)), path)
    return spark.read.parquet(path)


@query("list_files", "SELECT DISTINCT event_type, true AS has_content FROM events")
def _(spark, sf_dir):
    path = src.work_path(spark, "by_type")
    fx.table(spark, sf_dir, "events").write.partitionBy("event_type").parquet(path)
    files = src.list_files(spark, path, ".parquet")
    kind = F.regexp_extract("path", "event_type=([^/]+)/", 1).alias("event_type")
    return files.groupBy(kind).agg((F.min("length") > 0).alias("has_content"))


@query("ingest_batches", PAGE_LISTING)
def _(spark, sf_dir):
    root = src.work_path(spark, "ingest")
    fx.page_batches(spark, sf_dir).select("body").write.text(f"{root}/in")
    ingest_batches(spark, f"{root}/in", f"{root}/out", f"{root}/state")
    return spark.read.schema("page_id bigint, title string").parquet(f"{root}/out")


@query(
    "ingest_metrics",
    "SELECT count(DISTINCT p_partkey // 500) AS batches, CAST(0 AS BIGINT) AS broken,"
    " CAST(1 AS BIGINT) AS final_batches, count(*) AS entries FROM part",
)
def _(spark, sf_dir):
    root = src.work_path(spark, "metrics")
    fx.page_batches(spark, sf_dir).select("body").write.text(f"{root}/in")
    counts = ingest_batches(spark, f"{root}/in", f"{root}/out", f"{root}/state", files_per_trigger=3)
    return spark.createDataFrame([tuple(counts.values())], ", ".join(f"{name} bigint" for name in counts))


@query(
    "listing_complete",
    "SELECT count(DISTINCT p_partkey // 500) AS batches, CAST(1 AS BIGINT) AS final_batches, true AS complete"
    " FROM part",
)
def _(spark, sf_dir):
    return src.listing_complete(_batches(spark, sf_dir), F.expr(FIRST_ID))


# Of every ten batches one is gone, one is there twice, and one has lost its token.
BROKEN = """
    WITH kept AS (
        SELECT DISTINCT o_orderkey // 500 AS batch, max(o_orderkey // 500) OVER () AS last FROM orders
    ), links AS (
        SELECT batch * 500 AS begin, CASE WHEN batch < last AND batch % 10 <> 4 THEN (batch + 1) * 500 END AS next
        FROM kept, range(2) copies(n) WHERE batch % 10 <> 1 AND (n = 0 OR batch % 10 = 2)
    ), problems AS (
        SELECT DISTINCT 'missing batch' AS problem, next AS token FROM links
        WHERE next IS NOT NULL AND next NOT IN (SELECT begin FROM links)
        UNION ALL SELECT 'repeated batch', begin FROM links GROUP BY begin HAVING count(*) > 1
        UNION ALL SELECT 'repeated continuation', next FROM links WHERE next IS NOT NULL GROUP BY next HAVING count(*) > 1
        UNION ALL SELECT DISTINCT 'several starts', begin FROM links WHERE begin NOT IN (SELECT next FROM links WHERE next IS NOT NULL)
            AND (SELECT count(DISTINCT begin) FROM links WHERE begin NOT IN (SELECT next FROM links WHERE next IS NOT NULL)) > 1
        UNION ALL SELECT DISTINCT 'several endings', begin FROM links WHERE next IS NULL
            AND (SELECT count(*) FROM links WHERE next IS NULL) > 1
    )"""


def _broken_batches(spark, sf_dir):
    batches = src.parse_listing_batches(fx.order_batches(spark, sf_dir))
    batch = F.call_function("div", F.col("query.allpages")[0]["pageid"], F.lit(500))
    copies = F.explode(F.sequence(F.lit(1), F.when(batch % 10 == 2, 2).otherwise(1)))
    more = F.when(batch % 10 != 4, F.col("continue"))
    return batches.where(batch % 10 != 1).select(more.alias("continue"), "query", copies.alias("copy")).drop("copy")


@query("listing_breaks", f"{BROKEN} SELECT problem, CAST(token AS VARCHAR) AS token FROM problems")
def _(spark, sf_dir):
    return src.listing_breaks(_broken_batches(spark, sf_dir), F.expr(FIRST_ID))


@query("tracked_breaks", f"{BROKEN} SELECT problem, CAST(token AS VARCHAR) AS token FROM problems")
def _(spark, sf_dir):
    """The same, found while batch files come in, in any order."""
    root = src.work_path(spark, "tracked")
    lines = _broken_batches(spark, sf_dir).select(F.to_json(F.struct("continue", "query")).alias("body"))
    lines.repartition(6, "body").write.text(f"{root}/in")
    track_listing(spark, f"{root}/in", f"{root}/tokens", f"{root}/state", begins=F.expr(FIRST_ID), files_per_trigger=2)
    return tracked_breaks(spark, f"{root}/tokens")


@query(
    "listing_incomplete",
    f"{BROKEN} SELECT count(*) AS batches, count(*) - count(next) AS final_batches,"
    " NOT EXISTS (SELECT 1 FROM problems) AS complete FROM links",
)
def _(spark, sf_dir):
    return src.listing_complete(_broken_batches(spark, sf_dir), F.expr(FIRST_ID))


@query("batch_count", "SELECT count(DISTINCT p_partkey // 500) AS batches FROM part")
def _(spark, sf_dir):
    return src.batch_count(_batches(spark, sf_dir))


@query(
    "split_even",
    "SELECT p_partkey, CAST(ntile(100) OVER (ORDER BY p_name, p_partkey) - 1 AS INTEGER) AS chunk_id FROM part",
)
def _(spark, sf_dir):
    parts = fx.table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return op.split_even(parts, 100, ["p_name", "p_partkey"]).drop("p_name")


# Priorities tie across the bounds: how many orders of one lie in a chunk is fixed, which ones is not.
@query(
    "split_even_ties",
    "SELECT o_orderpriority, CAST(chunk - 1 AS INTEGER) AS chunk_id, count(*) AS orders FROM"
    " (SELECT o_orderpriority, ntile(100) OVER (ORDER BY o_orderpriority) AS chunk FROM orders) GROUP BY ALL",
)
def _(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderkey", "o_custkey")
    chunks = op.split_even(orders, 100, ["o_orderpriority"])
    return chunks.groupBy("o_orderpriority", "chunk_id").agg(F.count("*").alias("orders"))


@query(
    "split_floor",
    "SELECT p_partkey, CAST((row_number() OVER (ORDER BY p_name, p_partkey) * 8 - 1) // count(*) OVER ()"
    " AS INTEGER) AS chunk_id FROM part",
)
def _(spark, sf_dir):
    parts = fx.table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return op.split_floor(parts, 8, ["p_name", "p_partkey"]).drop("p_name")


@query(
    "split_bytes",
    """
    WITH RECURSIVE lines AS MATERIALIZED (
        SELECT conv_id, turn, coalesce(sum(strlen(text) + 1) OVER (
            ORDER BY conv_id, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
        FROM conversations
    ), chunks AS (
        SELECT 0 AS chunk_id, 0::BIGINT AS start
        UNION ALL
        SELECT chunk_id + 1, (SELECT min(l.start) FROM lines l WHERE l.start > chunks.start + 65536)
        FROM chunks WHERE EXISTS (SELECT 1 FROM lines l WHERE l.start > chunks.start + 65536)
    )
    SELECT conv_id, turn, chunk_id FROM lines ASOF JOIN chunks ON lines.start >= chunks.start""",
)
def _(spark, sf_dir):
    lines = fx.table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    return op.split_bytes(lines, 65536, ["conv_id", "turn"], "text").drop("text")


@query(
    "split_byte_ranges",
    "SELECT conv_id, turn, CAST((sum(strlen(text) + 1) OVER (ORDER BY conv_id, turn ROWS UNBOUNDED PRECEDING)"
    " - strlen(text) - 1) // 65536 AS INTEGER) AS chunk_id FROM conversations",
)
def _(spark, sf_dir):
    lines = fx.table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    return op.split_byte_ranges(lines, 65536, ["conv_id", "turn"], "text").drop("text")


@query(
    "take_first_n",
    f"SELECT p_partkey, {TITLE} AS title FROM part ORDER BY p_partkey LIMIT 1000",
)
def _(spark, sf_dir):
    return op.take_first_n(src.read_title_list(fx.title_lines(spark, sf_dir)), 1000, ["p_partkey"]).select(
        "p_partkey", "title"
    )


@query(
    "sample_exact",
    "SELECT o_orderkey, o_custkey FROM orders ORDER BY md5('42:' || o_orderkey), o_orderkey"
    " LIMIT (SELECT count(*) FROM customer)",
)
def _(spark, sf_dir):
    pool = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return op.sample_exact(pool, fx.table(spark, sf_dir, "customer").count(), "o_orderkey")


@query("csv_records_over_lines", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang FROM documents")
def _(spark, sf_dir):
    path = src.work_path(spark, "csv")
    src.write_csv_with_lists(fx.table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), path)
    return src.read_page_csv(spark, path)
