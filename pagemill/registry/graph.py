"""Graph patterns and the graph queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemill import operators as op
from pagemill import plans
from pagemill import sources as src
from pagemill.constants import (
    ABOUT,
    ARTICLE_SITE,
    GENRE,
    INSTANCE_OF,
    NAME,
    PUBLISHER,
    RATING,
    SERIES,
    SUBCLASS_OF,
)
from pagemill.registry import fixtures as fx
from pagemill.registry.base import query

TRIPLES = f"""
    SELECT 'c' || c_custkey AS s, 'P31' AS p, 'n' || c_nationkey AS o, CAST(NULL AS VARCHAR) AS lang FROM customer
    UNION ALL SELECT 'c' || c_custkey, 'P31', 'r1', NULL FROM customer WHERE c_acctbal > 9000
    UNION ALL SELECT 'c' || c_custkey, 'P136', 'm' || c_mktsegment, NULL FROM customer WHERE c_acctbal > 0
    UNION ALL SELECT 'c' || c_custkey, 'P136', 'g' || c_nationkey, NULL FROM customer WHERE c_acctbal > 5000
    UNION ALL SELECT 'c' || c_custkey, 'P123', 'n' || c_nationkey, NULL FROM customer WHERE c_acctbal < 4000
    UNION ALL SELECT 'c' || c_custkey, 'P852', 'e' || c_mktsegment, NULL FROM customer WHERE c_acctbal > 7000
    UNION ALL SELECT 'c' || c_custkey, 'P179', 'n' || c_nationkey, NULL FROM customer WHERE c_acctbal > 3000
    UNION ALL SELECT 'c' || c_custkey, 'P179', 'r0', NULL FROM customer WHERE c_acctbal > 8000
    UNION ALL SELECT 'c' || c_custkey, 'rdfs:label', c_name, 'en' FROM customer
    UNION ALL SELECT 'c' || c_custkey, 'rdfs:label', 'Client ' || c_custkey, 'fr' FROM customer WHERE c_nationkey < 10
    UNION ALL SELECT 'c' || c_custkey, 'skos:altLabel', c_mktsegment, 'en' FROM customer
    UNION ALL SELECT 'c' || c_custkey, 'skos:altLabel', 'alias ' || c_custkey, 'en' FROM customer WHERE c_acctbal > 0
    UNION ALL SELECT DISTINCT 'm' || c_mktsegment, 'rdfs:label', c_mktsegment, 'en' FROM customer
    UNION ALL SELECT 'n' || n_nationkey, 'P279', 'r' || n_regionkey, NULL FROM nation
    UNION ALL SELECT 'n' || n_nationkey, 'rdfs:label', n_name, 'en' FROM nation WHERE n_regionkey <> 2
    UNION ALL SELECT 'n' || n_nationkey, 'rdfs:label', 'Pays ' || n_nationkey, 'fr' FROM nation WHERE n_regionkey < 2
    UNION ALL SELECT 'r' || r_regionkey, 'P279', 'root', NULL FROM region
    UNION ALL SELECT 'r' || r_regionkey, 'rdfs:label', r_name, 'en' FROM region
    UNION ALL SELECT 'root', 'P279', 'r0', NULL FROM region WHERE r_regionkey = 0
    UNION ALL SELECT 'a' || o_orderkey, 'schema:about', 'c' || o_custkey, NULL FROM orders
    UNION ALL SELECT 'a' || o_orderkey, 'schema:inLanguage', CASE o_orderstatus WHEN 'F' THEN 'fr' ELSE 'en' END, NULL
        FROM orders
    UNION ALL SELECT 'a' || o_orderkey, 'schema:name', 'Order ' || o_orderkey, NULL FROM orders
    UNION ALL SELECT 'a' || o_orderkey, 'schema:isPartOf', CASE o_orderpriority WHEN '5-LOW'
        THEN 'https://other.example/' ELSE '{ARTICLE_SITE}' END, NULL FROM orders"""


def plain_sql(body: str) -> str:
    """For queries that follow no classes."""
    return f"WITH t AS MATERIALIZED ({TRIPLES}) {body}"


def with_sql(target: str, body: str) -> str:
    return (
        f"WITH RECURSIVE t AS ({TRIPLES}), classes AS (SELECT '{target}' AS node UNION"
        " SELECT t.s FROM t JOIN classes c ON t.p = 'P279' AND t.o = c.node) " + body
    )


INSTANCES = "SELECT t.s AS id FROM t WHERE t.p = 'P31' AND t.o IN (SELECT node FROM classes)"
ARTICLES = (
    "SELECT s AS article, o AS id FROM t WHERE p = 'schema:about'"
    " AND s IN (SELECT s FROM t WHERE p = 'schema:inLanguage' AND o = 'en')"
    f" AND s IN (SELECT s FROM t WHERE p = 'schema:isPartOf' AND o = '{ARTICLE_SITE}')"
)
ALT_LABELS = (
    "SELECT s AS id, array_to_string(list_sort(list(DISTINCT o)), ', ') AS idAltLabel FROM t"
    " WHERE p = 'skos:altLabel' AND lang = 'en' GROUP BY s"
)


def label_sql(node: str, languages: tuple[str, ...]) -> str:
    """Scalar label of `node`, in language order, with the identifier as the last choice."""
    found = [
        f"(SELECT min(o) FROM t l WHERE l.p = 'rdfs:label' AND l.lang = '{language}' AND l.s = {node})"
        for language in languages
    ]
    return f"CASE WHEN {node} IS NOT NULL THEN coalesce({', '.join(found)}, {node}) END"


def entity_sql(target: str, languages: tuple[str, ...]) -> str:
    return with_sql(target, f"""
        SELECT i.id, {label_sql('i.id', languages)} AS idLabel, {label_sql('g.o', languages)} AS genreLabel,
            {label_sql('b.o', languages)} AS publisherLabel, {label_sql('e.o', languages)} AS esrbLabel,
            x.idAltLabel, n.o AS name, a.article
        FROM ({INSTANCES}) i JOIN ({ARTICLES}) a ON a.id = i.id
        JOIN t n ON n.p = 'schema:name' AND n.s = a.article
        LEFT JOIN t g ON g.p = 'P136' AND g.s = i.id
        LEFT JOIN t b ON b.p = 'P123' AND b.s = i.id
        LEFT JOIN t e ON e.p = 'P852' AND e.s = i.id
        LEFT JOIN ({ALT_LABELS}) x ON x.id = i.id""")


def derived_graph(spark, sf_dir, *predicates: str, **measure) -> op.TripleGraph:
    """The graph over the given tables, measured for the predicates that are joined on."""
    triples = fx.triples(spark, sf_dir, src.triple_view)
    return op.TripleGraph.measure(triples, predicates, **measure) if predicates else op.TripleGraph(triples)


def stored_graph(spark, sf_dir, *predicates: str, **measure) -> op.TripleGraph:
    """The same graph as a table partitioned by predicate, for queries with many patterns."""
    path = src.work_path(spark, "triples")
    src.write_triples(fx.triples(spark, sf_dir), path)
    return op.TripleGraph.measure(src.read_triples(spark, path), predicates, **measure)


def appended_store(spark, sf_dir) -> op.TripleStore:
    """The same triples in a store: first the links between nodes, then the texts."""
    store = op.TripleStore(spark, src.work_path(spark, "store"))
    triples = src.stage(fx.triples(spark, sf_dir), "triples")
    is_text = F.col("lang").isNotNull()
    store.append(triples.where(~is_text))
    store.append(triples.where(is_text))
    return store


# Makes small tables have hot values, so that joins spread them.
EASILY_HOT = {"share": 0.01, "min_rows": 1}


@query("triple_view", f"SELECT * FROM ({TRIPLES})")
def _(spark, sf_dir):
    return fx.triples(spark, sf_dir, src.triple_view)


@query("write_triples", f"SELECT * FROM ({TRIPLES})")
def _(spark, sf_dir):
    path = src.work_path(spark, "triples")
    src.write_triples(fx.triples(spark, sf_dir), path)
    return src.read_triples(spark, path)


@query("triple_store_sizes", f"SELECT p, count(*) AS rows FROM ({TRIPLES}) GROUP BY p")
def _(spark, sf_dir):
    return appended_store(spark, sf_dir).sizes()


@query("triples", f"SELECT * FROM ({TRIPLES})")
def _(spark, sf_dir):
    return fx.triples(spark, sf_dir)


@query("subclass_closure", with_sql("r0", "SELECT node FROM classes"))
def _(spark, sf_dir):
    return op.subclass_closure(derived_graph(spark, sf_dir, SUBCLASS_OF), "r0")


@query("instance_of_closure", with_sql("r1", INSTANCES))
def _(spark, sf_dir):
    graph = derived_graph(spark, sf_dir, INSTANCE_OF, SUBCLASS_OF)
    return op.instance_of_closure(graph, "r1")


@query("instance_of_closure_distinct", with_sql("r0", f"SELECT DISTINCT id FROM ({INSTANCES})"))
def _(spark, sf_dir):
    graph = derived_graph(spark, sf_dir, INSTANCE_OF, SUBCLASS_OF)
    return op.instance_of_closure(graph, "r0", distinct=True)


OPTIONAL_SQL = plain_sql(
        "SELECT i.s AS id, g.o AS genre, b.o AS publisher, e.o AS esrb FROM t i"
        " LEFT JOIN t g ON g.p = 'P136' AND g.s = i.s LEFT JOIN t b ON b.p = 'P123' AND b.s = i.s"
        " LEFT JOIN t e ON e.p = 'P852' AND e.s = i.s WHERE i.p = 'P31'"
)


def optional_rows(graph):
    rows = graph.pattern(INSTANCE_OF, "id")
    for node, predicate in (("genre", GENRE), ("publisher", PUBLISHER), ("esrb", RATING)):
        rows = op.optional_match(rows, graph, predicate, node)
    return rows


@query("optional_match", OPTIONAL_SQL)
def _(spark, sf_dir):
    return optional_rows(derived_graph(spark, sf_dir, INSTANCE_OF, GENRE, PUBLISHER, RATING))


@query("optional_match_hot", OPTIONAL_SQL)
def _(spark, sf_dir):
    return optional_rows(derived_graph(spark, sf_dir, INSTANCE_OF, GENRE, PUBLISHER, RATING, **EASILY_HOT))


# Every customer is an instance, some of two classes; its articles are the orders in English on the site.
BGP_SQL = (
    "SELECT 'c' || o_custkey AS id, 'a' || o_orderkey AS article, 'Order ' || o_orderkey AS name"
    " FROM orders JOIN (SELECT c_custkey FROM customer"
    " UNION ALL SELECT c_custkey FROM customer WHERE c_acctbal > 9000) ON c_custkey = o_custkey"
    " WHERE o_orderstatus <> 'F' AND o_orderpriority <> '5-LOW'"
)


@query("bgp_join", BGP_SQL)
def _(spark, sf_dir):
    graph = derived_graph(spark, sf_dir, INSTANCE_OF, ABOUT, NAME)
    return op.bgp_join(graph.pattern(INSTANCE_OF, "id"), graph).select("id", "article", "name")


@query("bgp_join_hot", BGP_SQL)
def _(spark, sf_dir):
    graph = derived_graph(spark, sf_dir, INSTANCE_OF, ABOUT, NAME, **EASILY_HOT)
    return op.bgp_join(graph.pattern(INSTANCE_OF, "id"), graph).select("id", "article", "name")


@query("language_site_filter", plain_sql(f"SELECT article FROM ({ARTICLES})"))
def _(spark, sf_dir):
    graph = derived_graph(spark, sf_dir, ABOUT)
    return op.language_site_filter(graph.pattern(ABOUT, "article"), graph)


@query(
    "label_lookup",
    plain_sql(
        f"SELECT s AS id, o AS class, {label_sql('t.o', ('fr', 'en'))} AS classLabel FROM t WHERE p = 'P31'",
    ),
)
def _(spark, sf_dir):
    graph = derived_graph(spark, sf_dir, INSTANCE_OF)
    rows = graph.pattern(INSTANCE_OF, "id", "class")
    return op.label_lookup(rows, graph, "class", ("fr", "en"), "classLabel").select("id", "class", "classLabel")


@query("alt_label_concat", plain_sql(ALT_LABELS))
def _(spark, sf_dir):
    return op.alt_label_concat(derived_graph(spark, sf_dir), ("en",))


@query(
    "series_mapping",
    plain_sql("SELECT i.s AS id FROM t i JOIN t m ON m.p = 'P179' AND m.s = i.s WHERE i.p = 'P31'"),
)
def _(spark, sf_dir):
    graph = derived_graph(spark, sf_dir, INSTANCE_OF, SERIES)
    return op.series_mapping(graph.pattern(INSTANCE_OF, "id"), graph)


@query("games_query", entity_sql("r1", ("en",)))
def games_query(spark, sf_dir):
    return plans.games_query(stored_graph(spark, sf_dir, *op.JOINED), "r1")


@query("games_query_hot", entity_sql("r1", ("en",)))
def _(spark, sf_dir):
    return plans.games_query(stored_graph(spark, sf_dir, *op.JOINED, **EASILY_HOT), "r1")


@query("games_query_store", entity_sql("r1", ("en",)))
def _(spark, sf_dir):
    return plans.games_query(appended_store(spark, sf_dir).graph(**EASILY_HOT), "r1")


@query("series_query", entity_sql("r2", ("fr", "en")))
def _(spark, sf_dir):
    return plans.series_query(stored_graph(spark, sf_dir, *op.JOINED), "r2", ("fr", "en"))


@query(
    "mapping_query",
    with_sql("r1", f"""
        SELECT i.id, {label_sql('i.id', ('fr', 'en'))} AS idLabel, CAST(NULL AS VARCHAR) AS genreLabel,
            CAST(NULL AS VARCHAR) AS publisherLabel, CAST(NULL AS VARCHAR) AS esrbLabel, x.idAltLabel, a.article
        FROM ({INSTANCES}) i JOIN t m ON m.p = 'P179' AND m.s = i.id JOIN ({ARTICLES}) a ON a.id = i.id
        LEFT JOIN ({ALT_LABELS}) x ON x.id = i.id"""),
)
def _(spark, sf_dir):
    graph = stored_graph(spark, sf_dir, INSTANCE_OF, SUBCLASS_OF, SERIES, ABOUT)
    return plans.mapping_query(graph, "r1", ("fr", "en"))
