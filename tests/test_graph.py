import random

import pytest
from pyspark.sql import functions as F

from compare import plan_text

from pagemill import operators as op
from pagemill import plans
from pagemill.constants import (
    ABOUT, ALT_LABEL, ARTICLE_SITE, GENRE, IN_LANGUAGE, INSTANCE_OF, IS_PART_OF, LABEL, NAME, PUBLISHER, SERIES,
    SUBCLASS_OF,
)
from pagemill.schemas import TRIPLES
from pagemill.sources import Statement, read_triples, triple_view, triples_from, work_path, write_triples


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


FACTS = [
    ("game", SUBCLASS_OF, "work"), ("rpg", SUBCLASS_OF, "game"), ("jrpg", SUBCLASS_OF, "rpg"),
    ("game", SUBCLASS_OF, "jrpg"),  # a cycle
    ("book", SUBCLASS_OF, "work"),
    ("e1", INSTANCE_OF, "jrpg"), ("e1", INSTANCE_OF, "game"), ("e2", INSTANCE_OF, "rpg"), ("e3", INSTANCE_OF, "book"),
    ("e1", GENRE, "g1"), ("e1", GENRE, "g2"), ("e1", PUBLISHER, "p1"), ("e1", PUBLISHER, "p2"),
    ("e1", SERIES, "s1"), ("e1", SERIES, "s2"),
    ("a1", ABOUT, "e1"), ("a1", IN_LANGUAGE, "en"), ("a1", NAME, "Game one"), ("a1", IS_PART_OF, ARTICLE_SITE),
    ("a2", ABOUT, "e1"), ("a2", IN_LANGUAGE, "fr"), ("a2", NAME, "Jeu un"), ("a2", IS_PART_OF, "https://fr.example/"),
    ("a3", ABOUT, "e2"), ("a3", IN_LANGUAGE, "en"), ("a3", NAME, "Game two"), ("a3", IS_PART_OF, ARTICLE_SITE),
    ("a4", ABOUT, "e3"), ("a4", IN_LANGUAGE, "en"), ("a4", NAME, "Book"), ("a4", IS_PART_OF, ARTICLE_SITE),
]
TEXTS = [
    ("e1", LABEL, "One", "en"), ("e1", LABEL, "Un", "fr"), ("g1", LABEL, "Genre", "en"), ("p1", LABEL, "Editeur", "fr"),
    ("e1", ALT_LABEL, "b", "en"), ("e1", ALT_LABEL, "a", "en"), ("e2", ALT_LABEL, "deux", "fr"),
    ("e1", ALT_LABEL, "x", "fr"),
]


@pytest.fixture(scope="module", params=["plain", "measured"])
def graph(spark, request):
    """The same graph without and with hot values; `measured` calls every frequent value hot."""
    rows = [(*fact, None) for fact in FACTS] + TEXTS
    triples = spark.createDataFrame(rows, TRIPLES)
    path = work_path(spark, "triples")
    write_triples(triples, path)
    stored = read_triples(spark, path)
    if request.param == "plain":
        return op.TripleGraph(stored)
    measured = op.TripleGraph.measure(stored, share=0.1, min_rows=1)
    assert "e1" in measured.hot_subjects(GENRE) and "e1" in measured.hot_objects(ABOUT)
    return measured


@pytest.fixture(params=["few", "many"])
def sizes(request, monkeypatch):
    """Run with key sets that count as small, and with ones that count as too large for broadcast."""
    if request.param == "many":
        from pagemill.operators import graph as module

        measured = module.stage_sized
        monkeypatch.setattr(module, "stage_sized", lambda *args: (measured(*args)[0], False))


def test_triples_of_one_split_are_written_by_several_tasks(spark, monkeypatch):
    from pagemill.sources import triples as module

    monkeypatch.setattr(module, "TASK_BYTES", 4096)
    monkeypatch.setattr(module, "LEAST_BYTES", 1024)
    common = spark.range(0, 2000, 1, 1).selectExpr("concat('s', id) s", "'common' p", "concat('o', id) o", "'en' lang")
    rare = spark.createDataFrame([("a", "rare", "b", None), ("a", None, "c", "en"), (None, "rare", None, None)], TRIPLES)
    triples = common.unionAll(rare).coalesce(1)
    path = work_path(spark, "triples")
    write_triples(triples, path)
    stored = read_triples(spark, path)
    assert rows_of(stored) == rows_of(triples)
    files = {r["p"]: r["n"] for r in stored.groupBy("p").agg(F.count_distinct("_metadata.file_path").alias("n")).collect()}
    assert files["common"] > 8 and files["rare"] <= 2 and files[None] == 1
    write_triples(rare.limit(0), work_path(spark, "triples"))


def test_closure_of_a_cycle(graph):
    assert rows_of(op.subclass_closure(graph, "game")) == [("game",), ("jrpg",), ("rpg",)]
    assert rows_of(op.subclass_closure(graph, "book")) == [("book",)]
    assert rows_of(op.subclass_closure(graph, "absent")) == [("absent",)]
    assert len(rows_of(op.subclass_closure(graph, "work"))) == 5


def test_one_row_per_matching_class(graph):
    assert rows_of(op.instance_of_closure(graph, "game")) == [("e1",), ("e1",), ("e2",)]
    assert rows_of(op.instance_of_closure(graph, "game", distinct=True)) == [("e1",), ("e2",)]


def test_optional_values_multiply(spark, graph):
    rows = spark.createDataFrame([("e1",), ("e2",)], "id string")
    rows = op.optional_match(op.optional_match(rows, graph, GENRE, "genre"), graph, PUBLISHER, "publisher")
    assert rows_of(rows, "id", "genre", "publisher") == sorted(
        [("e1", g, p) for g in ("g1", "g2") for p in ("p1", "p2")] + [("e2", None, None)], key=repr
    )


def test_rows_outside_a_restricted_graph_stay(spark, graph):
    few = spark.createDataFrame([("e2",)], "id string")
    rows = spark.createDataFrame([("e1",), ("e2",)], "id string")
    near = graph.within(few, "id")
    assert rows_of(near.triples, "s") == [(s,) for s in ("e2", "e2")]
    assert rows_of(op.optional_match(rows, near, GENRE, "genre")) == [("e1", None), ("e2", None)]
    assert graph.within(few, "id", limit=0) is graph


def test_articles_and_series(spark, graph, sizes):
    rows = spark.createDataFrame([("e1",), ("e2",), ("e9",)], "id string")
    assert rows_of(op.bgp_join(rows, graph), "id", "article", "name") == [
        ("e1", "a1", "Game one"), ("e2", "a3", "Game two"),
    ]
    assert rows_of(op.bgp_join(rows, graph, language="fr", site="https://fr.example/"), "article") == [("a2",)]
    assert rows_of(op.series_mapping(rows, graph), "id") == [("e1",), ("e1",)]


def test_labels_fall_back(spark, graph):
    rows = spark.createDataFrame([("e1",), ("e2",), ("p1",), (None,)], "n string")
    english = op.label_lookup(rows, graph, "n", ["en"], "label")
    assert rows_of(english, "n", "label") == sorted(
        [("e1", "One"), ("e2", "e2"), ("p1", "p1"), (None, None)], key=repr
    )
    both = op.label_lookup(rows, graph, "n", ["fr", "en"], "label")
    assert dict(rows_of(both, "n", "label"))["e1"] == "Un"
    assert dict(rows_of(op.label_lookup(rows, graph, "n", ["en", "fr"], "label"), "n", "label"))["p1"] == "Editeur"


def test_alternative_labels(graph):
    assert rows_of(op.alt_label_concat(graph, ["en"])) == [("e1", "a, b")]
    assert rows_of(op.alt_label_concat(graph, ["en", "fr"])) == [("e1", "a, b"), ("e2", "deux")]


def test_games_query(graph, sizes):
    games = rows_of(plans.games_query(graph, "game"))
    one = [
        ("e1", "One", g, p, None, "a, b", "Game one", "a1")
        for _ in range(2) for g in ("Genre", "g2") for p in ("p1", "p2")
    ]
    assert games == sorted([*one, ("e2", "e2", None, None, None, None, "Game two", "a3")], key=repr)
    assert plans.series_query(graph, "book").columns == plans.games_query(graph, "game").columns


def test_mapping_query(graph, sizes):
    mapped = plans.mapping_query(graph, "game", ["fr", "en"])
    # Two classes and two series give four rows.
    assert rows_of(mapped) == [("e1", "Un", None, None, None, "x", "a1")] * 4


def one_by_one(rows, graph, languages):
    """The parts of a star by one join after the other."""
    rows = op.language_site_filter(rows, graph, "en", "here", on="n")
    rows = op.label_lookup(rows, graph, "n", languages, "label")
    rows = op.with_alt_labels(rows, graph, languages, "n").withColumnRenamed("nAltLabel", "alt")
    rows = op.required_match(rows, graph, SERIES, "n")
    for predicate, into in ((GENRE, "g"), (PUBLISHER, "p")):
        rows = op.optional_match(rows, graph, predicate, into, on="n")
        rows = op.label_lookup(rows, graph, into, languages, f"{into}Label")
    return rows


def star(rows, graph, languages, required=True):
    parts = [op.Fixed(IN_LANGUAGE, "en"), op.Fixed(IS_PART_OF, "here"), op.Values(SERIES, required=True)] if required else []
    values = [op.Values(p, i, label_into=f"{i}Label", languages=languages) for p, i in ((GENRE, "g"), (PUBLISHER, "p"))]
    return op.star_match(rows, graph, "n", *parts, op.Label(languages, "label"), op.AltLabels(languages, "alt"), *values)


@pytest.fixture(scope="module", params=[None, 1])
def star_graph(spark, request):
    """Nodes with none to many objects; n0 has many genres and n1 many of two predicates."""
    pick, facts = random.Random(8), []
    for k in range(40):
        node = f"n{k}"
        facts += [(node, IN_LANGUAGE, pick.choice(["en", "en", "fr"]), None), (node, IS_PART_OF, pick.choice(["here", "there"]), None)]
        facts += [(node, GENRE, f"g{j}", None) for j in range(pick.choice([0, 1, 2]) if k > 1 else 40)]
        facts += [(node, PUBLISHER, f"p{j}", None) for j in range(pick.choice([0, 0, 1, 3]) if k != 1 else 30)]
        facts += [(node, SERIES, f"s{j}", None) for j in range(pick.choice([0, 1, 2]))]
        facts += [(node, LABEL, f"{lang} {k}", lang) for lang in ("en", "fr", "de") if pick.random() < 0.5]
        facts += [(node, ALT_LABEL, f"{lang} {pick.random()}", lang) for lang in ("en", "fr") for _ in range(pick.choice([0, 2]))]
    for node in ("n0", "n1"):
        facts += [(node, SERIES, "s9", None), (node, IN_LANGUAGE, "en", None), (node, IS_PART_OF, "here", None)]
    facts += [(f"g{j}", LABEL, f"Genre {j}", pick.choice(["en", "fr"])) for j in range(0, 40, 3)]
    triples = spark.createDataFrame(sorted(set(facts), key=repr), TRIPLES)
    if request.param is None:
        return op.TripleGraph(triples)
    measured = op.TripleGraph.measure(triples, share=0.2, min_rows=1)
    assert {"n0", "n1"} <= set(measured.hot_subjects(GENRE)) and "n1" in measured.hot_subjects(PUBLISHER)
    return measured


def test_a_star_gives_the_rows_of_joins_one_by_one(spark, star_graph):
    nodes = [(f"n{k % 43}", k) for k in range(60)] + [(None, 90), ("unknown", 91)]
    rows = spark.createDataFrame(nodes, "n string, _place int")
    languages = ["fr", "en"]
    found, plain = star(rows, star_graph, languages), one_by_one(rows, star_graph, languages)
    assert rows_of(found, *plain.columns) == rows_of(plain) and len(rows_of(plain)) > 1000


def test_a_star_without_required_parts_keeps_every_row(spark, star_graph):
    rows = spark.createDataFrame([("n0", 1), ("n0", 1), ("n5", 2), (None, 3), ("unknown", 4)], "n string, _star int")
    found = star(rows, star_graph, ["en"], required=False)
    plain = rows
    plain = op.label_lookup(plain, star_graph, "n", ["en"], "label")
    plain = op.with_alt_labels(plain, star_graph, ["en"], "n").withColumnRenamed("nAltLabel", "alt")
    for predicate, into in ((GENRE, "g"), (PUBLISHER, "p")):
        plain = op.optional_match(plain, star_graph, predicate, into, on="n")
        plain = op.label_lookup(plain, star_graph, into, ["en"], f"{into}Label")
    assert rows_of(found, *plain.columns) == rows_of(plain)


def test_hot_nodes_add_no_shuffles(spark, star_graph):
    rows = spark.createDataFrame([(f"n{k}", k) for k in range(40)], "n string, k int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hot = plan_text(star(rows, star_graph, ["en"])).count("Exchange hashpartitioning")
        plain = plan_text(star(rows, op.TripleGraph(star_graph.triples), ["en"])).count("Exchange hashpartitioning")
        joins = plan_text(one_by_one(rows, star_graph, ["en"])).count("Exchange hashpartitioning")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Labels of objects and their lookup, the node's triples, and the rows.
    assert hot == plain <= 5 < joins


@pytest.mark.parametrize("build", [triples_from, triple_view])
def test_triples_from_rows(spark, build):
    rows = spark.createDataFrame([(1, "x", None), (2, None, "y")], "id int, a string, b string")
    made = build(rows, "id", [Statement("A", "a"), Statement("B", "b", F.lit("en"))])
    assert made.columns == ["s", "p", "o", "lang"]
    assert rows_of(made) == [("1", "A", "x", None), ("2", "B", "y", "en")]


def test_views_scan_only_the_wanted_statement(spark, tmp_path):
    spark.createDataFrame([(1, "x", "y")], "id int, a string, b string").write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    graph = op.TripleGraph(triple_view(rows, "id", [Statement("A", "a"), Statement("B", "b")]))
    plan = plan_text(graph.pattern("A", "id", "a"))
    assert "Union" not in plan and "ReadSchema: struct<id:int,a:string>" in plan


def test_patterns_read_their_own_partition(graph):
    plan = plan_text(graph.pattern(GENRE, "id", "genre"))
    assert "PartitionFilters: [isnotnull(p" in plan


def test_a_large_key_set_is_not_written(spark):
    import os

    from pagemill.sources.storage import work_root

    triples = spark.createDataFrame([("a", "p", "b", None)], "s string, p string, o string, lang string")
    graph = op.TripleGraph(triples)
    rows = spark.createDataFrame([(f"n{n}",) for n in range(2000)], "id string")
    folder = work_root(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    assert graph.within(rows, "id", limit=10) is graph
    assert set(os.listdir(folder)) == before
    assert graph.within(rows, "id") is not graph


def test_store_keeps_statistics_over_appends(spark, tmp_path):
    rows = [(*fact, None) for fact in FACTS] + TEXTS + [(None, GENRE, "g1", None), ("e9", GENRE, None, None)]
    triples = spark.createDataFrame(rows, TRIPLES)
    store = op.TripleStore(spark, str(tmp_path / "store"))
    # One predicate comes in both appends.
    first = (F.col("p") == GENRE) & (F.col("o") == "g1")
    store.append(triples.where(first))
    store.append(triples.where(~F.coalesce(first, F.lit(False))))
    assert rows_of(store.triples()) == sorted(rows, key=repr)
    counts = {}
    for row in rows:
        counts[row[1]] = counts.get(row[1], 0) + 1
    assert {r["p"]: r["rows"] for r in store.sizes().collect()} == counts
    wanted = {key: set(values) for key, values in op.TripleGraph.measure(triples, share=0.1, min_rows=1).hot.items()}
    assert (GENRE, "s") in wanted and None in wanted[GENRE, "s"]

    def found():
        return {key: set(values) for key, values in store.graph(share=0.1, min_rows=1).hot.items()}

    assert found() == wanted
    assert all("/sketches/" in name for name in store.statistics().inputFiles())
    store.rebuild()
    assert found() == wanted and {r["p"]: r["rows"] for r in store.sizes().collect()} == counts
    only = store.graph([GENRE], share=0.1, min_rows=1)
    assert set(only.hot) == {(GENRE, "s"), (GENRE, "o")}


def test_store_of_empty_tables(spark, tmp_path):
    store = op.TripleStore(spark, str(tmp_path / "store"))
    store.append(spark.createDataFrame([], TRIPLES))
    assert store.triples().count() == 0 and store.sizes().count() == 0 and store.graph().hot == {}
    store.append(spark.createDataFrame([("a", GENRE, "b", None)], TRIPLES))
    assert rows_of(store.triples()) == [("a", GENRE, "b", None)] and store.sizes().count() == 1
