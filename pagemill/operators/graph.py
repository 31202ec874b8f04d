"""Graph patterns over a table of distinct triples (s, p, o, lang)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.constants import (
    ABOUT,
    ALT_LABEL,
    ARTICLE_LANGUAGE,
    ARTICLE_SITE,
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
from pagemill.operators.skew import HOT_ROWS, HOT_SHARE, hot_values_by, spread_join
from pagemill.sources.storage import BROADCAST_BYTES, stage, stage_sized, surely_larger, work_path

# Predicates whose subjects and objects are joined on.
JOINED = (INSTANCE_OF, SUBCLASS_OF, GENRE, PUBLISHER, RATING, SERIES, ABOUT, NAME)


class TripleGraph:
    """A triple table together with its hot subjects and objects per predicate.

    `measure` finds those with one sketch pass. They steer how joins spread rows; results are the
    same without them.
    """

    def __init__(self, triples: DataFrame, hot: dict[tuple, list] | None = None) -> None:
        self.triples = triples
        self.hot = hot or {}

    @classmethod
    def measure(
        cls,
        triples: DataFrame,
        predicates: Sequence[str] = JOINED,
        share: float = HOT_SHARE,
        min_rows: int = HOT_ROWS,
    ) -> TripleGraph:
        rows = triples.where(F.col("p").isin(list(predicates)))
        return cls(triples, hot_values_by(rows, "p", ["s", "o"], share, min_rows))

    def pattern(self, predicate: str, subject: str, value: str | None = None) -> DataFrame:
        """Matches of `?subject predicate ?value`; without `value` only the subject is returned."""
        matches = self.triples.where(F.col("p") == predicate)
        columns = [F.col("s").alias(subject)] + ([F.col("o").alias(value)] if value else [])
        return matches.select(*columns)

    def fixed(self, predicate: str, subject: str, value: str) -> DataFrame:
        """Subjects of `?subject predicate value`."""
        matches = self.triples.where((F.col("p") == predicate) & (F.col("o") == value))
        return matches.select(F.col("s").alias(subject))

    def within(self, rows: DataFrame, *columns: str, limit: int = BROADCAST_BYTES) -> TripleGraph:
        """The part of the graph whose subjects occur in `columns` of `rows`, if those are few.

        Their set is staged and measured. Within `limit` it is broadcast, so that patterns are cut
        down while they are scanned and only the wanted part is shuffled later; beyond it the graph
        stays as it is, and joins do the work.
        """
        nodes = rows.select(F.explode(F.array(*columns)).alias("s")).where(F.col("s").isNotNull())
        if surely_larger(nodes, limit):
            return self
        nodes, small = stage_sized(nodes.distinct(), "nodes", limit)
        if not small:
            return self
        # A hot subject has to occur in its pattern, so only those that are left stay hot.
        subjects = {v for (_, side), values in self.hot.items() if side == "s" for v in values}
        left = nodes.where(F.col("s").isin(list(subjects))).collect() if subjects else []
        kept = {row["s"] for row in left}
        hot = {
            (predicate, side): [v for v in values if side == "o" or v in kept]
            for (predicate, side), values in self.hot.items()
        }
        return TripleGraph(self.triples.join(F.broadcast(nodes), "s", "left_semi"), hot)

    def hot_subjects(self, predicate: str) -> list:
        return self.hot.get((predicate, "s"), [])

    def hot_objects(self, predicate: str) -> list:
        return self.hot.get((predicate, "o"), [])

    def hot_nodes(self) -> list:
        """Every hot value of any pattern."""
        return list(dict.fromkeys(v for values in self.hot.values() for v in values))


def subclass_closure(graph: TripleGraph, target: str) -> DataFrame:
    """(node) for `target` and every class below it, each once. Cycles are fine.

    Each round follows only the classes found in the last one and writes the new ones to the shared
    folder, so plans stay small and the rounds read measured tables. Two scalars per round reach the
    driver; the number of rounds is the depth of the class tree.
    """
    spark = graph.triples.sparkSession
    root = work_path(spark, "closure")
    graph.pattern(SUBCLASS_OF, "below", "node").write.parquet(f"{root}/edges")
    edges = spark.read.schema("below string, node string").parquet(f"{root}/edges")
    hot = graph.hot_objects(SUBCLASS_OF)

    def nodes(*paths: str) -> DataFrame:
        return spark.read.schema("node string").parquet(*paths)

    top = spark.range(1).select(F.lit(target).alias("node"))
    known, frontier, rounds = top, top, []
    while True:
        found = spread_join(edges, frontier, "node", "left_semi", hot_left=hot)
        fresh = found.select(F.col("below").alias("node")).distinct().join(known, "node", "left_anti")
        path = f"{root}/nodes/round={len(rounds)}"
        fresh.write.parquet(path)
        frontier = nodes(path)
        if frontier.isEmpty():
            return known
        rounds.append(path)
        known = top.unionAll(nodes(*rounds))


def instance_of_closure(
    graph: TripleGraph, target: str, subject: str = "id", distinct: bool = False
) -> DataFrame:
    """Subjects that are an instance of `target` or of a class below it.

    A subject appears once per matching class, as a path of one instance-of step and any number of
    subclass steps does; `distinct` keeps it once.
    """
    classes = subclass_closure(graph, target)
    direct = graph.pattern(INSTANCE_OF, subject, "node")
    hot = graph.hot_objects(INSTANCE_OF)
    found = spread_join(direct, classes, "node", "left_semi", hot_left=hot).select(subject)
    return found.distinct() if distinct else found


def optional_match(
    rows: DataFrame, graph: TripleGraph, predicate: str, into: str, on: str = "id"
) -> DataFrame:
    """Add `into`, the objects of `predicate`: one row per object, NULL when there is none."""
    return spread_join(
        rows,
        graph.pattern(predicate, on, into),
        on,
        "left",
        hot_left=graph.hot_nodes(),
        hot_right=graph.hot_subjects(predicate),
    )


def required_match(
    rows: DataFrame, graph: TripleGraph, predicate: str, on: str = "id", into: str | None = None
) -> DataFrame:
    """Keep rows that have `predicate`, one row per object; `into` names the object if wanted."""
    return spread_join(
        rows,
        graph.pattern(predicate, on, into),
        on,
        "inner",
        hot_left=graph.hot_nodes(),
        hot_right=graph.hot_subjects(predicate),
    )


def series_mapping(rows: DataFrame, graph: TripleGraph, on: str = "id") -> DataFrame:
    """Rows that belong to a series, once per series."""
    return required_match(rows, graph, SERIES, on)


def language_site_filter(
    rows: DataFrame,
    graph: TripleGraph,
    language: str = ARTICLE_LANGUAGE,
    site: str = ARTICLE_SITE,
    on: str = "article",
) -> DataFrame:
    """Keep articles in the given language and on the given site."""
    hot = graph.hot_nodes()
    rows = spread_join(rows, graph.fixed(IN_LANGUAGE, on, language), on, "left_semi", hot_left=hot)
    return spread_join(rows, graph.fixed(IS_PART_OF, on, site), on, "left_semi", hot_left=hot)


def entity_articles(
    entities: DataFrame, graph: TripleGraph, on: str = "id", limit: int = BROADCAST_BYTES
) -> DataFrame:
    """The entities with the articles about them, staged: one row per entity row and article."""
    entities, few = stage_sized(entities, "entities", limit)
    about = graph.pattern(ABOUT, "article", on)
    if few:
        found = about.join(F.broadcast(entities), on)
    else:
        found = spread_join(
            entities, about, on, "inner", hot_left=graph.hot_nodes(), hot_right=graph.hot_objects(ABOUT)
        )
    return stage(found, "articles")


def label_lookup(
    rows: DataFrame,
    graph: TripleGraph,
    node: str,
    languages: Sequence[str],
    into: str,
    unbound: bool = True,
) -> DataFrame:
    """Add the label of `node` in the first language that has one; its identifier if none has.

    `unbound` says that `node` may be NULL, as optional nodes often are for most rows.
    """
    spoken = F.array(*[F.lit(language) for language in languages])
    labels = graph.triples.where((F.col("p") == LABEL) & F.col("lang").isin(list(languages)))
    best = F.min_by("o", F.struct(F.array_position(spoken, F.col("lang")), F.col("o")))
    lookup = labels.groupBy(F.col("s").alias(node)).agg(best.alias("_label"))
    hot = [*graph.hot_nodes(), *([None] if unbound else [])]
    labelled = spread_join(rows, lookup, node, "left", hot_left=hot)
    return labelled.withColumn(into, F.coalesce("_label", node)).drop("_label")


def alt_label_concat(
    graph: TripleGraph, languages: Sequence[str], node: str = "id", into: str = "idAltLabel"
) -> DataFrame:
    """(node, into): all alternative labels in the first language that has any, sorted, as one text."""
    spoken = F.array(*[F.lit(language) for language in languages])
    labels = graph.triples.where((F.col("p") == ALT_LABEL) & F.col("lang").isin(list(languages)))
    texts = labels.groupBy("s", "lang").agg(
        F.array_join(F.array_sort(F.collect_set("o")), ", ").alias("text")
    )
    first = F.min_by("text", F.array_position(spoken, F.col("lang")))
    return texts.groupBy(F.col("s").alias(node)).agg(first.alias(into))


def with_alt_labels(
    rows: DataFrame, graph: TripleGraph, languages: Sequence[str], node: str = "id"
) -> DataFrame:
    """Add `<node>AltLabel`, NULL for nodes without alternative labels."""
    lookup = alt_label_concat(graph, languages, node, f"{node}AltLabel")
    return spread_join(rows, lookup, node, "left", hot_left=graph.hot_nodes())
