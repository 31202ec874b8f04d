"""Star patterns: everything a query asks about one node, by one aggregate and one join."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.constants import (
    ALT_LABEL,
    ARTICLE_LANGUAGE,
    ARTICLE_SITE,
    IN_LANGUAGE,
    IS_PART_OF,
    LABEL,
    NAME,
)
from pagemill.operators.graph import TripleGraph, entity_articles
from pagemill.operators.skew import FANOUT, row_part


@dataclass(frozen=True)
class Values:
    """Objects of a predicate: one row per object. Without any, a required one drops the row, an optional
    one leaves NULL. `into` names the object and `label_into` its label, which is the object if it has none."""

    predicate: str
    into: str | None = None
    required: bool = False
    label_into: str | None = None
    languages: Sequence[str] = ()


@dataclass(frozen=True)
class Fixed:
    """Keep rows whose node has `predicate` with this object."""

    predicate: str
    value: str


@dataclass(frozen=True)
class Label:
    """The node's label in the first language that has one; the node itself if none has."""

    languages: Sequence[str]
    into: str


@dataclass(frozen=True)
class AltLabels:
    """All alternative labels in the first language that has any, sorted, as one text, or NULL."""

    languages: Sequence[str]
    into: str


Part = Values | Fixed | Label | AltLabels


def _place(languages: Sequence[str]) -> Column:
    return F.array_position(F.array(*[F.lit(language) for language in languages]), F.col("lang"))


def _one_of(name: str, nodes: Sequence[str]) -> Column:
    return F.coalesce(F.col(name).isin(list(nodes)), F.lit(False))


def _every_part() -> Column:
    return F.array(*[F.lit(i) for i in range(FANOUT)])


def _key(name: str, *parts: str) -> Column:
    """A node and its parts as one text, so that one partitioning serves the aggregate and the join."""
    return F.concat_ws("\u0000", name, *parts) if parts else F.col(name)


def with_labels(rows: DataFrame, graph: TripleGraph, languages: Sequence[str], node: str, hot: Sequence[str]) -> DataFrame:
    """`rows` with `_label` of a node that is never NULL; rows of hot nodes are dealt out, their labels copied."""
    labels = graph.triples.where((F.col("p") == LABEL) & F.col("lang").isin(list(languages))).select("s", "o", "lang")
    parts = []
    if hot:
        parts = ["_deal"]
        rows = rows.withColumn("_deal", F.when(_one_of(node, hot), row_part(rows, FANOUT)).otherwise(F.lit(0)))
        labels = labels.withColumn("_deal", F.explode(F.when(_one_of("s", hot), _every_part()).otherwise(F.array(F.lit(0)))))
    best = F.min_by("o", F.struct(_place(languages), F.col("o"))).alias("_label")
    lookup = labels.groupBy(_key("s", *parts).alias("_object")).agg(best)
    joined = rows.withColumn("_object", _key(node, *parts)).join(lookup, "_object", "left")
    return joined.drop("_object", "_deal").withColumn("_label", F.coalesce("_label", node))


def _is(part: Part) -> Column:
    """Whether a triple belongs to a part."""
    if isinstance(part, Values):
        return F.col("p") == part.predicate
    if isinstance(part, Fixed):
        return (F.col("p") == part.predicate) & (F.col("o") == part.value)
    predicate = LABEL if isinstance(part, Label) else ALT_LABEL
    return (F.col("p") == predicate) & F.col("lang").isin(list(part.languages))


def _gathered(part: Part) -> Column:
    """What the triples of one node give for a part."""
    mine = _is(part)
    if isinstance(part, Values):
        fields = [F.col("o").alias("o"), *([F.col("_label").alias("label")] if part.label_into else [])]
        return F.collect_list(F.when(mine, F.struct(*fields)))
    if isinstance(part, Fixed):
        return F.bool_or(F.coalesce(mine, F.lit(False)))
    place = _place(part.languages)
    if isinstance(part, Label):
        return F.min_by(F.when(mine, F.col("o")), F.when(mine, F.struct(place, F.col("o"))))
    return F.collect_set(F.when(mine, F.struct(place.alias("place"), F.col("o").alias("o"))))


def _one_text(labels: str) -> Column:
    first = F.array_min(F.transform(labels, lambda x: x["place"]))
    texts = F.transform(F.filter(labels, lambda x: x["place"] == first), lambda x: x["o"])
    return F.when(F.size(labels) > 0, F.array_join(F.array_sort(texts), ", "))


def _facts(graph: TripleGraph, parts: Sequence[Part], names: TripleGraph) -> DataFrame:
    """The triples that the parts ask for; objects whose label is wanted have it beside them."""
    labelled = [p for p in parts if isinstance(p, Values) and p.label_into]
    wanted = _is(parts[0])
    for part in parts[1:]:
        wanted = wanted | _is(part)
    facts = graph.triples.where(wanted).select("s", "p", "o", "lang")
    if not labelled:
        return facts
    languages = {tuple(p.languages) for p in labelled}
    if len(languages) > 1:
        raise ValueError("labels of objects have to be in the same languages")
    among = F.col("p").isin([p.predicate for p in labelled])
    hot = [v for p in labelled for v in graph.hot_objects(p.predicate)]
    objects = with_labels(facts.where(among), names, languages.pop(), "o", list(dict.fromkeys(hot)))
    objects = objects.select("s", "p", "o", "lang", "_label")
    others = facts.where(~among).withColumn("_label", F.lit(None).cast("string"))
    return objects.unionAll(others)


def star_match(
    rows: DataFrame, graph: TripleGraph, on: str, *parts: Part, names: TripleGraph | None = None
) -> DataFrame:
    """`rows` with all `parts` of the node in column `on`, rows multiplied as by one join after the other.

    The triples of a node are gathered in one aggregate, which combines before its shuffle, and joined
    once; then each list is unfolded, so no join follows another. A node with very many objects of
    one predicate is not gathered as a whole: these are dealt to FANOUT parts, what else it has is
    copied to each, and so are the rows that hold it. Rows of a node that very many rows hold are dealt
    out likewise, and what is gathered is copied. Parts are in the key that is aggregated and joined by, so
    hot nodes add no shuffle. A list that is not hot has at most the rows from which on nodes are hot.
    `names` is the graph in which labels of objects are looked up.

    Rows whose node is NULL or has no triples stay if nothing is required.
    """
    facts = _facts(graph, parts, names or graph)
    values = [p for p in parts if isinstance(p, Values)]
    # Of a node with several such predicates the first is dealt out.
    dealt: dict[str, str] = {}
    for part in values:
        for node in graph.hot_subjects(part.predicate):
            dealt.setdefault(node, part.predicate)
    held = {v for (_, side), nodes in graph.hot.items() if side == "o" for v in nodes}
    # What the rows hold is told apart from the parts by a struct of its own.
    columns = rows.columns
    whole = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row")
    keyed = rows.select(F.col(f"`{on}`").alias("_node"), whole, row_part(rows, FANOUT).alias("_hash"))
    keys, one = [], F.array(F.lit(0))
    facts = facts.withColumn("_chosen", F.lit(True))
    if dealt:
        keys.append("_dealt")
        chosen = F.lit(False)
        for predicate in set(dealt.values()):
            nodes = [n for n, p in dealt.items() if p == predicate]
            chosen = chosen | ((F.col("p") == predicate) & F.col("s").isin(nodes))
        own = F.array(F.pmod(F.xxhash64("o", "lang"), F.lit(FANOUT)).cast("int"))
        places = F.when(chosen, own).when(_one_of("s", dealt), _every_part()).otherwise(one)
        # A place without objects of the predicate dealt out is no match of its node.
        facts = facts.withColumns({"_chosen": chosen | ~_one_of("s", dealt), "_dealt": F.explode(places)})
        keyed = keyed.withColumn("_dealt", F.explode(F.when(_one_of("_node", dealt), _every_part()).otherwise(one)))
    if held:
        keys.append("_held")
        facts = facts.withColumn("_held", F.explode(F.when(_one_of("s", held), _every_part()).otherwise(one)))
        keyed = keyed.withColumn("_held", F.when(_one_of("_node", held), F.col("_hash")).otherwise(F.lit(0)))
    gathered = facts.groupBy(_key("s", *keys).alias("_star")).agg(
        *[_gathered(p).alias(f"_part{n}") for n, p in enumerate(parts)], F.bool_or("_chosen").alias("_found")
    )
    if dealt:
        gathered = gathered.where("_found")
    needed = False
    for n, part in enumerate(parts):
        if isinstance(part, Fixed):
            gathered, needed = gathered.where(f"_part{n}").drop(f"_part{n}"), True
        elif isinstance(part, Values) and part.required:
            gathered, needed = gathered.where(F.size(f"_part{n}") > 0), True
    star = F.when(F.col("_node").isNotNull(), _key("_node", *keys)).alias("_star")
    joined = keyed.select(star, "_row").join(gathered, "_star", "inner" if needed else "left")
    if dealt and not needed:
        joined = joined.where(~_one_of(f"_row.`{on}`", dealt) | F.col("_found"))
    found = {c: F.col(f"_row.`{c}`") for c in columns}
    for n, part in enumerate(parts):
        if isinstance(part, Label):
            found[part.into] = F.coalesce(F.col(f"_part{n}"), F.col(f"_row.`{on}`"))
        elif isinstance(part, AltLabels):
            found[part.into] = _one_text(f"_part{n}")
        elif isinstance(part, Values):
            unfold = F.explode if part.required else F.explode_outer
            # Computed columns are carried as they are; only the list is unfolded.
            rest = [c for c in joined.columns if c != f"_part{n}"]
            joined = joined.select(*rest, unfold(f"_part{n}").alias(f"_value{n}"))
            if part.into:
                found[part.into] = F.col(f"_value{n}.o")
            if part.label_into:
                found[part.label_into] = F.col(f"_value{n}.label")
    return joined.select(*[c.alias(name) for name, c in found.items()])


def article_parts(language: str, site: str, with_name: bool) -> list[Part]:
    """What is asked about an article: its language, its site, and its name if wanted."""
    parts: list[Part] = [Fixed(IN_LANGUAGE, language), Fixed(IS_PART_OF, site)]
    return [*parts, Values(NAME, "name", required=True)] if with_name else parts


def bgp_join(
    entities: DataFrame,
    graph: TripleGraph,
    on: str = "id",
    language: str = ARTICLE_LANGUAGE,
    site: str = ARTICLE_SITE,
    with_name: bool = True,
) -> DataFrame:
    """Join entities with their articles of one language and site, and the articles' names."""
    articles = entity_articles(entities, graph, on)
    near = graph.within(articles, "article")
    return star_match(articles, near, "article", *article_parts(language, site, with_name))
