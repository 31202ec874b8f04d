"""The three graph queries: games, game series, and games that belong to a series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.constants import (
    ARTICLE_LANGUAGE,
    ARTICLE_SITE,
    GAME_CLASS,
    GAME_SERIES_CLASS,
    GENRE,
    PUBLISHER,
    RATING,
    SERIES,
)
from pagemill.operators import (
    AltLabels,
    Label,
    TripleGraph,
    Values,
    article_parts,
    entity_articles,
    instance_of_closure,
    star_match,
)

_OPTIONAL = {"genre": GENRE, "publisher": PUBLISHER, "esrb": RATING}


def games_query(
    graph: TripleGraph,
    target: str = GAME_CLASS,
    languages: Sequence[str] = ("en",),
    language: str = ARTICLE_LANGUAGE,
    site: str = ARTICLE_SITE,
) -> DataFrame:
    """Entities of a class with optional genre, publisher and rating, their article and labels.

    Rows multiply over the values of the optional parts and over the articles.
    """
    articles = entity_articles(instance_of_closure(graph, target), graph)
    near = graph.within(articles, "id", "article")
    rows = star_match(articles, near, "article", *article_parts(language, site, with_name=True))
    values = near.triples.where(F.col("p").isin(list(_OPTIONAL.values())))
    optional = [Values(p, label_into=f"{node}Label", languages=languages) for node, p in _OPTIONAL.items()]
    # Everything about the entity comes together, with the labels of its objects.
    rows = star_match(
        rows, near, "id", Label(languages, "idLabel"), AltLabels(languages, "idAltLabel"), *optional,
        names=graph.within(values, "o"),
    )
    return rows.select(
        "id", "idLabel", "genreLabel", "publisherLabel", "esrbLabel", "idAltLabel", "name", "article"
    )


def series_query(
    graph: TripleGraph,
    target: str = GAME_SERIES_CLASS,
    languages: Sequence[str] = ("en",),
    language: str = ARTICLE_LANGUAGE,
    site: str = ARTICLE_SITE,
) -> DataFrame:
    """As `games_query` for series; put the reader's own language first in `languages`."""
    return games_query(graph, target, languages, language, site)


def mapping_query(
    graph: TripleGraph,
    target: str = GAME_CLASS,
    languages: Sequence[str] = ("en",),
    language: str = ARTICLE_LANGUAGE,
    site: str = ARTICLE_SITE,
) -> DataFrame:
    """Games with a series, once per series and article. The optional labels are never bound."""
    articles = entity_articles(instance_of_closure(graph, target), graph)
    near = graph.within(articles, "id", "article")
    rows = star_match(articles, near, "article", *article_parts(language, site, with_name=False))
    series = Values(SERIES, required=True)
    rows = star_match(rows, near, "id", Label(languages, "idLabel"), AltLabels(languages, "idAltLabel"), series)
    unbound = [F.lit(None).cast("string").alias(f"{node}Label") for node in _OPTIONAL]
    return rows.select("id", "idLabel", *unbound, "idAltLabel", "article")
