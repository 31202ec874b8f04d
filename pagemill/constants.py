"""Fixed values. They name the data's own vocabulary, so they must be spelled exactly like this."""

# Entity, class and property identifiers of the graph.
ENTITY_PREFIX = "http://www.wikidata.org/entity/"
GAME_CLASS = "Q7889"
GAME_SERIES_CLASS = "Q7058673"
INSTANCE_OF = "P31"
SUBCLASS_OF = "P279"
GENRE = "P136"
PUBLISHER = "P123"
RATING = "P852"
SERIES = "P179"
ABOUT = "schema:about"
IN_LANGUAGE = "schema:inLanguage"
NAME = "schema:name"
IS_PART_OF = "schema:isPartOf"
LABEL = "rdfs:label"
ALT_LABEL = "skos:altLabel"

# Article language and site that the graph queries ask for.
ARTICLE_LANGUAGE = "en"
ARTICLE_SITE = "https://en.wikipedia.org/"

# Categories that mark a page as a disambiguation page (exact, case-sensitive).
DISAMBIGUATION_CATEGORIES = ("Disambiguation_pages", "Disambiguation pages")

# Separators of the listing files. Category files may use either form.
TITLE_SEPARATOR = "; "
CATEGORY_SEPARATOR = ";"

# HTML elements whose start or end tag ends an open paragraph.
PARAGRAPH_BREAKERS = (
    "p", "div", "article", "section", "nav", "header", "footer", "main", "aside",
    "ul", "ol", "li", "dl", "dt", "dd", "table", "caption", "tr", "td", "th",
    "tbody", "thead", "tfoot", "h1", "h2", "h3", "h4", "h5", "h6", "pre", "form",
    "hr", "blockquote", "center", "body", "html", "address", "fieldset",
)
