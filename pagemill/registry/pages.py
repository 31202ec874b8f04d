"""Page responses, page text and the page tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemill import functions as fn
from pagemill import operators as op
from pagemill import plans
from pagemill import sources as src
from pagemill.constants import PARAGRAPH_BREAKERS
from pagemill.functions.html import NAMED_CHARACTERS, OPEN_NAMES
from pagemill.registry import fixtures as fx
from pagemill.registry.base import joined_lists, query, sql_text
from pagemill.schemas import LIST_COLUMNS
from pagemill.streaming import fetch_resumable

_NAMES = ", ".join(f"{sql_text(name)}: chr({ord(c)})" for name, c in NAMED_CHARACTERS.items())


# Patterns of the SQL alone: what counts as markup here does not follow the code that is compared.
QUOTED_SQL = "[^\\s/>=]*\\s*=\\s*(?:\"[^\"]*(?:\"|$)|'[^']*(?:'|$))"
INSIDE_SQL = f"(?:[\\s/](?:{QUOTED_SQL}|[^\\s/>]+|[\\s/])*)?"
TAGS_SQL = (
    f"(?is)(<!--.*?(?:-->|$))|(<script){INSIDE_SQL}(>.*?(?:</script\\s*>|$)|$)"
    f"|(<style){INSIDE_SQL}(>.*?(?:</style\\s*>|$)|$)|(</?[a-z][^\\s/>]*){INSIDE_SQL}(>|$)"
)
RAW_SQL = "(?is)<(script|style)(?:>|$).*?(?:</(?:script|style)\\s*>|$)|<!--.*?(?:-->|$)"
OPEN_SQL = "|".join(sorted(OPEN_NAMES, key=len, reverse=True))
BLOCKS_SQL = "|".join(sorted(PARAGRAPH_BREAKERS))


def held_sql(html: str) -> str:
    """Markup without comments, with script and style content written as references between gaps."""
    raw = sql_text(RAW_SQL)
    content = "regexp_replace(regexp_replace(z[2], '(?is)^<(script|style)[^>]*>?', ''), '(?is)</(script|style)\\s*>$', '')"
    element = (
        "CASE WHEN z[2] IS NULL THEN '' WHEN starts_with(z[2], '<!--') THEN '<!>'"
        f" ELSE '<!>' || replace(replace({content}, '&', '&amp;'), '<', '&lt;') || '<!>' END"
    )
    html = f"regexp_replace({html}, {sql_text(TAGS_SQL)}, '\\1\\2\\3\\4\\5\\6\\7', 'g')"
    pairs = f"list_zip(string_split_regex({html}, {raw}), regexp_extract_all({html}, {raw}))"
    return f"array_to_string(list_transform({pairs}, lambda z: z[1] || {element}), '')"


def decoded_sql(text: str) -> str:
    """Text with character references replaced."""
    code = (
        "CASE WHEN lower(q.r[1:2]) = '#x' THEN TRY_CAST('0x' || ltrim(q.r[3:], '0') AS BIGINT)"
        " WHEN q.r[1:1] = '#' THEN TRY_CAST(q.r[2:] AS BIGINT) END"
    )
    character = (
        f"CASE WHEN q.r[1:1] <> '#' THEN MAP {{{_NAMES}}}[q.r]"
        f" WHEN ({code}) BETWEEN 1 AND 55295 OR ({code}) BETWEEN 57344 AND 1114111"
        f" THEN chr(CAST({code} AS INTEGER)) END"
    )
    tails = (
        f"list_transform(string_split({text}, '&')[2:],"
        " lambda p: {'p': p, 'r': rtrim(regexp_extract(p, '^(#\\d+|#[xX][[:xdigit:]]+|[[:alpha:]][[:alnum:]]+;)', 1), ';'),"
        f" 'o': regexp_extract(p, '^({OPEN_SQL})', 1)}})"
    )
    decoded = (
        f"list_transform({tails}, lambda q: coalesce(({character}) || regexp_replace(q.p[length(q.r) + 1:], '^;', ''),"
        f" MAP {{{_NAMES}}}[q.o] || regexp_replace(q.p[length(q.o) + 1:], '^;', ''), '&' || q.p))"
    )
    return f"(string_split({text}, '&')[1] || array_to_string({decoded}, ''))"


def paragraphs_sql(html: str) -> str:
    """Texts between the tags of all paragraphs, the first of each after a blank."""
    end = f"'(?is)</?({BLOCKS_SQL})(\\s[^>]*|/[^>]*)?(>|$).*'"
    between = f"string_split_regex(' ' || regexp_replace(p, {end}, ''), '(?s)<(/?[A-Za-z]|[!?])[^>]*(>|$)')"
    pieces = f"string_split_regex({held_sql(html)}, '(?i)<p(\\s[^>]*|/[^>]*)?(>|$)')[2:]"
    return f"flatten(list_transform({pieces}, lambda p: {between}))"


def page_text_sql(html: str) -> str:
    texts = f"list_transform({paragraphs_sql(html)}, lambda e: {decoded_sql('e')})"
    return f"replace(array_to_string({texts}, ''), chr(10), '.')"


LANG = "regexp_extract(html, '<html lang=\"([a-z]+)\"', 1)"
TARGET = "regexp_replace(url, '^http://', 'https://')"
CATEGORY = (
    f"'Pages in ' || {LANG} || CASE WHEN contains(url, '?') THEN ' | Disambiguation pages' ELSE '' END"
    " || CASE WHEN contains(url, '#') THEN ' | Disambiguation_pages' ELSE '' END"
)
LINKS = "array_to_string(regexp_extract_all(html, '<a href=\"/([^\"]*)\"', 1), ' | ')"
ORIGIN = "regexp_extract(url, '^(https?://[^/]+)', 1)"
SECTIONS = "array_to_string(regexp_extract_all(html, '(?:<h1>|<b>)([^<]*)', 1), ' | ')"
REDIRECT = f"CASE WHEN starts_with(url, 'http://') THEN {TARGET} END"
WHOLE = "ends_with(html, '</html>')"

EXTRACTED = (
    f"SELECT page_id AS number, url, {LANG} AS lang, CAST(page_id AS VARCHAR) AS page_id, url AS page_title,"
    f" {page_text_sql('html')} AS page_text, {CATEGORY} AS category, {LINKS} AS links,"
    f" {ORIGIN} AS external_links, {SECTIONS} AS sections, {REDIRECT} AS redirects_page FROM pages WHERE {WHOLE}"
)
PAGE_COLUMNS = "page_id, page_title, page_text, category, links, external_links, sections, redirects_page"


def _parsed(spark, sf_dir):
    return src.load_parse_responses(fx.responses(spark, sf_dir))


def _lists(df):
    return joined_lists(df, *LIST_COLUMNS)


@query("paragraph_text", f"SELECT page_id, {page_text_sql('html')} AS page_text FROM pages")
def _(spark, sf_dir):
    return fx.page_table(spark, sf_dir).select("page_id", fn.paragraph_text("html").alias("page_text"))


@query("paragraph_text_parser", f"SELECT page_id, {page_text_sql('html')} AS page_text FROM pages")
def _(spark, sf_dir):
    # The parser is an independent check, in tests only.
    text = fn.paragraph_text("html")
    return fx.page_table(spark, sf_dir).select("page_id", text.alias("page_text"))


@query("decode_entities", f"SELECT page_id, {decoded_sql('html')} AS html FROM pages")
def _(spark, sf_dir):
    return fx.page_table(spark, sf_dir).select("page_id", fn.decode_entities("html").alias("html"))


@query("load_parse_responses", f"SELECT url AS title, {WHOLE} AS found, CASE WHEN {WHOLE} THEN {TARGET} END AS resolved FROM pages")
def _(spark, sf_dir):
    return _parsed(spark, sf_dir).select(
        "title", F.col("parse").isNotNull().alias("found"), F.col("parse.title").alias("resolved")
    )


@query("parse_ok", f"SELECT url AS title FROM pages WHERE {WHOLE}")
def _(spark, sf_dir):
    return op.parse_ok(_parsed(spark, sf_dir)).select("title")


@query("visible_categories", f"SELECT url AS title, CASE WHEN {WHOLE} THEN {CATEGORY} END AS category FROM pages")
def _(spark, sf_dir):
    categories = fn.visible_categories("parse.categories").alias("category")
    return joined_lists(_parsed(spark, sf_dir).select("title", categories), "category")


@query("link_titles", f"SELECT url AS title, CASE WHEN {WHOLE} THEN {LINKS} END AS links FROM pages")
def _(spark, sf_dir):
    links = fn.link_titles("parse.links").alias("links")
    return joined_lists(_parsed(spark, sf_dir).select("title", links), "links")


@query("external_links", f"SELECT url AS title, CASE WHEN {WHOLE} THEN {ORIGIN} END AS external_links FROM pages")
def _(spark, sf_dir):
    links = fn.external_links("parse").alias("external_links")
    return joined_lists(_parsed(spark, sf_dir).select("title", links), "external_links")


@query("section_names", f"SELECT url AS title, CASE WHEN {WHOLE} THEN {SECTIONS} END AS sections FROM pages")
def _(spark, sf_dir):
    sections = fn.section_names("parse.sections").alias("sections")
    return joined_lists(_parsed(spark, sf_dir).select("title", sections), "sections")


@query(
    "first_redirect_target",
    f"SELECT url AS title, CASE WHEN {WHOLE} THEN {REDIRECT} END AS redirects_page FROM pages",
)
def _(spark, sf_dir):
    target = fn.first_redirect_target("parse.redirects").alias("redirects_page")
    return _parsed(spark, sf_dir).select("title", target)


@query(
    "page_id_and_title",
    f"SELECT CAST(page_id AS VARCHAR) AS page_id, url AS requested, {TARGET} AS resolved FROM pages WHERE {WHOLE}",
)
def _(spark, sf_dir):
    return op.parse_ok(_parsed(spark, sf_dir)).select(
        fn.page_id("parse").alias("page_id"),
        fn.page_title("title", "parse").alias("requested"),
        fn.page_title("title", "parse", "resolved").alias("resolved"),
    )


@query("extract_pages", f"SELECT {PAGE_COLUMNS} FROM ({EXTRACTED})")
def extract_pages(spark, sf_dir):
    return _lists(plans.extract_pages(fx.responses(spark, sf_dir)))


@query(
    "extract_pages_without_disambiguation",
    f"SELECT {PAGE_COLUMNS} FROM ({EXTRACTED}) WHERE NOT contains(url, '?') AND NOT contains(url, '#')",
)
def _(spark, sf_dir):
    return _lists(plans.extract_pages(fx.responses(spark, sf_dir), without_disambiguation=True))


@query(
    "extract_page_info",
    f"SELECT e.page_id, {TARGET.replace('url', 'e.url')} AS page_title, e.page_text, e.category AS categories,"
    " e.links, e.external_links, e.sections, e.redirects_page AS redirects"
    f" FROM pages LEFT JOIN ({EXTRACTED}) e ON e.number = pages.page_id",
)
def _(spark, sf_dir):
    info = plans.extract_page_info(fx.responses(spark, sf_dir))
    return joined_lists(info, "categories", "links", "external_links", "sections")


GAME_SOURCES = f"""
    SELECT 0 AS source, 'Q' || copy || '-' || page_id AS id, url, copy, page_id FROM pages, (VALUES (0), (1)) c(copy)
    WHERE {LANG} = 'de'
    UNION ALL SELECT 1, 'S' || copy || '-' || page_id, url, copy, page_id FROM pages, (VALUES (0), (1)) c(copy)
    WHERE url LIKE '%.com/%?%'
    UNION ALL SELECT 2, 'M' || copy || '-' || page_id, url, copy, page_id FROM pages, (VALUES (0), (1)) c(copy)
    WHERE {LANG} = 'es'"""


GAME_PAGES = f"""SELECT e.page_id, page_title, page_text, category, links, external_links, sections, redirects_page,
    g.id AS wikidata_id FROM ({EXTRACTED}) e JOIN (
        SELECT *, row_number() OVER (PARTITION BY url ORDER BY source, copy, page_id) AS nth
        FROM ({GAME_SOURCES})
    ) g ON g.url = e.url AND g.nth = 1"""


def _game_pages(spark, sf_dir, **options):
    sources, responses = fx.game_sources(spark, sf_dir), fx.responses(spark, sf_dir)
    return _lists(plans.build_game_pages(sources, responses, ["copy", "pos"], **options))


@query("build_game_pages", GAME_PAGES)
def _(spark, sf_dir):
    return _game_pages(spark, sf_dir)


@query("build_game_pages_large", GAME_PAGES)
def _(spark, sf_dir):
    """The same with names that count as too many to copy: bodies go through a Bloom filter and a shuffle."""
    return _game_pages(spark, sf_dir, limit=0)


GAME_TITLES = f"SELECT url FROM pages WHERE {LANG} = 'de' AND {WHOLE}"
NONGAMES = f"""
    SELECT url FROM pages WHERE url NOT LIKE '%#%' AND url NOT LIKE 'http://%'
        AND url NOT IN ({GAME_TITLES})
    ORDER BY md5('42:' || url), url LIMIT (SELECT count(*) FROM ({GAME_TITLES}))"""


NONGAME_SAMPLE = (
    "SELECT coalesce(redirects_page, page_title) AS page_title, page_text, category, links, external_links,"
    f" sections FROM ({EXTRACTED}) WHERE url IN ({NONGAMES})"
)


def _nongame_sample(spark, sf_dir, **options):
    games = fx.table(spark, sf_dir, "pages").where(f"{fx.PAGE_LANG} = 'de' and endswith(html, '</html>')")
    titles, listing = games.selectExpr("url as page_title"), fx.page_listing(spark, sf_dir)
    return _lists(plans.build_nongame_sample(listing, titles, fx.responses(spark, sf_dir), **options))


@query("build_nongame_sample", NONGAME_SAMPLE)
def _(spark, sf_dir):
    return _nongame_sample(spark, sf_dir)


@query("build_nongame_sample_large", NONGAME_SAMPLE)
def _(spark, sf_dir):
    return _nongame_sample(spark, sf_dir, limit=0)


@query(
    "page_metrics",
    "SELECT (SELECT count(*) FROM pages) AS responses, CAST(0 AS BIGINT) AS no_body, count(*) AS pages,"
    " count_if(page_text = '') AS no_text, CAST(sum(length(page_text)) AS BIGINT) AS chars,"
    f" (SELECT count(*) FROM pages) - count(*) AS dropped FROM ({EXTRACTED})",
)
def _(spark, sf_dir):
    pages, metrics = plans.metered_pages(fx.responses(spark, sf_dir))
    src.write_table(pages, src.work_path(spark, "pages"))
    counts = metrics.get()
    return spark.createDataFrame([tuple(counts.values())], ", ".join(f"{name} bigint" for name in counts))


def _get(url: str) -> str:
    if "#" in url:
        raise ValueError(f"no fragment allowed: {url}")
    return f"GET {url}"


@query(
    "fetch_map",
    "SELECT url, CASE WHEN NOT contains(url, '#') THEN 'GET ' || url END AS body,"
    " CASE WHEN contains(url, '#') THEN 'ValueError: no fragment allowed: ' || url END AS error FROM pages",
)
def _(spark, sf_dir):
    return src.fetch_map(fx.page_table(spark, sf_dir), "url", _get)


@query(
    "fetch_resumable",
    "SELECT DISTINCT url, CASE WHEN NOT contains(url, '#') THEN 'GET ' || url END AS body,"
    " CASE WHEN contains(url, '#') THEN 'ValueError: no fragment allowed: ' || url END AS error,"
    " CASE WHEN contains(url, '#') THEN 2 ELSE 1 END AS attempt FROM pages",
)
def _(spark, sf_dir):
    pages, folder = fx.page_table(spark, sf_dir), src.work_path(spark, "fetch")
    # A shorter list first; the second run fetches the rest, and once more what failed.
    fetch_resumable(pages.where(F.col("url").startswith("http://")), "url", _get, folder)
    return fetch_resumable(pages, "url", _get, folder, attempts=2)


@query(
    "content_lengths",
    f"SELECT url, CASE WHEN {WHOLE} THEN length(html) END AS length,"
    f" CASE WHEN NOT {WHOLE} THEN 'ValueError: page is cut off' END AS error FROM pages",
)
def _(spark, sf_dir):
    def reply(url: str, html: str) -> str:
        fx.page_reply(url, html)
        return html

    fetched = src.fetch_map(fx.page_table(spark, sf_dir), "url", reply, inputs=("html",))
    return plans.content_lengths(fetched)


CHUNKED = (
    f"SELECT CAST(length(html) AS VARCHAR) AS page_id, url AS page_title, {page_text_sql('html')} AS page_text,"
    " 'Articles' AS category, '' AS links, url AS external_links, '' AS sections,"
    f" CAST(NULL AS VARCHAR) AS redirects_page FROM pages WHERE {WHOLE} AND NOT contains(url, '?')"
)


def _listed(spark, sf_dir):
    return fx.page_table(spark, sf_dir).select(fn.format_line("page_id", "url").alias("value"), "html")


@query("build_pages_chunked", CHUNKED)
def _(spark, sf_dir):
    return _lists(plans.build_pages_chunked(_listed(spark, sf_dir), fx.page_reply, inputs=("html",)))


@query("build_pages_in_100_chunks", CHUNKED)
def _(spark, sf_dir):
    pages = plans.build_pages_chunked(_listed(spark, sf_dir), fx.page_reply, chunks=100, inputs=("html",))
    return _lists(pages)
