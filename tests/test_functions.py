import ast
import re
from random import Random

import pytest
from pyspark.sql import functions as F

from pagemill import functions as fn
from pagemill.constants import ENTITY_PREFIX
from pagemill.functions.html_parser import text_of_paragraphs
from pagemill.schemas import PARSE_RESPONSE


def apply(spark, function, values, schema="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {schema}")
    return [r[0] for r in rows.orderBy("i").select(function("v")).collect()]


def test_title_from_line(spark):
    lines = ["12; A title\n", "12; cut; here", "no separator", "7;  \t padded  ", None]
    assert apply(spark, fn.title_from_line, lines) == ["A title", "cut", None, "padded", None]
    kept = apply(spark, lambda c: fn.title_from_line(c, keep_rest=True), lines)
    assert kept == ["A title", "cut; here", None, "padded", None]


def test_category_fields(spark):
    lines = ["10; 7; 2; 1; Some name", "10;7;2;1;Some; name", "x;7;2;1;N", "1;2"]
    rows = [tuple(r) for r in apply(spark, fn.category_fields, lines)]
    assert rows == [
        ("Some name", 10, 7, 1, 2), ("Some", 10, 7, 1, 2), ("N", None, 7, 1, 2), (None, 1, 2, None, None),
    ]
    whole = apply(spark, lambda c: fn.category_fields(c, keep_rest=True), lines[1:2])[0]
    assert whole["category"] == "Some; name"


def test_parse_list_literal(spark):
    texts = ["['a', 'b']", "[]", "[\"Assassin's\", 'x, y']", None, "['[1]']"]
    expected = [["a", "b"], [""], ['"Assassins"', "x", "y"], None, ["[1]"]]
    assert apply(spark, fn.parse_list_literal, texts) == expected


LISTS = [
    [], ["a"], ["a", "b"], ["it's"], ['say "x"'], ["it's \"x\""], ["back\\slash's"], ["x, y", ""],
    ["line\nbreak", "tab\t", "return\r"], ["é", "日本"], None, ["a", None],
]


def test_to_list_literal_is_repr(spark):
    texts = apply(spark, fn.to_list_literal, LISTS, "array<string>")
    assert texts == [None if items is None else repr(items) for items in LISTS]
    assert all(ast.literal_eval(t) == i for t, i in zip(texts, LISTS) if t)


def test_literal_round_trip_for_plain_items(spark):
    lists = [["a"], ["a b", "c"], ["[x]y", "z"], ["é", "ü", "1"]]
    texts = apply(spark, fn.to_list_literal, lists, "array<string>")
    assert apply(spark, fn.parse_list_literal, texts) == lists


def test_entity_prefix_and_newlines(spark):
    ids = [ENTITY_PREFIX + "Q42", "Q1", None]
    assert apply(spark, fn.strip_entity_prefix, ids) == ["Q42", "Q1", None]
    assert apply(spark, fn.newline_to_dot, ["a\nb\n", "", None]) == ["a.b.", "", None]


def test_casts_and_square(spark):
    assert apply(spark, fn.cast_int, [" 12", "7\n", "x", "", None]) == [12, 7, None, None, None]
    assert apply(spark, fn.square, [1, 2, 3, 10], "int") == [1, 4, 9, 100]
    assert apply(spark, fn.content_length, ["", "é日", None]) == [0, 2, None]


def test_format_line(spark):
    row = spark.createDataFrame([(5, None, "t")], "a int, b string, c string")
    assert row.select(fn.format_line("a", "b", "c")).first()[0] == "5; ; t"
    assert row.select(fn.format_line("a", "c", sep=";")).first()[0] == "5;t"


def test_decode_entities(spark):
    texts = [
        "plain", "&amp;lt;", "&lt;&gt;&quot;&#39;&nbsp;&copy;&middot;", "&#91;1&#93;", "&#x1F600;&#X41;",
        "&unknown; & &amp &;", "&ndash;&eacute;&apos;", "&#0;&#xD800;&#9999999;", "", None, "a&",
    ]
    assert apply(spark, fn.decode_entities, texts) == [
        "plain", "&lt;", "<>\"' ©·", "[1]", "😀A", "&unknown; & & &;", "–é'",
        "&#0;&#xD800;&#9999999;", "", None, "a&",
    ]


PAGES = {
    "<p>one</p><p>two</p>": " one two",
    "<p>open<p>next\nline": " open next.line",
    "<div>no paragraph</div>": "",
    "": "",
    "<P CLASS='x'>upper</P> outside <pre>no</pre>": " upper",
    "<p>a <b>bold</b> <a href='/x'>link</a></p>": " a bold link",
    "<p>cut by list<ul><li>item</li></ul>after": " cut by list",
    "<li><p>in item</li><li>plain</li>": " in item",
    "<p>a<!-- <p>hidden</p> -->b</p>": " ab",
    '<script>var t="</p><p>";</script><p>real</p>': " real",
    '<p>x<script>if (a<b && c) t="</p>";</script>y</p>': ' xif (a<b && c) t="</p>";y',
    "<p>x<style>p{a:b}</style>y</p>": " xp{a:b}y",
    "<p>&lt;p&gt; &amp;amp; 1 < 2</p>": " <p> &amp; 1 < 2",
    "<p></p><p/>": "  ",
    "<param>x</param><picture>y</picture>": "",
    "<p>text<br>more<br/>end</p>": " textmoreend",
    "<p>tail <a href": " tail ",
}


def test_paragraph_text(spark):
    assert apply(spark, fn.paragraph_text, list(PAGES)) == list(PAGES.values())
    assert apply(spark, fn.paragraph_text, [None]) == [None]


def test_paragraph_text_parser(spark):
    parse = lambda c: fn.paragraph_text(c, engine="parser")
    same = [h for h in PAGES if h != "<p>tail <a href"]
    assert apply(spark, parse, same) == [PAGES[h] for h in same]
    assert text_of_paragraphs(None) is None
    with pytest.raises(ValueError):
        fn.paragraph_text("v", engine="other")


# Pages made to be misread, with texts written by hand.
HARD_PAGES = {
    "<p>a\u0001b\u0002c</p>": " a\u0001b\u0002c",
    "<p>a &#1;b&#2; c</p>": " a \u0001b\u0002 c",
    "<p>&#0000000065;&#x000000041;&#00000000038;lt;</p>": " AA&lt;",
    "<p>&#x110000;&#99999999999999999999;&#0;</p>": " &#x110000;&#99999999999999999999;&#0;",
    "<p>&l<b>t;</b>x&l<!-- c -->t;</p>": " &lt;x&lt;",
    "<p>&<script>lt; &lt; &amp;lt; <b></script>gt;</p>": " &lt; &lt; &amp;lt; <b>gt;",
    "<p>x<script>a && b</script>&amp;<style>&#65;</style></p>": " xa && b&&#65;",
    "<p>&amp;#65; &AMP &unknown; &é;</p>": " &#65; & &unknown; &é;",
    "<p>&notin; &notit; &ampamp; &copy2 &#65x &#x41;&#x42 &thetasym &theta</p>": " ∉ ¬it; &amp; ©2 Ax AB &thetasym &theta",
    """<p title="a > b" data-x='<p>'>one <a href="x>y" title='</p>'>two</a></p> out""": " one two",
    """<a title="<p>no</p>">x</a><p>yes<img alt="1 > 0"/>!</p>""": " yes!",
    """<p>it's <b title=it's>not</b> a 'quote > here'</p>""": " it's not a 'quote > here'",
    """<p a = "x>" b='>' c=d"e>text</p>""": " text",
    """<p><script data-x="</script>">a="<p b='";</script>c</p>""": """ a="<p b='";c""",
    """<!-- <p title="> --><p>after "</p>""": ' after "',
    """<p><scripted>a</scripted>b</p>""": " ab",
    """<p>lost <a title="never closed>x</p>""": " lost ",
}


def test_hard_pages(spark):
    assert apply(spark, fn.paragraph_text, list(HARD_PAGES)) == list(HARD_PAGES.values())


def test_hard_pages_agree_with_the_parser(spark):
    # The parser replaces numbers that are no characters, knows more names, and keeps a tag that is never closed.
    same = [h for h in HARD_PAGES if "x110000" not in h and "&thetasym" not in h and "&#1;" not in h and "never" not in h]
    assert apply(spark, lambda c: fn.paragraph_text(c, engine="parser"), same) == [HARD_PAGES[h] for h in same]


def plain_tags(html):
    """The markup without attributes, letter by letter as a tokeniser of tags goes; no comments or scripts."""
    out, state, quote, start = [], "text", "", 0
    for i, c in enumerate(html):
        blank = c in " \t\n\f\r"
        if state == "text":
            out.append(c)
            if c == "<" and re.match("/?[A-Za-z]", html[i + 1 : i + 3]):
                state, start = "name", i + 1
        elif state == "quoted":
            state = "inside" if c == quote else state
        elif c == ">":
            out.append(c)
            state = "text"
        elif state == "name":
            if blank or (c == "/" and i > start):
                state = "inside"
            else:
                out.append(c)
        elif state == "equals":
            if c in "'\"":
                state, quote = "quoted", c
            elif not blank:
                state = "value"
        elif state == "value":
            state = "inside" if blank else state
        elif state == "attribute":
            state = "equals" if c == "=" else "named" if blank else "inside" if c == "/" else state
        elif state == "named" and c == "=":
            state = "equals"
        elif not blank:
            state = "inside" if c == "/" else "attribute"
    return "".join(out)


def test_tags_of_random_markup(spark):
    from pagemill.functions.html import without_attributes

    random = Random(3)
    parts = ["<a", "<b ", "</a", ">", '"', "'", "=", " ", "/", "x", "<", "\n", 'y="', "z='", "é", "< "]
    texts = ["".join(random.choices(parts, k=random.randint(1, 25))) for _ in range(4000)]
    assert apply(spark, without_attributes, texts) == [plain_tags(t) for t in texts]


BODY = """{"parse": {"pageid": 7, "title": "Resolved", "categories": [
  {"sortkey": "", "*": "Shown"}, {"*": "Hidden", "hidden": ""}, {"*": "Hidden too", "hidden": null}],
  "links": [{"ns": 0, "*": "B"}, {"ns": 14, "*": "A"}, {"ns": 0, "*": "B"}], "externallinks": ["http://x"],
  "sections": [{"line": "One", "index": "1"}, {"line": "Two"}],
  "redirects": [{"from": "a", "to": "b"}, {"from": "b", "to": "c"}], "text": {"*": "<p>t</p>"}}}"""


def parsed(spark, *bodies):
    rows = spark.createDataFrame([("asked", b) for b in bodies], "title string, body string")
    return rows.select("title", F.from_json("body", PARSE_RESPONSE)["parse"].alias("parse"))


def test_response_fields(spark):
    row = parsed(spark, BODY).select(
        fn.visible_categories("parse.categories").alias("categories"), fn.link_titles("parse.links").alias("links"),
        fn.external_links("parse").alias("external"), fn.section_names("parse.sections").alias("sections"),
        fn.first_redirect_target("parse.redirects").alias("redirect"), fn.page_id("parse").alias("id"),
        fn.page_title("title", "parse").alias("requested"),
        fn.page_title("title", "parse", "resolved").alias("resolved"), fn.response_text("parse").alias("text"),
    ).first()
    assert row.asDict() == {
        "categories": ["Shown"], "links": ["B", "A", "B"], "external": ["http://x"], "sections": ["One", "Two"],
        "redirect": "b", "id": "7", "requested": "asked", "resolved": "Resolved", "text": " t",
    }


def test_missing_keys_and_broken_bodies(spark):
    rows = parsed(spark, '{"parse": {"redirects": []}}', '{"error": {}}', "not json", None).select(
        F.col("parse").isNotNull(), fn.visible_categories("parse.categories"),
        fn.first_redirect_target("parse.redirects"), fn.response_text("parse"), fn.page_id("parse"),
    )
    assert [tuple(r) for r in rows.collect()] == [(True, None, None, None, None)] + [(False,) + (None,) * 4] * 3


def test_long_and_broken_markup_takes_linear_time(spark):
    n = 200_000
    broken = ["<script " * n, "<p>" + "<a " * n, "<!-- " * n, "<p " * n, "&" * n, "<p>" + "</" * n,
              "<script>" + "x<y;" * n, "<p>" + "a &amp; " * n, "<style><" * n]
    texts = apply(spark, fn.paragraph_text, broken)
    assert [len(t) for t in texts] == [0, 1, 0, 1, 0, 1 + 2 * n, 0, 1 + 4 * n, 0]
