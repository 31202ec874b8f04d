import json

import pytest

from compare import plan_text

from pagemill import plans
from pagemill import sources as src
from pagemill.constants import ENTITY_PREFIX
from pagemill.schemas import CATEGORY_TABLE, GAME_PAGE_TABLE, PAGE_TABLE, RESPONSES, SAMPLE_PAGE_TABLE


def body(pageid, title, text="<p>t</p>", categories=("C",), redirects=()):
    return json.dumps({"parse": {
        "pageid": pageid, "title": title, "categories": [{"*": c} for c in categories],
        "links": [{"*": "L"}], "externallinks": [], "sections": [{"line": "S"}],
        "redirects": [{"from": a, "to": b} for a, b in redirects], "text": {"*": text},
    }})


FAILED = '{"error": {"code": "missingtitle"}}'


@pytest.fixture(scope="module")
def responses(spark):
    return spark.createDataFrame([
        ("A", body(1, "A")), ("B", FAILED), ("C", body(3, "D", redirects=[("C", "D"), ("D", "E")])),
        ("M", body(4, "M", categories=["Disambiguation pages"])), ("N", body(5, "N", text="")), ("X", "broken"),
    ], RESPONSES)


def columns(schema):
    return [(f.name, f.dataType) for f in schema.fields]


def test_extract_pages(responses):
    pages = plans.extract_pages(responses)
    assert columns(pages.schema) == columns(PAGE_TABLE)
    rows = {r["page_title"]: r for r in pages.collect()}
    assert set(rows) == {"A", "C", "M", "N"}
    assert rows["C"]["redirects_page"] == "D" and rows["A"]["redirects_page"] is None
    assert rows["A"]["page_text"] == " t" and rows["N"]["page_text"] == "" and rows["A"]["external_links"] == []
    kept = plans.extract_pages(responses, without_disambiguation=True)
    assert {r["page_title"] for r in kept.collect()} == {"A", "C", "N"}


def test_bodies_are_decoded_once(responses):
    for frame in (plans.extract_pages(responses, without_disambiguation=True), plans.extract_page_info(responses)):
        plan = plan_text(frame)
        assert plan.count("from_json(") == 1


def test_extract_page_info_keeps_failures(responses):
    info = plans.extract_page_info(responses)
    assert {"categories", "redirects"} < set(info.columns)
    rows = [tuple(r) for r in info.collect()]
    assert len(rows) == 6 and rows.count((None,) * 8) == 2
    assert "D" in {r["page_title"] for r in info.collect()}


@pytest.fixture(params=["few", "many"])
def sizes(request, monkeypatch):
    """Run with titles that count as small, and with ones that count as too many for broadcast."""
    if request.param == "many":
        from pagemill.plans import pages as module

        measured = module.stage_sized
        monkeypatch.setattr(module, "stage_sized", lambda *args: (measured(*args)[0], False))


def test_build_game_pages(spark, responses, sizes):
    def source(*rows):
        schema = "id string, idLabel string, name string, pos int"
        return spark.createDataFrame([(ENTITY_PREFIX + i, None, n, p) for i, n, p in rows], schema)

    games = source(("Q2", "A", 1), ("Q1", "A", 0), ("Q9", None, 2), ("Q5", "B", 3))
    series = source(("Q3", "C", 0), ("Q4", "A", 0))
    mapping = source(("Q6", "C", 0), ("Q7", "unknown", 0)).drop("idLabel")
    pages = plans.build_game_pages([games, series, mapping], responses, ["pos"])
    assert columns(pages.schema) == columns(GAME_PAGE_TABLE)
    found = sorted((r["page_title"], r["wikidata_id"]) for r in pages.collect())
    assert found == [("A", "Q1"), ("C", "Q3")]


def test_game_pages_from_saved_queries(spark, responses, tmp_path):
    """The first row in the order of the files wins, and a query without names adds nothing."""
    (tmp_path / "games.csv").write_text(
        "id,idLabel,genreLabel,name\n" + "".join(f"{ENTITY_PREFIX}Q{i},l,g,A\n" for i in range(50, 0, -1))
    )
    (tmp_path / "series.csv").write_text(f'id,idLabel,name\n{ENTITY_PREFIX}Q99,"a, b",A\n{ENTITY_PREFIX}Q98,,C\n')
    (tmp_path / "mapping.csv").write_text(f"id,idLabel,article\n{ENTITY_PREFIX}Q97,l,x\n")
    sources = [
        src.read_query_result(spark, str(tmp_path / f"{n}.csv"), ordered=True) for n in ("games", "series", "mapping")
    ]
    pages = plans.build_game_pages(sources, responses, list(src.FILE_ORDER))
    assert sorted((r["page_title"], r["wikidata_id"]) for r in pages.collect()) == [("A", "Q50"), ("C", "Q98")]


def listing(spark, titles):
    rows = [(i, t, 0, False) for i, t in enumerate(titles)]
    return spark.createDataFrame([*rows, (90, "ns", 1, False), (91, "r", 0, True)],
                                 "page_id int, title string, ns int, is_redirect boolean")


def test_build_nongame_sample(spark, responses, sizes):
    games = spark.createDataFrame([("A",), ("A",), ("Z",), ("Y",)], "page_title string")
    sample = plans.build_nongame_sample(listing(spark, "ACNX"), games, responses)
    assert columns(sample.schema) == columns(SAMPLE_PAGE_TABLE)
    # C is a redirect and takes its target's title; the response for X is broken.
    assert sorted(r["page_title"] for r in sample.collect()) == ["D", "N"]


def test_recheck_after_redirects(spark, responses):
    games = spark.createDataFrame([("D",), ("Z",), ("Y",)], "page_title string")
    plain = plans.build_nongame_sample(listing(spark, "ACN"), games, responses)
    assert sorted(r["page_title"] for r in plain.collect()) == ["A", "D", "N"]
    checked = plans.build_nongame_sample(listing(spark, "ACN"), games, responses, recheck=True)
    assert sorted(r["page_title"] for r in checked.collect()) == ["A", "N"]


def test_sample_larger_than_the_pool(spark, responses):
    games = spark.createDataFrame([("D",), ("Z",), ("Y",)], "page_title string")
    with pytest.raises(ValueError):
        plans.build_nongame_sample(listing(spark, "A"), games, responses)


def test_build_pages_chunked(spark):
    replies = {"A": body(1, "A"), "M": body(2, "M", categories=["Disambiguation_pages"]), "E": FAILED}
    lines = spark.createDataFrame([("1; A",), ("2; M",), ("3; E",), ("4; gone",), ("broken",)], "value string")
    pages = plans.build_pages_chunked(lines, lambda title: replies[title], chunks=3)
    assert columns(pages.schema) == columns(PAGE_TABLE)
    assert [r["page_title"] for r in pages.collect()] == ["A"]


def test_content_lengths(spark):
    fetched = spark.createDataFrame([("u", "abc", None), ("v", None, "failed")], "url string, body string, error string")
    assert [tuple(r) for r in plans.content_lengths(fetched).collect()] == [("u", 3, None), ("v", None, "failed")]


def test_build_category_table(spark):
    batch = {"query": {"allcategories": [{"size": 9, "pages": 5, "files": 3, "subcats": 1, "*": " Name "}]}}
    batches = spark.read.schema(
        "`continue` struct<accontinue:string>, query struct<allcategories:array<map<string,string>>>"
    ).json(spark.sparkContext.parallelize([json.dumps(batch)]))
    table = plans.build_category_table(batches)
    assert table.schema == CATEGORY_TABLE and tuple(table.first()) == ("Name", 9, 5, 1, 3)


def test_only_wanted_bodies_are_shuffled(spark):
    titles = spark.range(200).selectExpr("concat('t', id * 50) as title", "id as rank").unionAll(
        spark.sql("select 't50', -1L union all select null, -2L")
    )
    responses = spark.range(10_000).selectExpr("concat('t', id) as title", "concat('b', id) as body")
    small = plans.pages.saved_responses(titles, responses)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = plans.pages.saved_responses(titles, responses, limit=0)
        columns = ["title", "rank", "body"]
        found = sorted(map(tuple, large.select(*columns).collect()))
        assert found == sorted(map(tuple, small.select(*columns).collect())) and len(found) == 201
        plan = large._jdf.queryExecution().executedPlan().toString()
        bodies = plan[: plan.index("Range (0, 10000")]
        # The filter lies between the bodies and the shuffle.
        assert bodies.rindex("BroadcastHashJoin") > bodies.rindex("Exchange hashpartitioning(title")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_counts_of_page_tables(spark, responses):
    more = responses.unionAll(spark.createDataFrame([("Z", None)], RESPONSES))
    pages, metrics = plans.metered_pages(more, without_disambiguation=True)
    assert sorted(r.page_title for r in pages.collect()) == sorted(
        r.page_title for r in plans.extract_pages(more, without_disambiguation=True).collect()
    )
    assert metrics.get() == {"responses": 7, "no_body": 1, "pages": 3, "no_text": 1, "chars": 4, "dropped": 4}
    pages, metrics = plans.metered_pages(more.limit(0))
    pages.collect()
    assert set(metrics.get().values()) == {0}
