import json

import pytest
from pyspark.errors import AnalysisException

from compare import plan_text

from pagemill import operators as op
from pagemill import sources as src
from pagemill.schemas import CATEGORY_TABLE, PAGE_TABLE
from pagemill.streaming import ingest_batches, track_listing, tracked_breaks


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


def write(path, name, *documents):
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text("".join(json.dumps(d) + "\n" for d in documents), encoding="utf-8")


def pages(first, n, more):
    listed = [{"pageid": i, "ns": 0, "title": f"T{i}"} for i in range(first, first + n)]
    return {"query": {"allpages": listed}} | ({"continue": {"apcontinue": f"T{first + n}"}} if more else {})


def test_listing_batches(spark, tmp_path):
    write(tmp_path / "in", "a.json", pages(0, 3, True), pages(3, 2, False))
    batches = src.read_listing_batches(spark, str(tmp_path / "in"))
    assert rows_of(src.load_page_listing(batches)) == [(i, f"T{i}") for i in range(5)]
    assert rows_of(src.listing_complete(batches)) == [(2, 1, True)]
    write(tmp_path / "cut", "a.json", pages(0, 3, True))
    assert rows_of(src.listing_complete(src.read_listing_batches(spark, str(tmp_path / "cut")))) == [(1, 0, False)]


def chain(*sizes):
    """Batches of these sizes that follow each other."""
    found, first = [], 0
    for n in sizes:
        found.append(pages(first, n, True))
        first += n
    del found[-1]["continue"]
    return found


def doubled(batches, k):
    return [*batches, batches[k]]


def without(batches, k):
    return batches[:k] + batches[k + 1 :]


def ended(batches, k):
    return [{"query": b["query"]} if n == k else b for n, b in enumerate(batches)]


def circle(*firsts):
    return [pages(a, 1, True) | {"continue": {"apcontinue": f"T{b}"}} for a, b in zip(firsts, [*firsts[1:], firsts[0]])]


WHOLE = chain(*[3] * 9)


@pytest.mark.parametrize(
    "batches,breaks",
    [
        (WHOLE, []),
        (chain(1), []),
        (without(WHOLE, 4), [("missing batch", "T12"), ("several starts", "T0"), ("several starts", "T15")]),
        (without(WHOLE, 8), [("missing batch", "T24"), ("no ending", None)]),
        (doubled(WHOLE, 4), [("repeated batch", "T12"), ("repeated continuation", "T15")]),
        (ended(WHOLE, 2), [("several endings", "T24"), ("several endings", "T6"), ("several starts", "T0"), ("several starts", "T9")]),
        (WHOLE + circle(100, 101, 102), [("cycle", "T100")]),
        (circle(5, 6), [("no ending", None), ("no start", None)]),
        (WHOLE + [{"query": {"allpages": []}, "continue": {"apcontinue": "T3"}}],
         [("empty batch", None), ("repeated continuation", "T3")]),
    ],
)
def test_breaks_of_a_listing_are_named(spark, tmp_path, batches, breaks):
    for n, batch in enumerate(batches):
        write(tmp_path / "in", f"{n:02d}.json", batch)
    listing = src.read_listing_batches(spark, str(tmp_path / "in"))
    assert rows_of(src.listing_breaks(listing)) == sorted(breaks, key=repr)
    finals = sum("continue" not in b for b in batches)
    assert rows_of(src.listing_complete(listing)) == [(len(batches), finals, not breaks)]


@pytest.mark.parametrize(
    "batches", [WHOLE, doubled(without(WHOLE, 4), 6), ended(WHOLE, 2), WHOLE + circle(100, 101), WHOLE + [{"query": {"allpages": []}}]]
)
def test_tracking_goes_on_where_it_stopped(spark, tmp_path, batches):
    """Files come out of order and in two runs; after each the breaks are those of all files so far."""
    source, table, state = (str(tmp_path / n) for n in ("in", "tokens", "state"))
    named = list(enumerate(batches))[::-1]
    for part in (named[1::2], named[::2], []):
        for n, batch in part:
            write(tmp_path / "in", f"{n:02d}.json", batch)
        track_listing(spark, source, table, state, files_per_trigger=3)
        seen = src.read_listing_batches(spark, source)
        assert rows_of(tracked_breaks(spark, table)) == rows_of(src.listing_breaks(seen))


def test_tokens_write_blanks_as_underscores(spark, tmp_path):
    entry = {"size": 9, "pages": 5, "files": 3, "subcats": 1, "*": "Two words"}
    write(tmp_path / "in", "a.json", {"query": {"allcategories": [{"*": "One"}]}, "continue": {"accontinue": "Two_words"}})
    write(tmp_path / "in", "b.json", {"query": {"allcategories": [entry]}})
    batches = src.read_listing_batches(spark, str(tmp_path / "in"), "categories")
    assert rows_of(src.listing_complete(batches)) == [(2, 1, True)]


def test_category_batches(spark, tmp_path):
    entry = {"size": 9, "pages": 5, "files": 3, "subcats": 1, "*": "Name"}
    write(tmp_path / "in", "a.json", {"query": {"allcategories": [entry, {"*": "Bare"}]}})
    batches = src.read_listing_batches(spark, str(tmp_path / "in"), "categories")
    assert rows_of(src.load_category_listing(batches)) == [(9, 5, 3, 1, "Name"), (None, None, None, None, "Bare")]


def test_stream_equals_batch_and_restart_adds_nothing(spark, tmp_path):
    source, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    write(tmp_path / "in", "a.json", pages(0, 3, True))
    write(tmp_path / "in", "b.json", pages(3, 2, True))
    ingest_batches(spark, source, sink, state, files_per_trigger=1)
    first = rows_of(spark.read.parquet(sink))
    assert first == rows_of(src.load_page_listing(src.read_listing_batches(spark, source)))
    ingest_batches(spark, source, sink, state)
    assert rows_of(spark.read.parquet(sink)) == first
    write(tmp_path / "in", "c.json", pages(5, 2, False))
    ingest_batches(spark, source, sink, state)
    assert rows_of(spark.read.parquet(sink), "page_id") == [(i,) for i in range(7)]


def test_counts_of_an_ingest(spark, tmp_path):
    source, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for n, batch in enumerate(chain(3, 1, 2, 4)):
        write(tmp_path / "in", f"{n}.json", batch)
    write(tmp_path / "in", "error.json", {"error": {"code": "maxlag"}})
    counts = ingest_batches(spark, source, sink, state, files_per_trigger=2)
    assert counts == {"batches": 5, "broken": 1, "final_batches": 1, "entries": 10}
    assert set(ingest_batches(spark, source, sink, state).values()) == {0}
    write(tmp_path / "in", "late.json", pages(10, 2, True))
    assert ingest_batches(spark, source, sink, state) == {"batches": 1, "broken": 0, "final_batches": 0, "entries": 2}
    assert spark.read.parquet(sink).count() == 12


def test_stream_of_categories(spark, tmp_path):
    source, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    entry = {"size": 9, "pages": 5, "files": 3, "subcats": 1, "*": "Name"}
    write(tmp_path / "in", "a.json", {"query": {"allcategories": [entry]}})
    ingest_batches(spark, source, sink, state, kind="categories")
    assert rows_of(spark.read.parquet(sink), "title", "size") == [("Name", 9)]


def test_lines_are_read_in_splits_and_keep_their_order(spark, tmp_path):
    lines = [f"{i}; title {i}" + "x" * 90 for i in range(5000)]
    (tmp_path / "list.txt").write_text("\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        read = src.read_lines(spark, str(tmp_path / "list.txt"))
        assert read.rdd.getNumPartitions() > 4
        assert sorted(r[0] for r in read.collect()) == sorted(lines)
        ordered = src.read_lines(spark, str(tmp_path / "list.txt"), ordered=True)
        titles = src.read_title_list(ordered)
        first = op.take_first_n(titles, 700, list(src.FILE_ORDER)).select("title").collect()
        assert [r[0] for r in first] == [line.split("; ")[1] for line in lines[:700]]
        placed, rows = op.with_position(ordered, list(src.FILE_ORDER))
        got = [r[0] for r in placed.orderBy("pos").select("value").collect()]
        assert rows == 5000 and got == lines
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_query_result_without_name(spark, tmp_path):
    (tmp_path / "mapping.csv").write_text('id,idLabel,article\nQ1,"say ""x"", y",a\nQ2,,b\n')
    rows = src.read_query_result(spark, str(tmp_path / "mapping.csv"))
    assert rows_of(rows) == [("Q1", 'say "x", y', None), ("Q2", None, None)]
    ordered = src.read_query_result(spark, str(tmp_path / "mapping.csv"), ordered=True)
    assert set(src.FILE_ORDER) < set(ordered.columns)


def test_page_csv_written_elsewhere(spark, tmp_path):
    text = (
        ",page_id,page_title,page_text,category,links\n"
        "0,7,\"A \"\"b\"\", c\", text,\"['x', 'y']\",[]\n"
        "1,8,T, more,\"[\"\"it's\"\"]\",\"['a, b']\"\n"
    )
    (tmp_path / "pages.csv").write_text(text)
    rows = src.read_page_csv(spark, str(tmp_path / "pages.csv"), list_columns=("category", "links")).drop("_c0")
    assert [tuple(r) for r in rows.orderBy("page_id").collect()] == [
        ("7", 'A "b", c', " text", ["x", "y"], [""]), ("8", "T", " more", ['"its"'], ["a", "b"]),
    ]


def test_csv_keeps_blanks_quotes_and_nulls(spark, tmp_path):
    pages = spark.createDataFrame(
        [("1", " lead\\ trail ", ["a'b", 'c"d']), ("2", None, [])], "id string, text string, items array<string>"
    )
    src.write_csv_with_lists(pages, str(tmp_path / "out"))
    back = src.read_page_csv(spark, str(tmp_path / "out"))
    assert rows_of(back) == rows_of(src.lists_to_literals(pages))
    with pytest.raises(AnalysisException):
        src.write_csv_with_lists(pages, str(tmp_path / "out"))


def test_write_table_refuses_an_existing_path(spark, tmp_path):
    df = spark.createDataFrame([("c", 1)], "category string, size int")
    src.write_table(df, str(tmp_path / "t"))
    with pytest.raises(AnalysisException):
        src.write_table(df, str(tmp_path / "t"))
    src.write_table(df, str(tmp_path / "t"), mode="append")
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2


def test_category_round_trip(spark, tmp_path):
    table = spark.createDataFrame([("A b", 10, 7, 1, 2), ("C", 3, 3, 0, 0)], CATEGORY_TABLE)
    order = ["size", "num_pages", "num_files", "num_subcat", "category"]
    for number, sep in enumerate(("; ", ";")):
        src.write_delimited(table, str(tmp_path / str(number)), order, sep)
        back = src.read_category_list(src.read_lines(spark, str(tmp_path / str(number))))
        assert back.schema == CATEGORY_TABLE and rows_of(back) == rows_of(table)


def test_records_to_table(spark):
    record = spark.createDataFrame(
        [(7, "t", "x", ["a"], [], [], None, None)],
        "page_id int, page_title string, page_text string, category array<string>, links array<string>,"
        " external_links array<string>, sections array<string>, redirects_page string",
    )
    table = src.records_to_table(record.select(*reversed(record.columns)), PAGE_TABLE)
    assert table.schema == PAGE_TABLE and table.first()["page_id"] == "7"


def test_list_files(spark, tmp_path):
    for name in ("a.jpg", "b.png", "sub/c.jpg"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"12345")
    files = src.list_files(spark, str(tmp_path))
    names = sorted(r["path"].rsplit("/", 1)[1] for r in files.collect())
    assert names == ["a.jpg", "c.jpg"] and {r["length"] for r in files.collect()} == {5}
    plan = plan_text(files)
    assert "content" not in plan


def test_fetch_map_reports_failures(spark):
    def fetch(key, tail):
        if key == 3:
            raise KeyError("gone")
        return f"{key}{tail}"

    keys = spark.range(200).selectExpr("id as key", "'!' as tail")
    fetched = src.fetch_map(keys, "key", fetch, chunks=7, inputs=("tail",))
    assert fetched.rdd.getNumPartitions() == 7
    rows = {r["key"]: (r["body"], r["error"]) for r in fetched.collect()}
    assert len(rows) == 200 and rows[3] == (None, "KeyError: 'gone'") and rows[4] == ("4!", None)


def test_fetch_map_hands_numbers_over_as_they_are(spark):
    keys = spark.createDataFrame([(1, None), (2, 5)], "key bigint, more int")
    fetched = src.fetch_map(keys, "key", lambda key, more: f"{key} {more}", inputs=("more",), keep=("more",))
    assert sorted(tuple(r) for r in fetched.collect()) == [(1, "1 None", None, None), (2, "2 5", None, 5)]


def test_fetch_map_keeps_squares_in_place(spark):
    numbers = spark.range(1, 11).selectExpr("id as n")
    fetched = src.fetch_map(numbers, "n", lambda n: str(n * n))
    assert rows_of(fetched, "n", "body") == sorted(((n, str(n * n)) for n in range(1, 11)), key=repr)


def test_stage_and_size_check(spark):
    df = spark.range(100).selectExpr("concat('t', id) as title")
    small, fits = src.stage_sized(df, "small")
    large, too_large = src.stage_sized(df, "large", limit=100)
    assert fits and not too_large
    assert rows_of(small) == rows_of(large) == rows_of(df)
    assert src.stage_sized(df.limit(0), "empty", limit=0)[1]


def test_shared_folder(spark, monkeypatch):
    root = src.shared_root(spark)
    assert root and src.shared_root(spark) == root
    assert src.work_path(spark, "x").startswith(root) and src.work_path(spark, "x") != src.work_path(spark, "x")
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured is None or root == configured.rstrip("/")


class Unset:
    """A session without a configured folder."""

    def __init__(self, master):
        self.conf, self.sparkContext = {}, self
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_no_local_folder_on_a_cluster():
    local = Unset("local[2]")
    assert src.shared_root(local) == src.shared_root(local) == local.folder
    with pytest.raises(RuntimeError):
        src.shared_root(Unset("spark://host"))


def test_csv_records_may_span_lines(spark, tmp_path):
    texts = ["t\rx", "line1\nline2", "", None, 'q"uo"te,\\ x', "a\r\nb ", " lead", "\\", "\r", "\n", '"', "é,"]
    rows = [(str(n), t) for n, t in enumerate(texts)]
    table = spark.createDataFrame(rows, "page_id string, page_text string").repartition(2)
    src.write_csv_with_lists(table, str(tmp_path / "out"))
    back = src.read_page_csv(spark, str(tmp_path / "out"))
    assert sorted(map(tuple, back.collect()), key=lambda r: int(r[0])) == rows


def test_query_result_with_stated_columns(spark, tmp_path):
    from pagemill.schemas import MAPPING_RESULT_COLUMNS, QUERY_RESULT_COLUMNS

    (tmp_path / "games.csv").write_text(",".join(QUERY_RESULT_COLUMNS) + '\nQ1,"two\nlines",,,,,N,a\n')
    rows = src.read_query_result(spark, str(tmp_path / "games.csv"), columns=QUERY_RESULT_COLUMNS)
    assert [tuple(r) for r in rows.collect()] == [("Q1", "two\nlines", "N")]
    with pytest.raises(Exception):
        src.read_query_result(spark, str(tmp_path / "games.csv"), columns=MAPPING_RESULT_COLUMNS).collect()


def test_an_application_leaves_no_staged_tables(tmp_path):
    import os
    import subprocess
    import sys
    import time

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = """
from pyspark.sql import SparkSession
from pagemill.sources.storage import stage
import os, sys
spark = SparkSession.builder.master("local[1]").config("spark.checkpoint.dir", sys.argv[1]).getOrCreate()
assert stage(spark.range(5), "numbers").count() == 5
assert len(os.listdir(sys.argv[1] + "/pagemill")) == 1
spark.stop()
"""
    subprocess.run([sys.executable, "-c", code, str(tmp_path)], cwd=root, check=True, timeout=120)
    left = tmp_path / "pagemill"
    for _ in range(50):
        if not list(left.iterdir()):
            break
        time.sleep(0.2)
    assert list(left.iterdir()) == []
