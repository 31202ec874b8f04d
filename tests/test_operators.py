import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import plan_text

from pagemill import operators as op
from pagemill.functions import parse_list_literal
from pagemill.operators import line_chunks


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


# --- deduplication


def test_keep_first(spark):
    rows = spark.createDataFrame(
        [("b", 1, 0, "x"), ("a", 0, 5, "x"), ("c", 0, 2, "x"), ("n", 1, 1, None), ("m", 0, 9, None)],
        "id string, source_rank int, pos int, name string",
    )
    kept = op.dedup_keep_first(rows, "name", ["source_rank", "pos"])
    assert kept.columns == rows.columns
    assert rows_of(kept, "id") == [("c",), ("m",)]
    assert op.dedup_any(rows, "name").count() == 2


def test_keep_first_combines_before_the_shuffle(spark):
    rows = spark.range(10).selectExpr("id % 3 as name", "id as pos", "cast(id as string) as v")
    plan = plan_text(op.dedup_keep_first(rows, "name", ["pos"]))
    assert "partial_min_by" in plan and "Window" not in plan


# --- unions


def test_append_by_name(spark):
    a = spark.createDataFrame([("1", "x")], "id string, name string")
    b = spark.createDataFrame([("2",)], "id string")
    assert rows_of(op.append_by_name([a, b]), "id", "name", "source_rank") == [("1", "x", 0), ("2", None, 1)]
    assert rows_of(op.union_all_list([a, a])) == [("1", "x")] * 2


# --- row filters


def test_drop_disambiguation(spark):
    lists = [["a"], [], None, ["a", None], ["Disambiguation pages"], ["disambiguation pages"],
             ["x", "Disambiguation_pages"], [None, "Disambiguation pages"]]
    pages = spark.createDataFrame(list(enumerate(lists)), "i int, category array<string>")
    assert rows_of(op.drop_disambiguation(pages), "i") == [(0,), (1,), (5,)]


def test_redirects(spark):
    pages = spark.createDataFrame([("a", None), ("b", "c")], "page_title string, redirects_page string")
    direct, redirected = op.split_redirects(pages)
    assert rows_of(direct, "page_title") == [("a",)] and rows_of(redirected, "page_title") == [("b",)]
    assert rows_of(op.resolve_redirect_title(pages), "page_title") == [("a",), ("c",)]


def test_main_pages_and_suffix(spark):
    listing = spark.createDataFrame(
        [("a.jpg", 0, False), ("b.png", 0, True), ("c.jpg", 1, False)], "title string, ns int, is_redirect boolean"
    )
    assert rows_of(op.main_pages(listing), "title") == [("a.jpg",)]
    assert rows_of(op.main_pages(listing, redirects=True), "title") == [("b.png",)]
    assert rows_of(op.suffix_filter(listing, "title"), "title") == [("a.jpg",), ("c.jpg",)]


def test_page_table_variants(spark):
    record = spark.createDataFrame(
        [("t", "1", "x", ["c"], ["l"], ["e"], ["s"], None, "Q1")],
        "page_title string, page_id string, page_text string, categories array<string>, links array<string>,"
        " external_links array<string>, sections array<string>, redirects string, wikidata_id string",
    )
    base = ["page_title", "page_text", "category", "links", "external_links", "sections"]
    assert op.to_page_table(record).columns == ["page_id", *base, "redirects_page"]
    assert op.to_page_table(record, "games").columns == ["page_id", *base, "redirects_page", "wikidata_id"]
    assert op.to_page_table(record, "sample").columns == base


# --- joins


def test_exclude_known_titles(spark):
    titles = spark.createDataFrame([("a",), ("a",), ("b",), (None,), ("c",), ("c",)], "title string")
    known = spark.createDataFrame([("b",), (None,), ("b",)], "page_title string")
    left = op.exclude_known_titles(titles, known, "title", "page_title")
    assert rows_of(left) == sorted([("a",), ("a",), ("c",), ("c",), (None,)], key=repr)
    spread = op.exclude_known_titles(titles, known, "title", "page_title", limit=0, min_rows=1)
    assert rows_of(spread) == rows_of(left)


def test_attach_entity_id(spark):
    pages = spark.createDataFrame([("a",), ("a",), ("z",), (None,)], "page_title string")
    entities = spark.createDataFrame(
        [("Q2", "a", 2), ("Q1", "a", 1), ("Q3", None, 0)], "id string, name string, pos int"
    )
    for limit in (0, 1000):
        got = op.attach_entity_id(pages, entities, ["pos"], limit=limit, min_rows=1)
        assert rows_of(got, "page_title", "wikidata_id") == sorted(
            [("a", "Q1"), ("a", "Q1"), ("z", None), (None, None)], key=repr
        )


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the left rows share one key, another third have none."""
    key = F.expr("case when id % 3 = 0 then 'hot' when id % 3 = 1 then null else concat('k', id % 50) end")
    left = spark.range(3000).select(key.alias("k"), F.col("id").alias("l"))
    right = spark.range(60).selectExpr("case when id = 0 then 'hot' else concat('k', id) end as k", "id as r")
    return left, right


def test_hot_values(spark, skewed):
    left, _ = skewed
    assert sorted(op.hot_values(left, "k", share=0.2, min_rows=1), key=repr) == sorted(["hot", None], key=repr)
    assert op.hot_values(left, "k") == []
    found = op.hot_values_by(left.selectExpr("l % 2 as g", "k"), "g", ["k"], share=0.2, min_rows=1)
    assert {g for g, _ in found} == {0, 1} and all("hot" in v for v in found.values())


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_equals_plain_join(skewed, how):
    left, right = skewed
    spread = op.spread_join(left, right, "k", how, hot_left=["hot", None, "k7", "absent"], fanout=5)
    plain = left.join(right, "k", how)
    assert rows_of(spread, *plain.columns) == rows_of(plain)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join_with_hot_right(skewed, how):
    left, right = skewed
    # The right side repeats `hot` and `k7`; the left side holds few rows for them, or none.
    many = right.unionAll(right.where("k in ('hot', 'k7')").selectExpr("k", "explode(sequence(100, 140)) as r"))
    few = left.where("k is null or k <> 'hot' or l < 9")
    spread = op.spread_join(few, many, "k", how, hot_left=["k7", "k8", None], hot_right=["hot", "k7"], fanout=4)
    plain = few.join(many, "k", how)
    assert rows_of(spread, *plain.columns) == rows_of(plain)


def test_spread_join_splits_the_hot_key(spark, skewed):
    left, right = skewed
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        joined = op.spread_join(left.repartition(4), right, "k", "left", hot_left=["hot", None])
        parts = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert max(p["count"] for p in parts) < 1000


def test_spread_join_refuses_repeated_right_for_semi(skewed):
    with pytest.raises(ValueError):
        op.spread_join(*skewed, "k", "left_anti", hot_right=["hot"])


# --- positions and chunks


def even(items, n):
    size, longer = divmod(len(items), n)
    bounds = [i * size + min(i, longer) for i in range(n + 1)]
    return [items[a:b] for a, b in zip(bounds, bounds[1:])]


def shuffled(spark, rows):
    numbers = list(range(rows))
    random.Random(1).shuffle(numbers)
    return spark.createDataFrame([(i,) for i in numbers], "i int").repartition(5)


def test_with_position(spark):
    placed, rows = op.with_position(shuffled(spark, 57), ["i"])
    assert rows == 57 and rows_of(placed) == [(i, i) for i in range(57)] or len(rows_of(placed)) == 57
    assert all(i == pos for i, pos in rows_of(placed))


@pytest.mark.parametrize("rows,n", [(10, 3), (103, 10), (7, 10), (100, 100), (0, 4)])
def test_split_even(spark, rows, n):
    chunks = op.split_even(shuffled(spark, rows), n, ["i"])
    expected = [(i, c) for c, part in enumerate(even(list(range(rows)), n)) for i in part]
    assert sorted(tuple(r) for r in chunks.collect()) == expected


@pytest.mark.parametrize("rows,n", [(10, 2), (103, 8), (7, 8), (1000, 5)])
def test_split_floor(spark, rows, n):
    chunks = op.split_floor(shuffled(spark, rows), n, ["i"])
    expected = [(i, j) for j in range(n) for i in range(rows * j // n, rows * (j + 1) // n)]
    assert sorted(tuple(r) for r in chunks.collect()) == expected


@pytest.mark.parametrize("split", ["even", "floor"])
@pytest.mark.parametrize("kinds,n", [(1, 7), (3, 5), (4, 100), (40, 9), (400, 3)])
def test_ties_and_nulls_across_bounds(spark, split, kinds, n):
    """Chunks have their exact sizes, follow the order, and do not depend on the partitions."""
    rows = [(None if i % kinds == 0 else f"k{i % kinds:03}", -0.0 if i % 2 else 0.0, i // 3) for i in range(300)]
    found = []
    for parts in (1, 5):
        df = spark.createDataFrame(rows, "a string, b double, payload int").repartition(parts)
        chunks = {"even": op.split_even, "floor": op.split_floor}[split](df, n, ["a", "b"])
        assert chunks.columns == ["a", "b", "payload", "chunk_id"]
        # Both zeros are one value to Spark, so rows that differ in nothing else are equal.
        found.append(sorted(((a, b + 0.0, p, c) for a, b, p, c in chunks.collect()), key=repr))
    assert found[0] == found[1]
    assert sorted((r[:3] for r in found[0]), key=repr) == sorted(((a, b + 0.0, p) for a, b, p in rows), key=repr)
    if split == "even":
        sizes = [len(part) for part in even(list(range(300)), n)]
    else:
        sizes = [300 * (j + 1) // n - 300 * j // n for j in range(n)]
    assert [sum(1 for r in found[0] if r[3] == c) for c in range(n)] == sizes
    in_order = sorted(found[0], key=lambda r: (r[0] or "", r[3]))
    assert [r[3] for r in in_order] == sorted(r[3] for r in in_order)


def test_ties_are_told_by_a_join(spark, tmp_path):
    """Rows that tie across a bound are not looked up among all bounds, neither in the rows nor in the keys."""
    path = str(tmp_path / "rows")
    spark.range(3000).selectExpr("id % 3 as i", "id as payload").write.parquet(path)
    chunks = op.split_even(spark.read.parquet(path), 100, ["i"])
    filters = [line for line in plan_text(chunks).splitlines() if "Filter" in line]
    assert filters and not any("aggregate(" in line or "lambda" in line for line in filters)
    assert sorted(r["count"] for r in chunks.groupBy("chunk_id").count().collect()) == [30] * 100


def test_many_chunks_place_every_row(spark, monkeypatch):
    monkeypatch.setattr("pagemill.operators.chunking.MOST_CUTS", 3)
    for n in (3, 4):
        chunks = op.split_even(shuffled(spark, 50), n, ["i"])
        assert sorted(tuple(r) for r in chunks.collect()) == [
            (i, c) for c, part in enumerate(even(list(range(50)), n)) for i in part
        ]


def test_chunks_move_no_payload(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(2000).selectExpr("id as i", "repeat('x', 50) as payload").write.parquet(path)
    for split in (op.split_even, op.split_floor):
        chunks = split(spark.read.parquet(path), 9, ["i"])
        plan = chunks._jdf.queryExecution().executedPlan().toString()
        whole = plan.split("Subquery")[0]
        assert path in plan and not any(node in whole for node in ("Exchange", "Sort ", "Join"))
        assert chunks.groupBy("chunk_id").count().count() == 9


def chained(lines, size):
    """The chunk of each line, one line after the other."""
    found, start, begin, chunk = [], 0, 0, 0
    for line in lines:
        if start > begin + size:
            begin, chunk = start, chunk + 1
        found.append(chunk)
        start += len((line or "").encode()) + 1
    return found


@pytest.mark.parametrize("size", [0, 7, 64, 1000])
@pytest.mark.parametrize("block,cell,fan", [(3, 4, 5), (16, 4, 2), (1 << 20, 256, 64)])
def test_split_bytes_begins_a_chunk_behind_the_last(spark, monkeypatch, size, block, cell, fan):
    monkeypatch.setattr(line_chunks, "BLOCK_LINES", block)
    monkeypatch.setattr(line_chunks, "CELL_LINES", cell)
    composed = line_chunks.chained_chunks
    monkeypatch.setattr(line_chunks, "chained_chunks", lambda lines, size: composed(lines, size, fan))
    pick = random.Random(size + block)
    # Short and long lines, empty and null ones, and stretches of one length.
    lines = [None if k % 31 == 0 else "é" * pick.choice([0, 0, 1, 2, 5, 9, 40, 300]) for k in range(70)]
    lines += ["x" * 8] * 30 + ["y" * 2000] + [""] * 20
    df = spark.createDataFrame(list(enumerate(lines)), "i int, value string").repartition(3)
    found = sorted((r["i"], r["chunk_id"]) for r in op.split_bytes(df, size, ["i"]).collect())
    assert [c for _, c in found] == chained(lines, size)


def test_split_bytes_of_no_lines_and_of_one(spark):
    df = spark.createDataFrame([(1, "abc")], "i int, value string")
    assert [r["chunk_id"] for r in op.split_bytes(df, 1, ["i"]).collect()] == [0]
    assert op.split_bytes(df.where("i > 1"), 1, ["i"]).collect() == []


def test_jump_functions_compose_as_chains_do():
    pick = np.random.default_rng(5)
    starts = np.cumsum(pick.integers(1, 60, 4000))
    for size in (1, 30, 500, 5000):
        parts = [line_chunks.block_jump(p, size) for p in np.split(starts, [1, 2, 40, 900, 2500])]
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.then(part)
        for threshold in (-1, int(starts[0]), int(starts[0]) + size - 1):
            place, chunks, at = np.searchsorted(starts, threshold, side="right"), 0, threshold
            while place < len(starts):
                at, chunks = starts[place] + size, chunks + 1
                place = np.searchsorted(starts, at, side="right")
            to, count = whole.apply(np.array([threshold]))
            assert (int(to[0]), int(count[0])) == (at, chunks)


def test_split_byte_ranges(spark):
    lines = ["é" * n for n in (3, 0, 50, 1, 7, 200, 2, 2)] * 5
    df = spark.createDataFrame(list(enumerate(lines)), "i int, value string").repartition(4)
    got = dict((r["i"], r["chunk_id"]) for r in op.split_byte_ranges(df, 64, ["i"]).collect())
    start, expected = 0, {}
    for i, line in enumerate(lines):
        expected[i] = start // 64
        start += len(line.encode()) + 1
    assert got == expected


# --- samples


def test_take_first_n(spark):
    assert rows_of(op.take_first_n(shuffled(spark, 30), 4, ["i"])) == [(0,), (1,), (2,), (3,)]


@pytest.fixture(scope="module")
def pool(spark):
    return spark.range(2000).selectExpr("concat('t', id) as title", "id as page_id")


def by_digest(pool, n):
    return rows_of(pool.orderBy(F.md5(F.concat(F.lit("42:"), F.col("title"))), "title").limit(n))


@pytest.mark.parametrize("n", [0, 1, 13, 500, 1999, 2000])
@pytest.mark.parametrize("sorted_rows", [0, 1, 100_000])
def test_sample_exact(pool, n, sorted_rows):
    sample = op.sample_exact(pool, n, "title", sorted_rows=sorted_rows)
    assert rows_of(sample) == by_digest(pool, n)


@pytest.mark.parametrize("margin", [0.0, 0.005])
def test_samples_read_keys_twice(spark, tmp_path, monkeypatch, margin):
    """Two passes over the keys find the cut, also where the bracket misses it; other columns are not read."""
    from pagemill.operators import sampling

    path = str(tmp_path / "pool")
    keys = "concat('t', if(id % 3 = 0, 1, id)) AS title"
    spark.range(30_000).selectExpr(keys, "id AS page_id", "repeat('x', 50) AS body").write.parquet(path)
    pool = spark.read.parquet(path)
    monkeypatch.setattr(sampling, "MARGIN", margin)
    monkeypatch.setattr(sampling, "SMALL_BYTES", 0)
    whole, reads = sampling.stage, []

    def watched(df, name):
        reads.append(plan_text(df))
        return whole(df, name)

    monkeypatch.setattr(sampling, "stage", watched)
    digest = F.md5(F.concat(F.lit("42:"), F.col("title")))
    ordered = [r["title"] for r in pool.orderBy(digest, "title").select("title").collect()]
    hot = ordered.index("t1")
    for n in (1, hot, hot + 10_001, 20_000, 29_999):
        reads.clear()
        found = op.sample_exact(pool, n, "title", sorted_rows=50)
        assert sorted(r["title"] for r in found.select("title").collect()) == sorted(ordered[:n])
        assert all("body" not in plan for plan in reads)
        assert len(reads) == 1 or margin == 0.0
        assert "Union" not in plan_text(found)
    # A cut within one key looks at whole rows of that key.
    assert len({r["page_id"] for r in op.sample_exact(pool, hot + 5_000, "title").collect()}) == hot + 5_000
    assert "body" in reads[-1]


def test_sample_of_one_repeated_key(spark):
    pool = spark.range(900).selectExpr("'same' as title", "id as page_id")
    sample = rows_of(op.sample_exact(pool, 100, "title", sorted_rows=5))
    assert len(set(sample)) == 100 and set(sample) <= set(rows_of(pool))
    copies = spark.range(900).selectExpr("'same' as title", "cast(null as int) as nothing", "array('x') as list")
    got = op.sample_exact(copies, 100, "title", sorted_rows=5)
    assert [tuple(r) for r in got.collect()] == [("same", None, ["x"])] * 100


def test_sample_seeds_and_short_pools(pool):
    assert rows_of(op.sample_exact(pool, 50, "title", seed=1)) != rows_of(op.sample_exact(pool, 50, "title"))
    with pytest.raises(ValueError):
        op.sample_exact(pool, 2001, "title")
    assert op.sample_exact(pool, 2001, "title", short="all").count() == 2000


def test_literals_after_append(spark):
    df = spark.createDataFrame([("['a', 'b']",)], "t string").select(parse_list_literal("t").alias("a"))
    assert df.first()["a"] == ["a", "b"]


@pytest.mark.parametrize("sorted_rows", [0, 3, 100_000])
def test_samples_hold_only_rows_of_the_pool(spark, sorted_rows):
    times = [f"2024-01-01 00:00:00.12300{n}" for n in range(6)] + ["2024-01-01 00:00:00.123456"] * 4
    pool = spark.createDataFrame([("same", t) for t in times], "title string, t string")
    pool = pool.select("title", F.col("t").cast("timestamp").alias("at"), F.col("t").cast("timestamp_ntz").alias("ntz"))
    rows = sorted(map(repr, pool.collect()))
    # Three cuts of ten rows, four of which are equal, meet the equal rows or their bounds.
    for n in (3, 6, 8):
        found = sorted(map(repr, op.sample_exact(pool.repartition(3), n, "title", sorted_rows=sorted_rows).collect()))
        assert len(found) == n
        assert all(found.count(r) <= rows.count(r) for r in found)
        assert found == sorted(map(repr, op.sample_exact(pool, n, "title").collect()))


def test_parse_ok_decodes_once(spark):
    from compare import plan_text

    from pagemill import sources as src

    frame = spark.createDataFrame([("a", "{}")], "title string, body string")
    pages = op.parse_ok(src.load_parse_responses(frame))
    assert plan_text(pages.select("title", "parse.title", "parse.pageid")).count("from_json") == 1
    assert pages.columns == ["title", "parse"]


def test_key_filter_keeps_all_keys_and_few_others(spark):
    keys = spark.range(3000).selectExpr("if(id = 7, null, concat('k', id * 10)) as title")
    rows = spark.range(30_001).selectExpr("if(id = 30000, null, concat('k', id)) as title", "id as body")
    made = op.KeyFilter.of(keys, "title", 3000)
    kept = {r.title for r in made.keep_possible(rows, "title").collect()}
    wanted = {r.title for r in keys.collect()} - {None}
    assert wanted <= kept and None not in kept and len(kept - wanted) < 27_000 * 0.02
    low, high = (op.KeyFilter.of(keys.where(c), "title", 3000) for c in ("length(title) < 5", "length(title) >= 5"))
    assert {r.title for r in low.merged(high).keep_possible(rows, "title").collect()} == kept
    # A filter of bounded size lets more pass, and loses nothing.
    small = op.KeyFilter.of(keys, "title", 3000, most_words=64)
    assert small.words == 64 and wanted <= {r.title for r in small.keep_possible(rows, "title").collect()}
    with pytest.raises(ValueError, match="words"):
        made.merged(small)
    none = op.KeyFilter.of(keys.limit(0), "title", 0)
    assert none.keep_possible(rows, "title").count() == 0
