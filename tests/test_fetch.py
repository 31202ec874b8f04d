"""Fetching that is resumed: calls are counted by files that tasks leave."""

from __future__ import annotations

import os
from collections import Counter
from uuid import uuid4

import pytest

from pagemill.streaming import fetch_resumable


def counting(folder, fails=lambda key, before: False, stops_on=None):
    """A fetch that leaves one file per call; `before` is the number of earlier calls for the key."""
    folder.mkdir(exist_ok=True)
    calls, stop = str(folder), str(folder.parent / "stop")

    class Stop(BaseException):
        """Ends a task, unlike the errors that become rows."""

    def fetch(key, *inputs):
        before = sum(name.startswith(f"{key}-") for name in os.listdir(calls))
        open(os.path.join(calls, f"{key}-{uuid4().hex}"), "w").close()
        if key == stops_on and os.path.exists(stop):
            raise Stop(key)
        if fails(key, before):
            raise ValueError(f"no {key}")
        return "".join([f"body of {key}", *map(str, inputs)])

    return fetch


def calls_of(folder):
    return Counter(name.split("-")[0] for name in os.listdir(folder))


def outcome(df):
    return {r[0]: (r["body"], r["error"], r["attempt"]) for r in df.collect()}


def test_a_stopped_run_is_resumed(spark, tmp_path):
    titles = spark.range(40).selectExpr("concat('t', id) AS title").repartition(1)
    (tmp_path / "stop").touch()
    fetch = counting(tmp_path / "calls", stops_on="t25")
    options = {"folder": str(tmp_path / "log"), "keys_per_file": 5, "batch_files": 1}
    with pytest.raises(Exception):
        fetch_resumable(titles, "title", fetch, **options)
    committed = set(spark.read.parquet(str(tmp_path / "log" / "fetched")).toPandas()["key"])
    first = calls_of(tmp_path / "calls")
    assert committed and "t25" not in committed and len(committed) < 40
    (tmp_path / "stop").unlink()
    found = fetch_resumable(titles, "title", fetch, **options)
    assert outcome(found) == {f"t{i}": (f"body of t{i}", None, 1) for i in range(40)} and found.count() == 40
    after = calls_of(tmp_path / "calls")
    assert all(after[title] == first[title] == 1 for title in committed)
    # What is called twice stood in the micro-batch that was under way.
    assert 0 < sum(n == 2 for n in after.values()) <= 5 and max(after.values()) == 2


def test_failures_are_tried_again_and_lists_grow(spark, tmp_path):
    fetch = counting(tmp_path / "calls", fails=lambda key, before: key == "bad" or (key == "late" and before < 2))
    rows = [("a", "1"), ("a", "0"), ("late", "2"), ("bad", "3"), (None, "4")]
    short, whole = rows[:3], rows
    schema, folder = "title string, body string", str(tmp_path / "log")
    found = fetch_resumable(spark.createDataFrame(short, schema), "title", fetch, folder, inputs=("body",))
    # Of two rows with one key the least inputs count; an input may have the name of a result.
    assert outcome(found) == {"a": ("body of a0", None, 1), "late": (None, "ValueError: no late", 1)}
    again = fetch_resumable(
        spark.createDataFrame(whole, schema), "title", fetch, folder, inputs=("body",), attempts=3, chunks=2
    )
    assert outcome(again) == {
        "a": ("body of a0", None, 1),
        "late": ("body of late2", None, 3),
        "bad": (None, "ValueError: no bad", 3),
        None: ("body of None4", None, 1),
    }
    assert calls_of(tmp_path / "calls") == {"a": 1, "late": 3, "bad": 3, "None": 1}
    empty = fetch_resumable(spark.createDataFrame([], schema), "title", fetch, folder, inputs=("body",))
    assert outcome(empty) == outcome(again)


def test_nothing_to_fetch(spark, tmp_path):
    empty = spark.createDataFrame([], "title string")
    found = fetch_resumable(empty, "title", lambda key: key, str(tmp_path / "log"))
    assert found.columns == ["title", "body", "error", "attempt"] and found.count() == 0
