"""Bundles against plain reading, and revisits against a plain rule."""

import hashlib
import io

import pytest
import zstandard
from pyspark.sql import functions as F

from pagemill.llm import warc
from pagemill.llm.warc import write_archive

SCHEMA = "page_id long, url string, html string"


def plain(rows):
    """(page_id, payload_bytes, digest, type, refers_to), where equal rows count as one response and revisits."""
    bodies = [(html or "").encode() for _, _, html in rows]
    first = {}
    for (page_id, _, _), body in zip(rows, bodies):
        if len(body) >= 100:
            first.setdefault(body, []).append((page_id is None, page_id or 0))
    taken, found = set(), []
    for (page_id, _, _), body in zip(rows, bodies):
        none, least = min(first.get(body, [(False, 0)]))
        revisit = len(body) >= 100 and ((page_id is None, page_id or 0) != (none, least) or body in taken)
        if len(body) >= 100 and not revisit:
            taken.add(body)
        found.append((
            page_id, len(body), hashlib.sha256(body).hexdigest(), "revisit" if revisit else "response",
            least if revisit and not none else None,
        ))
    return sorted(found, key=repr)


def read(archive):
    return sorted(
        ((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in archive.read().collect()), key=repr
    )


@pytest.fixture(scope="module")
def rows():
    long = "<p>" + "é" * 60 + "</p>"
    found = [
        (5, "http://a/1", long), (3, "http://a/2", long), (9, None, long), (None, "http://a/4", long),
        (1, "http://a/5", ""), (2, "http://a/5", None), (4, "http://x/é?q=%20\r\nEvil: 1", "short"), (6, "u", "short"),
        (None, None, None), (7, "u", "x" * 99), (8, "u", "x" * 99), (10, "u", "y" * 100), (11, "u", "y" * 100),
        (12, "u", "a\r\n\r\nb" * 50_000), (13, "u", "\x00" * 200), (13, "v", "z" * 300), (None, "n", "n" * 150), (None, "n", "n" * 150),
    ]
    return found + [(100 + i, f"http://h/{i}", f"<p>{i}</p>" * (i % 40)) for i in range(300)]


def test_records_come_back_whole(spark, rows):
    distinct = [r for r in rows if r[0] is not None]
    archive = write_archive(spark.createDataFrame(distinct, SCHEMA).repartition(3), frame_bytes=4000, bundle_bytes=3000)
    assert read(archive) == plain(distinct)
    bodies = {r.page_id: bytes(r.payload) for r in archive.read().collect() if r.record_type == "response" and r.page_id != 13}
    assert all(bodies[k] == (html or "").encode() for k, _, html in distinct if k in bodies)
    assert archive.index.select("bundle").distinct().count() > 3


def test_null_and_repeated_ids(spark, rows):
    rows = rows + [(3, "http://a/2", rows[0][2])] * 4 + [(20, "r", "r" * 120)] * 3
    archive = write_archive(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert read(archive) == plain(rows)


def test_bundles_are_plain_zstandard_with_a_seek_table(spark, rows):
    archive = write_archive(spark.createDataFrame(rows, SCHEMA).coalesce(1), frame_bytes=2000)
    index = archive.index.orderBy("bundle", "frame", "frame_offset").collect()
    store, root = warc.file_system(archive.folder)
    for name in {r.bundle for r in index}:
        with store.open_input_file(f"{root}/{name}") as source:
            table, data = warc.read_seek_table(source), source.read_at(source.size(), 0)
        # Any reader sees one stream of records; frames before the table add up to it.
        whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
        assert len(whole) == sum(size for _, _, size in table)
        starts = [sum(size for _, _, size in table[:i]) for i in range(len(table))]
        for r in (r for r in index if r.bundle == name):
            start, packed, size = table[r.frame]
            frame = zstandard.decompress(data[start : start + packed])
            assert len(frame) == size
            record = frame[r.frame_offset : r.frame_offset + r.length]
            assert record == whole[starts[r.frame] + r.frame_offset :][: r.length]
            assert record.startswith(b"WARC/1.1\r\nWARC-Type: ") and record.endswith(b"\r\n\r\n")
            assert f"<urn:uuid:{r.record_id}>".encode() in record


def test_single_records_are_fetched_by_their_place(spark, rows):
    archive = write_archive(spark.createDataFrame(rows, SCHEMA), frame_bytes=1000)
    some = archive.index.filter(F.col("page_id").isin(12, 10, 250, 251))
    found = {r.page_id: bytes(r.payload) for r in archive.fetch(some).collect()}
    assert found == {k: html.encode() for k, _, html in rows if k in (12, 10, 250, 251)}
    ids = [r.record_id for r in archive.index.select("record_id").collect()]
    assert len(set(ids)) == len(ids)


def test_a_changed_payload_is_noticed(spark, rows):
    page = warc.Page(1, "u", hashlib.sha256(b"one").hexdigest(), 3, False, None, b"two")
    with pytest.raises(ValueError, match="digest"):
        warc.parse_record(memoryview(warc.record_bytes(page, "x")), 0)


def test_empty_table_and_clashing_columns(spark):
    archive = write_archive(spark.createDataFrame([], SCHEMA))
    assert archive.read().count() == 0 and archive.index.count() == 0
    rows = [(1, "u", "q" * 200), (2, "u", "q" * 200)]
    names = ["digest", "size", "body", "first", "n", "row", "revisit", "_key", "_part"]
    clashing = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit("z").alias(n) for n in names])
    assert read(write_archive(clashing)) == plain(rows)


def test_large_lookups_shuffle_and_spread(spark, rows, monkeypatch):
    from pagemill.operators import skew

    real = skew.stage_sized
    monkeypatch.setattr(skew, "stage_sized", lambda df, name, limit=0: (real(df, name)[0], False))
    distinct = [r for r in rows if r[0] is not None]
    assert read(write_archive(spark.createDataFrame(distinct, SCHEMA))) == plain(distinct)
