"""WARC records in seekable Zstandard bundles: independent frames, a seek table, and an index of records."""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Callable, Iterable, Iterator
from typing import BinaryIO, NamedTuple
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm.common import batched, read_table
from pagemill.operators.skew import lookup_join
from pagemill.sources.storage import stage, work_path

# Bytes of records, before compression, that one frame gathers; a larger record has a frame of its own.
FRAME_BYTES = 1024 * 1024
# Compressed bytes after which a task begins another bundle.
BUNDLE_BYTES = 256 * 1024 * 1024
# Compressed bytes that one task reads on average.
TASK_BYTES = 64 * 1024 * 1024
# Payloads below this size are never told as copies.
LEAST_COPY = 100
LEVEL = 3

# Fixed values of the public seekable format: a skippable frame whose last bytes are
# the number of frames, a descriptor, and a magic number.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
FOOTER, FOOTER_BYTES = "<IBI", 9
ENTRY, ENTRY_BYTES = "<II", 8
SKIP_HEADER = "<II"

# Fixed values of the WARC 1.1 standard.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http; msgtype=response"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
# Time of capture where the table has none.
NO_DATE = "1970-01-01T00:00:00Z"

INDEX_SCHEMA = pa.schema([
    ("bundle", pa.string()), ("page_id", pa.int64()), ("record_id", pa.string()), ("frame", pa.int64()),
    ("frame_offset", pa.int64()), ("length", pa.int64()), ("record_type", pa.string()),
])
INDEX_TYPE = (
    "bundle string, page_id long, record_id string, frame long, frame_offset long, length long, record_type string"
)
RECORD_SCHEMA = pa.schema([
    ("page_id", pa.int64()), ("record_id", pa.string()), ("url", pa.string()), ("record_type", pa.string()),
    ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("payload", pa.binary()),
])
RECORD_TYPE = (
    "page_id long, record_id string, url string, record_type string, refers_to long, payload_bytes long,"
    " payload_digest string, payload binary"
)


# Characters of an address that stay as they are; others are percent-encoded, line ends among them.
PLAIN = "".join(map(chr, range(0x21, 0x7F)))
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:pagemill:warc")


class Page(NamedTuple):
    """What a record is made of. A revisit has no body, and `refers_to` is the page that has it."""

    page_id: int | None
    url: str | None
    digest: str
    size: int
    revisit: bool
    refers_to: int | None
    body: bytes | None


def shared_record_id(digest: str) -> str:
    """Id of the one response that holds a payload which others may revisit."""
    return str(uuid.uuid5(NAMESPACE, digest))


def record_bytes(page: Page, record_id: str) -> bytes:
    """One WARC record: a response with its payload, or a revisit without one."""
    head = HTTP_HEAD.format(page.size).encode()
    block = head if page.revisit else head + page.body
    fields = [
        ("WARC-Type", "revisit" if page.revisit else "response"),
        ("WARC-Record-ID", f"<urn:uuid:{record_id}>"),
        ("WARC-Date", NO_DATE),
        ("WARC-Payload-Digest", f"sha256:{page.digest}"),
        ("Content-Type", HTTP_TYPE),
    ]
    if page.url is not None:
        fields.append(("WARC-Target-URI", quote(page.url, safe=PLAIN)))
    if page.page_id is not None:
        fields.append(("Page-Id", str(page.page_id)))
    if page.revisit:
        fields.append(("WARC-Profile", REVISIT_PROFILE))
        fields.append(("WARC-Refers-To", f"<urn:uuid:{shared_record_id(page.digest)}>"))
        if page.refers_to is not None:
            fields.append(("Refers-To-Page-Id", str(page.refers_to)))
    fields.append(("Content-Length", str(len(block))))
    lines = "".join(f"{name}: {value}\r\n" for name, value in fields).encode()
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")
    return dict(line.split(": ", 1) for line in lines[1:])


def parse_record(content: memoryview, start: int) -> tuple[tuple, int]:
    """The record that begins at `start`, as a row of RECORD_SCHEMA, and where the next one begins."""
    # Headers are short, whatever the length of the payload.
    end, reach = -1, 4096
    while end < 0:
        window = bytes(content[start : start + reach])
        end = window.find(b"\r\n\r\n")
        if end < 0 and start + reach >= len(content):
            raise ValueError("record without an end of its header")
        reach *= 4
    if not window.startswith(VERSION):
        raise ValueError("no record begins here")
    fields = _fields(window[:end])
    block_start, length = start + end + 4, int(fields["Content-Length"])
    block = bytes(content[block_start : block_start + length])
    http, _, payload = block.partition(b"\r\n\r\n")
    size, digest = int(_fields(http)["Content-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha256:")
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"payload of record {fields['WARC-Record-ID']} does not fit its digest")
    page, first = fields.get("Page-Id"), fields.get("Refers-To-Page-Id")
    row = (
        None if page is None else int(page),
        fields["WARC-Record-ID"].removeprefix("<urn:uuid:").removesuffix(">"),
        fields.get("WARC-Target-URI"),
        fields["WARC-Type"],
        None if first is None else int(first),
        size,
        digest,
        None if revisit else payload,
    )
    return row, block_start + length + 4


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The store of a path or address, and the path within it."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(path)


class BundleWriter:
    """One bundle: frames of whole records, each of which is decompressed on its own, then the seek table."""

    def __init__(self, sink: BinaryIO, name: str, frame_bytes: int) -> None:
        self.sink, self.name, self.frame_bytes = sink, name, frame_bytes
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
        self.frames: list[tuple[int, int]] = []
        self.held, self.written, self.records = bytearray(), 0, 0

    def add(self, page: Page, least_copy: int) -> tuple:
        """Append a record, and say where it is, as a row of INDEX_SCHEMA."""
        shared = page.size >= least_copy and not page.revisit
        own = f"{self.name}/{self.records}"
        record_id = shared_record_id(page.digest) if shared else str(uuid.uuid5(NAMESPACE, own))
        record = record_bytes(page, record_id)
        if self.held and len(self.held) + len(record) > self.frame_bytes:
            self.flush()
        at = (len(self.frames), len(self.held))
        self.held += record
        self.records += 1
        kind = "revisit" if page.revisit else "response"
        return self.name, page.page_id, record_id, *at, len(record), kind

    def flush(self) -> None:
        frame = self.compressor.compress(bytes(self.held))
        self.sink.write(frame)
        self.frames.append((len(frame), len(self.held)))
        self.written += len(frame)
        self.held.clear()

    def close(self) -> None:
        if self.held:
            self.flush()
        table = b"".join(struct.pack(ENTRY, *frame) for frame in self.frames)
        table += struct.pack(FOOTER, len(self.frames), 0, SEEKABLE_MAGIC)
        self.sink.write(struct.pack(SKIP_HEADER, SKIPPABLE_MAGIC, len(table)) + table)
        self.sink.close()


def read_seek_table(source: pa.NativeFile) -> list[tuple[int, int, int]]:
    """(start, compressed size, size) of every frame, from the end of a bundle."""
    size = source.size()
    count, descriptor, magic = struct.unpack(FOOTER, source.read_at(FOOTER_BYTES, size - FOOTER_BYTES))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("bundle without a seek table")
    entry = ENTRY_BYTES + (4 if descriptor & 0x80 else 0)
    body = source.read_at(count * entry, size - FOOTER_BYTES - count * entry)
    frames, start = [], 0
    for i in range(count):
        packed, whole = struct.unpack_from(ENTRY, body, i * entry)
        frames.append((start, packed, whole))
        start += packed
    return frames


def _writer(folder: str, frame_bytes: int, bundle_bytes: int, least_copy: int) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            store, root = file_system(folder)
            bundle = None
            for batch in batches:
                columns = batch.columns
                for i in range(batch.num_rows):
                    if bundle is None:
                        # A new name for every attempt; only names in the index count.
                        name = f"{uuid.uuid4().hex}.warc.zst"
                        bundle = BundleWriter(store.open_output_stream(f"{root}/{name}", compression=None), name, frame_bytes)
                    yield bundle.add(Page(*[c[i].as_py() for c in columns]), least_copy)
                    if bundle.written >= bundle_bytes:
                        bundle.close()
                        bundle = None
            if bundle is not None:
                bundle.close()

        return batched(rows(), INDEX_SCHEMA, size=lambda row: 150)

    return run


def _frames(folder: str) -> Callable:
    schema = pa.schema([("bundle", pa.string()), ("frame", pa.int64()), ("start", pa.int64()), ("packed", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            store, root = file_system(folder)
            for batch in batches:
                for name in batch.column(0).to_pylist():
                    with store.open_input_file(f"{root}/{name}") as source:
                        for number, (start, packed, _) in enumerate(read_seek_table(source)):
                            yield name, number, start, packed

        return batched(rows(), schema)

    return run


def _records(folder: str) -> Callable:
    """All records of frames (bundle, start, packed)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            store, root = file_system(folder)
            for batch in batches:
                for name, start, packed in zip(*[c.to_pylist() for c in batch.columns]):
                    with store.open_input_file(f"{root}/{name}") as source:
                        frame = source.read_at(packed, start)
                    content, at = memoryview(zstandard.decompress(frame)), 0
                    while at < len(content):
                        row, at = parse_record(content, at)
                        yield row

        return batched(rows(), RECORD_SCHEMA, size=lambda row: 300 + len(row[-1] or b""))

    return run


def _fetch(folder: str) -> Callable:
    """Single records at (bundle, frame, frame_offset), sorted so that a frame is read once."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            store, root = file_system(folder)
            opened, table, at, content = None, [], None, memoryview(b"")
            for batch in batches:
                for name, number, offset in zip(*[c.to_pylist() for c in batch.columns]):
                    if name != opened:
                        source = store.open_input_file(f"{root}/{name}")
                        opened, table, at = name, read_seek_table(source), None
                    if number != at:
                        start, packed, _ = table[number]
                        content, at = memoryview(zstandard.decompress(source.read_at(packed, start))), number
                    yield parse_record(content, offset)[0]

        return batched(rows(), RECORD_SCHEMA, size=lambda row: 300 + len(row[-1] or b""))

    return run


def with_revisits(pages: DataFrame, least_copy: int = LEAST_COPY) -> DataFrame:
    """Columns of `Page` for (page_id, url, body): of equal payloads, all but that of the smallest id are revisits.

    Digests are counted before they are shuffled, and only digests met more than once are looked up.
    """
    pages = pages.withColumns({"digest": F.sha2("body", 256), "size": F.octet_length("body").cast("long")})
    rank = F.struct(F.col("page_id").isNull().alias("none"), "page_id")
    counts = (
        pages.filter(F.col("size") >= least_copy).groupBy("digest", "page_id").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("digest").agg(F.sum("n").alias("n"), F.min(F.struct(rank.alias("id"), "n")).alias("first"))
        .filter(F.col("n") > 1)
    )
    counts = stage(counts, "payloads")
    own = F.col("page_id").eqNullSafe(F.col("first.id.page_id"))
    if not counts.filter(F.col("first.n") > 1).isEmpty():
        # The smallest id has several rows: one of them is chosen by its place, which has to stay the same.
        pages = stage(pages.withColumn("row", F.monotonically_increasing_id()), "pages")
        chosen = F.min(F.struct(rank.alias("id"), "row")).alias("first")
        counts = pages.filter(F.col("size") >= least_copy).groupBy("digest").agg(F.count(F.lit(1)).alias("n"), chosen)
        counts = counts.filter(F.col("n") > 1)
        own = F.col("row") == F.col("first.row")
    found = lookup_join(pages, counts.select("digest", "first"), "digest", "left")
    revisit = F.col("first").isNotNull() & ~own
    return found.select(
        "page_id", "url", "digest", "size", revisit.alias("revisit"),
        F.when(revisit, F.col("first.id.page_id")).alias("refers_to"),
        F.when(~revisit, F.col("body")).alias("body"),
    )


class Archive(NamedTuple):
    """Bundles in a folder, and the index of their records: bundle, frame, and offset within the frame."""

    folder: str
    index: DataFrame

    def frames(self) -> DataFrame:
        """(bundle, frame, start, packed) of all frames, from the seek tables."""
        names = self.index.select("bundle").distinct()
        return names.mapInArrow(_frames(self.folder), "bundle string, frame long, start long, packed long")

    def read(self) -> DataFrame:
        """All records. Frames, not bundles, are dealt to tasks."""
        frames = stage(self.frames(), "frames")
        packed = frames.agg(F.sum("packed")).first()[0] or 0
        tasks = max(frames.sparkSession.sparkContext.defaultParallelism, -(-packed // TASK_BYTES))
        dealt = frames.repartition(tasks, "bundle", "frame").select("bundle", "start", "packed")
        return dealt.mapInArrow(_records(self.folder), RECORD_TYPE)

    def fetch(self, index: DataFrame) -> DataFrame:
        """The records of some rows of the index; only their frames are read."""
        places = index.select("bundle", "frame", "frame_offset").repartition("bundle", "frame")
        places = places.sortWithinPartitions("bundle", "frame", "frame_offset")
        return places.mapInArrow(_fetch(self.folder), RECORD_TYPE)


def write_archive(
    df: DataFrame,
    folder: str | None = None,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least_copy: int = LEAST_COPY,
    frame_bytes: int = FRAME_BYTES,
    bundle_bytes: int = BUNDLE_BYTES,
) -> Archive:
    """Write one WARC record per row into bundles below `folder`, a place that all executors reach.

    A bundle is a row of Zstandard frames of about `frame_bytes` of whole records, each compressed on its
    own, and a seek table in the public seekable format at the end, so any frame can be read alone. The
    index maps every record to its bundle, frame and offset within the frame; it is written once all
    bundles are, so what a failed attempt left has no rows there. Without `folder` the application's own
    one is used.

    Payloads of at least `least_copy` bytes that are equal are stored once: by the smallest key (null
    last; of rows that repeat it, one). The others become revisits of it, with the digest and size of the
    payload. A null payload is empty; a null key or address leaves its field out, and revisits of a row
    without key have none in `refers_to`. Characters that may not stand in an address are percent-encoded.
    An empty table gives no bundles. Other columns are not looked at.
    """
    spark = df.sparkSession
    folder = folder or work_path(spark, "warc")
    store, root = file_system(folder)
    store.create_dir(root, recursive=True)
    pages = df.select(
        F.col(f"`{key}`").cast("long").alias("page_id"),
        F.col(f"`{url}`").cast("string").alias("url"),
        F.coalesce(F.col(f"`{payload}`").cast("binary"), F.lit(b"")).alias("body"),
    )
    records = with_revisits(pages, least_copy)
    index = records.mapInArrow(_writer(folder, frame_bytes, bundle_bytes, least_copy), INDEX_TYPE)
    return Archive(folder, stage(index, "warc-index"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC records, read back from their bundles."""
    records = write_archive(read_table(spark, sf_dir, "pages")).read()
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP11_SQL = """
WITH payloads AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), placed AS (
  SELECT *, min(page_id) OVER w AS first_id,
    payload_bytes >= 100 AND row_number() OVER (w ORDER BY page_id NULLS LAST) > 1 AS revisit
  FROM payloads WINDOW w AS (PARTITION BY payload_digest)
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN revisit THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN revisit THEN first_id END AS refers_to
FROM placed
"""
