"""WARC archives as seekable Zstandard bundles.

Records are grouped into frames that decompress on their own; a seek table in a skippable frame
ends each bundle, as the seekable format has it. The index maps a record id to bundle, frame and
the offset within the decompressed frame. Payloads seen before become revisit records.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringtrail.llm.common import open_file, put_file
from ringtrail.staging import Staging

SUFFIX = ".warc.zst"
FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 16 << 20
MIN_REVISIT_BYTES = 0
LEVEL = 3
WARC_DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# Fixed values of the seekable format: skippable frame, seek table magic, footer size.
SKIPPABLE, SEEKABLE, FOOTER = 0x184D2A5E, 0x8F92EAB1, 9


# --- records ------------------------------------------------------------------------------


def record_id(page_id: int | None) -> str:
    return "<urn:page:none>" if page_id is None else f"<urn:page:{page_id}>"


def page_of(record: str) -> int | None:
    text = record.removeprefix("<urn:page:").removesuffix(">")
    return None if text == "none" else int(text)


def digest_text(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def make_record(page_id, url: str | None, payload: bytes, sha1_hex: str, first: int | None, revisit: bool) -> bytes:
    """One WARC record; a revisit keeps the HTTP header, whose length is that of the full payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    address = (url or "about:blank").replace("\r", "%0D").replace("\n", "%0A")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {WARC_DATE}",
        f"WARC-Target-URI: {address}",
        f"WARC-Payload-Digest: sha1:{digest_text(sha1_hex)}",
        "Content-Type: application/http; msgtype=response",
    ]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(first)}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes, at: int) -> tuple[dict[str, str], bytes, bytes, int]:
    """(WARC fields, HTTP header, payload, offset of the next record) of the record at an offset."""
    stop = data.index(b"\r\n\r\n", at)
    lines = data[at:stop].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"no record at {at}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    begin = stop + 4
    block = data[begin : begin + int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, http, payload, begin + len(block) + 4


# --- bundles ------------------------------------------------------------------------------


class Bundle:
    """Frames of one file, and its seek table."""

    def __init__(self):
        self.frames: list[bytes] = []
        self.entries: list[tuple[int, int]] = []
        self.size = 0

    def add(self, data: bytes, compressor: zstandard.ZstdCompressor) -> None:
        frame = compressor.compress(data)
        self.frames.append(frame)
        self.entries.append((len(frame), len(data)))
        self.size += len(frame)

    def to_bytes(self) -> bytes:
        table = b"".join(struct.pack("<II", *e) for e in self.entries)
        footer = struct.pack("<IBI", len(self.entries), 0, SEEKABLE)
        head = struct.pack("<II", SKIPPABLE, len(table) + len(footer))
        return b"".join(self.frames) + head + table + footer


def seek_table(data: bytes) -> list[tuple[int, int, int]]:
    """(offset, compressed size, decompressed size) of each frame, from the end of a bundle."""
    count, flags, magic = struct.unpack_from("<IBI", data, len(data) - FOOTER)
    if magic != SEEKABLE:
        raise ValueError("no seek table at the end")
    width = 12 if flags & 0x80 else 8
    begin = len(data) - FOOTER - count * width
    out, offset = [], 0
    for k in range(count):
        packed, plain = struct.unpack_from("<II", data, begin + k * width)
        out.append((offset, packed, plain))
        offset += packed
    return out


def read_record(data: bytes, frame: int, offset: int) -> tuple[dict[str, str], bytes, bytes]:
    """The record at an index entry: only its frame is decompressed."""
    start, packed, plain = seek_table(data)[frame]
    text = zstandard.ZstdDecompressor().decompress(data[start : start + packed], max_output_size=plain)
    return parse_record(text, offset)[:3]


class Reader:
    """Records of one stored bundle by frame and offset: reads its seek table and the frames asked for."""

    def __init__(self, uri: str):
        self.data = open_file(uri)
        size = self.data.size()
        self.data.seek(size - FOOTER)
        count, flags, magic = struct.unpack("<IBI", self.data.read(FOOTER))
        if magic != SEEKABLE:
            raise ValueError(f"no seek table at the end of {uri}")
        begin = size - FOOTER - count * (12 if flags & 0x80 else 8)
        self.data.seek(begin)
        self.frames = seek_table(self.data.read(size - begin))
        self.unpack = zstandard.ZstdDecompressor()
        self.held: tuple[int, bytes] = (-1, b"")

    def record(self, frame: int, offset: int) -> tuple[dict[str, str], bytes, bytes]:
        """The record at an index entry; neighbours in the index share the frame that is held."""
        if self.held[0] != frame:
            start, packed, plain = self.frames[frame]
            self.data.seek(start)
            self.held = (frame, self.unpack.decompress(self.data.read(packed), max_output_size=plain))
        return parse_record(self.held[1], offset)[:3]


# --- writing and reading --------------------------------------------------------------------


def with_revisits(pages: DataFrame, stage: Staging, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """(_id, _url, _html, _sha, _first, _revisit): null html is empty; the smallest id answers for equal payloads.

    Null ids count as the largest. Rows that repeat id and payload are the same record, written
    once for each row, and never revisit each other.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("_id"),
        F.col(url_col).alias("_url"),
        F.coalesce(html_col, F.lit("")).alias("_html"),
    ).withColumn("_sha", F.sha1(F.col("_html").cast("binary")))
    large = rows.where(F.octet_length("_html") >= MIN_REVISIT_BYTES)
    # Only digests that more than one page has come back to the pages.
    first = large.groupBy("_sha").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("n"))
    first = stage(first.where("n > 1").select(F.col("_sha").alias("_same"), "_first"), "first")
    found = rows.join(first, (F.col("_sha") == F.col("_same")) & (F.octet_length("_html") >= MIN_REVISIT_BYTES), "left")
    other = F.col("_same").isNotNull() & ~F.col("_id").eqNullSafe(F.col("_first"))
    return found.select("_id", "_url", "_html", "_sha", "_first", other.alias("_revisit"))


def write_bundles(
    pages: DataFrame, folder: str, stage: Staging, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """Writes the bundles when evaluated; the index (page_id, bundle, frame, offset) of all records.

    A repeated task replaces its files as a whole. Evaluate once.
    """

    def run(batches) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        part, attempt = task.partitionId(), str(task.taskAttemptId())
        compressor = zstandard.ZstdCompressor(level=LEVEL)
        bundle, number = Bundle(), 0
        frame: list[bytes] = []
        held = 0
        index: list[tuple[int | None, str, int, int]] = []

        def name() -> str:
            return f"{part:06d}-{number:06d}{SUFFIX}"

        def close_bundle() -> pa.RecordBatch:
            nonlocal bundle, number
            put_file(f"{folder}/{name()}", bundle.to_bytes(), attempt)
            columns = list(zip(*index, strict=True))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64())
            index.clear()
            bundle, number = Bundle(), number + 1
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["page_id", "bundle", "frame", "offset"],
            )

        for batch in batches:
            for page, url, html, sha, first, revisit in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                record = make_record(page, url, html.encode(), sha, first, revisit)
                index.append((page, name(), len(bundle.frames), held))
                frame.append(record)
                held += len(record)
                if held >= FRAME_BYTES:
                    bundle.add(b"".join(frame), compressor)
                    frame, held = [], 0
                    if bundle.size >= BUNDLE_BYTES:
                        yield close_bundle()
        if frame:
            bundle.add(b"".join(frame), compressor)
        if index:
            yield close_bundle()

    rows = with_revisits(pages, stage, id_col, url_col, html_col)
    return rows.mapInArrow(run, "page_id bigint, bundle string, frame bigint, offset bigint")


def _told(fields: dict[str, str], http: bytes, payload: bytes) -> tuple:
    """What a record says of its page; a response must hold what its header says."""
    length = int(http.rsplit(b"Content-Length: ", 1)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    first = fields.get("WARC-Refers-To")
    if first is None and (length != len(payload) or digest != base64.b32encode(hashlib.sha1(payload).digest()).decode()):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    refers = None if first is None else page_of(first)
    return page_of(fields["WARC-Record-ID"]), length, digest, fields["WARC-Type"], refers


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], NAMES)


def read_bundles(files: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every record of whole files (content),
    without their index.

    Length and digest of a response are those of the bytes read back, and must agree with its
    header; a revisit has the ones its header gives for the full payload.
    """

    def run(batches) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for data in batch.column(0).to_pylist():
                rows = []
                for start, packed, plain in seek_table(data):
                    text = unpack.decompress(data[start : start + packed], max_output_size=plain)
                    at = 0
                    while at < len(text):
                        fields, http, payload, at = parse_record(text, at)
                        rows.append(_told(fields, http, payload))
                if rows:
                    yield _batch(rows)

    return files.select("content").mapInArrow(run, SCHEMA)


def read_indexed(index: DataFrame, folder: str) -> DataFrame:
    """The same of the records that an index (page_id, bundle, frame, offset) names, each found by its entry.

    Entries are dealt by bundle and come in the order of the file, so that a frame is decompressed once. An
    entry that leads to the record of another page stops the job.
    """

    def run(batches) -> Iterator[pa.RecordBatch]:
        name, reader = None, None
        for batch in batches:
            rows = []
            for page, bundle, frame, offset in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if bundle != name:
                    name, reader = bundle, Reader(f"{folder}/{bundle}")
                told = _told(*reader.record(frame, offset))
                if told[0] != page:
                    raise ValueError(f"the index leads from page {page} to {told[0]}")
                rows.append(told)
            if rows:
                yield _batch(rows)

    entries = index.select("page_id", "bundle", "frame", "offset")
    tasks = max(1, index.select("bundle").distinct().count())
    dealt = entries.repartition(tasks, "bundle").sortWithinPartitions("bundle", "frame", "offset")
    return dealt.mapInArrow(run, SCHEMA)


SCHEMA = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
NAMES = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def archive_round_trip(
    pages: DataFrame, stage: Staging, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """Writes all pages as bundles below the staging folder and reads every record back through the index; see
    read_indexed.

    Without pages there are no files and no rows.
    """
    folder = f"{stage.root}/warc"
    index = stage(write_bundles(pages, folder, stage, id_col, url_col, html_col), "index")
    return read_indexed(index, folder)
