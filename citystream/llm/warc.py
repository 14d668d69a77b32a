"""WARC archives in seekable Zstandard bundles.

Writing: the rows of a task go to bundles in the shared folder. Records are
grouped into frames of about ``FRAME`` bytes, each an independent Zstandard
frame; a bundle ends with a seek table, a skippable frame that lists every
frame's sizes, so ordinary tools can read the file and a reader can jump to a
frame. The index maps each record to bundle, frame, offset in the frame and
length. Bundle names are new for every attempt and the index is written as a
table, whose commit takes one attempt of each task: a lost executor leaves at
most a file that no index names.

Repeated payloads: of records with equal payloads of at least ``min_bytes``
bytes, the one with the largest id is a ``response``; the others are
``revisit`` records that name it and hold no payload.

Defined results: a null html is an empty payload, a null URL an empty target.
Rows that repeat the largest id are all responses. Rows without an id are kept;
they revisit a record with an id where there is one. An empty table gives an
empty index. Other columns are not carried along.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from contextlib import closing
from itertools import chain

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citystream.llm.common import ARROW, bounded, sliced
from citystream.session import prepare, scratch_path

#: Bytes of records in a frame, and compressed bytes of a bundle, after which the next one begins.
FRAME, BUNDLE = 1 << 18, 1 << 27
#: The seek table's frame and footer as the seekable format fixes them.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1

INDEX = "page_id long, bundle string, frame int, start long, length long"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    """``rows`` as Arrow columns, in which large ids stay exact beside nulls."""
    fields = [c.split() for c in schema.split(", ")]
    columns = zip(*rows) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(x, ARROW[kind]) for x, (_, kind) in zip(columns, fields)], names=[n for n, _ in fields])


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id: int | None, url: str, payload: bytes, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """One WARC record. A revisit keeps the HTTP head, whose length field tells the payload's."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _urn(page_id)), ("WARC-Date", date),
            ("WARC-Target-URI", "".join(c if c > " " else f"%{ord(c):02X}" for c in url)),
            ("WARC-Payload-Digest", f"sha1:{digest(payload)}")]
    if revisit:
        head += [("WARC-Refers-To", _urn(refers_to)),
                 ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    else:
        block += payload
    head += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    return b"".join([b"WARC/1.1\r\n", *(f"{k}: {v}\r\n".encode() for k, v in head), b"\r\n", block, b"\r\n\r\n"])


def parse(data: bytes, start: int = 0) -> tuple[dict[str, str], bytes, bytes, int]:
    """(headers, HTTP head, payload, end) of the record at ``start``."""
    stop = data.index(b"\r\n\r\n", start)
    lines = data[start:stop].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"no record at {start}")
    head = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    block = data[stop + 4:stop + 4 + int(head["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return head, http, payload, stop + 4 + len(block) + 4


class BundleWriter:
    """One bundle. ``add`` gives the record's (frame, start, length)."""

    def __init__(self, folder: str):
        store, path = fs.FileSystem.from_uri(folder)
        store.create_dir(path, recursive=True)
        self.name = f"{uuid.uuid4().hex}.warc.zst"
        self.out = store.open_output_stream(f"{path}/{self.name}", compression=None)
        self.packer = zstandard.ZstdCompressor(level=3)
        self.frames: list[tuple[int, int]] = []
        self.open: list[bytes] = []
        self.filled = self.written = 0

    def add(self, data: bytes) -> tuple[int, int, int]:
        if self.filled and self.filled + len(data) > FRAME:
            self.end_frame()
        at = (len(self.frames), self.filled, len(data))
        self.open.append(data)
        self.filled += len(data)
        return at

    def end_frame(self) -> None:
        packed = self.packer.compress(b"".join(self.open))
        self.out.write(packed)
        self.frames.append((len(packed), self.filled))
        self.written += len(packed)
        self.open, self.filled = [], 0

    def close(self) -> None:
        if self.open:
            self.end_frame()
        table = b"".join(struct.pack("<II", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.out.close()


class BundleReader:
    """Random access to a bundle's frames through its seek table."""

    def __init__(self, uri: str):
        store, path = fs.FileSystem.from_uri(uri)
        self.file = store.open_input_file(path)
        size = self.file.size()
        n, _, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != SEEKABLE:
            raise ValueError(f"{uri} has no seek table")
        table = self.file.read_at(8 * n, size - 9 - 8 * n)
        self.frames, at = [], 0
        for packed, plain in struct.iter_unpack("<II", table):
            self.frames.append((at, packed, plain))
            at += packed

    def frame(self, i: int) -> bytes:
        at, packed, plain = self.frames[i]
        return zstandard.ZstdDecompressor().decompress(self.file.read_at(packed, at), max_output_size=max(plain, 1))

    def record(self, frame: int, start: int, length: int) -> bytes:
        return self.frame(frame)[start:start + length]

    def close(self) -> None:
        self.file.close()


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Writes the bundles and their index (``folder/index``); returns the index."""
    spark = prepare(pages.sparkSession)
    rows = pages.select(pages[id_col].cast("long").alias("page_id"), F.coalesce(pages[url_col], F.lit("")).alias("url"),
                        F.coalesce(pages[html_col], F.lit("")).alias("html"))
    keyed = rows.withColumn("sha", F.unhex(F.sha1(F.encode("html", "UTF-8"))))
    # Only payloads met more than once: at most one short row for each.
    again = (keyed.where(F.octet_length("html") >= min_bytes).groupBy("sha")
             .agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 AND first IS NOT NULL")
             .select("sha", "first"))
    marked = (keyed.join(bounded(again), "sha", "left")
              .withColumn("revisit", F.expr("first IS NOT NULL AND NOT (page_id <=> first)"))
              .select("page_id", "url", "html", "first", "revisit"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle = None
        for batch in chain.from_iterable(map(sliced, batches)):
            found = []
            for own, url, html, other, revisit in zip(*(c.to_pylist() for c in batch.columns)):
                if bundle is None or bundle.written >= BUNDLE:
                    if bundle:
                        bundle.close()
                    bundle = BundleWriter(folder)
                found.append((own, bundle.name,
                              *bundle.add(record(own, url, html.encode(), other if revisit else None, revisit, date))))
            yield _batch(found, INDEX)
        if bundle:
            bundle.close()

    marked.mapInArrow(work, INDEX).write.parquet(f"{folder}/index")
    return spark.read.parquet(f"{folder}/index")


def read_archives(index: DataFrame, folder: str) -> DataFrame:
    """Every record of the indexed bundles, read frame by frame: (page_id,
    payload_bytes, payload_digest, record_type, refers_to)."""
    prepare(index.sparkSession)
    frames = index.groupBy("bundle", "frame").agg(F.sum("length").alias("plain"), F.count("*").alias("n"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, name = None, None
        try:
            for batch in batches:
                for bundle, frame, plain, n in zip(*(c.to_pylist() for c in batch.columns)):
                    if bundle != name:
                        if reader:
                            reader.close()
                        reader, name = BundleReader(f"{folder}/{bundle}"), bundle
                    data, at, found = reader.frame(frame), 0, []
                    while at < len(data):
                        head, http, payload, at = parse(data, at)
                        response = head["WARC-Type"] == "response"
                        own, other = (head.get(k, "<urn:page:>")[10:-1] for k in ("WARC-Record-ID", "WARC-Refers-To"))
                        found.append((
                            int(own) if own else None,
                            len(payload) if response else int(http.rpartition(b"Content-Length: ")[2]),
                            digest(payload) if response else head["WARC-Payload-Digest"][5:],
                            head["WARC-Type"], int(other) if other else None))
                    if (len(data), len(found)) != (plain, n):
                        raise ValueError(f"frame {frame} of {bundle} doesn't hold what the index says")
                    yield _batch(found, RECORDS)
        finally:
            if reader:
                reader.close()

    # The index is small, its frames aren't: a count of partitions that is kept, about 64 MB of records each.
    total = frames.agg(F.sum("plain")).first()[0] or 0
    parts = max(index.sparkSession.sparkContext.defaultParallelism, total >> 26)
    return frames.repartition(parts, "bundle", "frame").sortWithinPartitions("bundle", "frame").mapInArrow(work, RECORDS)


def read_record(spark: SparkSession, index: DataFrame, folder: str, page_id: int) -> list[bytes]:
    """The records of one id, each by one frame read (several if the id was repeated)."""
    found = []
    for r in index.where(F.col("page_id") == page_id).collect():
        with closing(BundleReader(f"{folder}/{r.bundle}")) as reader:
            found.append(reader.record(r.frame, r.start, r.length))
    return found


def archive_round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Archives ``pages`` in the shared folder and reads the archives back."""
    folder = scratch_path(prepare(pages.sparkSession), "warc")
    return read_archives(write_archives(pages, folder, min_bytes=min_bytes), folder)
