"""WARC archives as seekable Zstandard bundles.

Each task writes the records of its rows into bundle files: records are grouped into independent
Zstandard frames, and a seek table in a skippable frame at the end of the file gives the sizes of
all frames. An index row per record names bundle, frame and the record's place within the frame,
so one record is read by fetching one frame. Pages with equal payloads of at least ``min_bytes`` bytes share
one response record, that of the smallest id; the others are revisit records.

Bundles get a name of their own for every attempt of a task, and only the index of attempts that
succeeded is kept, so lost executors and repeated tasks leave stray files at worst.

Defined results: a NULL html is an empty payload; a NULL url gives a record without target; a page
without an id is a revisit if a page with an id has its payload, else a response; rows repeated
under the smallest id are all responses; an empty table gives no bundle and no rows; other
columns are not stored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardloom.llm.common import table
from wardloom.session import broadcast_if_small, fresh_dir, materialize

FRAME_BYTES = 256 << 10  # a frame is closed once its records reach this size
BUNDLE_BYTES = 128 << 20  # and a bundle once its frames reach this one
LEVEL = 3
WARC_DATE = "1970-01-01T00:00:00Z"  # pages carry no date

# The seekable format, a skippable frame that ends with its own magic number.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEK_MAGIC = 0x8F92EAB1
SEEK_FOOTER = struct.Struct("<IBI")
SEEK_ENTRY = struct.Struct("<II")

INDEX = "page_id {kind}, bundle string, frame int, record_offset long, record_bytes long"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(page_id: int | None, url: str | None, payload: bytes, revisit: bool, refers_to: int | None) -> bytes:
    kind = "revisit" if revisit else "response"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:x-page:{'' if page_id is None else page_id}>"), ("WARC-Date", WARC_DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    fields.append(("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}"))
    if revisit:
        fields += [("WARC-Refers-To", f"<urn:x-page:{refers_to}>"), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(record: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Fields, HTTP head and payload of one record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    http, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    return fields, http, payload


class BundleWriter:
    """One bundle file; ``add`` returns the frame and offset at which a record starts."""

    def __init__(self, folder: str):
        files, root = fs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        name = f"part-{uuid.uuid4().hex}.warc.zst"
        self.path, self._out = f"{folder}/{name}", files.open_output_stream(f"{root}/{name}", compression=None)  # frames are compressed here, one by one
        self._records: list[bytes] = []
        self._filled, self.size, self._sizes = 0, 0, []

    def add(self, record: bytes) -> tuple[int, int]:
        place = (len(self._sizes), self._filled)
        self._records.append(record)
        self._filled += len(record)
        if self._filled >= FRAME_BYTES:
            self._close_frame()
        return place

    def _close_frame(self) -> None:
        frame = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, write_content_size=True).compress(b"".join(self._records))
        self._out.write(frame)
        self._sizes.append((len(frame), self._filled))
        self.size += len(frame)
        self._records, self._filled = [], 0

    def close(self) -> None:
        if self._records:
            self._close_frame()
        entries = b"".join(SEEK_ENTRY.pack(*x) for x in self._sizes) + SEEK_FOOTER.pack(len(self._sizes), 0, SEEK_MAGIC)
        self._out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(entries)) + entries)
        self._out.close()


class BundleReader:
    """Random access to the frames of a bundle through its seek table."""

    def __init__(self, path: str):
        files, place = fs.FileSystem.from_uri(path)
        self._file = files.open_input_file(place)
        end = self._file.size()
        count, _, magic = SEEK_FOOTER.unpack(self._file.read_at(SEEK_FOOTER.size, end - SEEK_FOOTER.size))
        if magic != SEEK_MAGIC:
            raise ValueError(f"{path} has no seek table")
        raw = self._file.read_at(count * SEEK_ENTRY.size, end - SEEK_FOOTER.size - count * SEEK_ENTRY.size)
        self._frames, at = [], 0
        for packed, plain in SEEK_ENTRY.iter_unpack(raw):
            self._frames.append((at, packed, plain))
            at += packed

    def frame(self, number: int) -> bytes:
        at, packed, plain = self._frames[number]
        return zstandard.ZstdDecompressor().decompress(self._file.read_at(packed, at), max_output_size=plain, allow_extra_data=False)

    def record(self, frame: int, offset: int, length: int) -> bytes:
        return self.frame(frame)[offset : offset + length]

    def close(self) -> None:
        self._file.close()


def with_record_types(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``(page_id, url, payload, revisit, refers_to)`` of every page."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.sha1("payload")).withColumn("bytes", F.octet_length("payload"))
    shared = rows.groupBy("digest", "bytes").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    shared = shared.filter((F.col("n") > 1) & (F.col("bytes") >= min_bytes) & F.col("first").isNotNull()).select("digest", "bytes", "first")
    shared = materialize(shared, "payloads")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(broadcast_if_small(shared), ["digest", "bytes"], "left").select("page_id", "url", "payload", revisit.alias("revisit"), F.when(revisit, F.col("first")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Write all pages; returns the written index, one row per record."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        for batch in batches:
            rows = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if writer is None:
                    writer = BundleWriter(folder)
                record = _record(*row)
                rows.append((writer.path, *writer.add(record), len(record)))
                if writer.size >= BUNDLE_BYTES:
                    writer.close()
                    writer = None
            columns = zip(*rows, strict=True) if rows else [[]] * 4
            kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64())
            arrays = [pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["page_id", "bundle", "frame", "record_offset", "record_bytes"])
        if writer is not None:
            writer.close()

    typed = with_record_types(pages, min_bytes)
    return materialize(typed.mapInArrow(write, INDEX.format(kind=typed.schema["page_id"].dataType.simpleString())), "warc-index")


def read_archives(index: DataFrame) -> DataFrame:
    """Read the indexed records back: ``(page_id, payload_bytes, payload_digest, record_type, refers_to)``.

    Frames are dealt over the cluster; each is fetched and unpacked once for all its records.
    """
    kind = index.schema["page_id"].dataType.simpleString()
    frames = index.groupBy("bundle", "frame").agg(F.collect_list(F.struct("record_offset", "record_bytes")).alias("records"))

    def number(uri: str | None) -> int | None:
        found = re.fullmatch(r"<urn:x-page:(-?\d+)>", uri or "")
        return int(found[1]) if found else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, reader, path = [], None, None
            for bundle, frame, records in sorted(zip(*(c.to_pylist() for c in batch.columns), strict=True), key=lambda x: x[:2]):
                if bundle != path:
                    if reader:
                        reader.close()
                    reader, path = BundleReader(bundle), bundle
                plain = reader.frame(frame)
                for place in records:
                    begin = place["record_offset"]
                    fields, http, payload = parse_record(plain[begin : begin + place["record_bytes"]])
                    length = int(re.search(rb"Content-Length: (\d+)", http)[1])
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    if fields["WARC-Type"] == "response" and (len(payload) != length or base32_sha1(payload) != digest):
                        raise ValueError(f"{bundle}: damaged record {fields['WARC-Record-ID']}")
                    rows.append((number(fields["WARC-Record-ID"]), length, digest, fields["WARC-Type"], number(fields.get("WARC-Refers-To"))))
            if reader:
                reader.close()
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    out = frames.repartition("bundle", "frame").mapInArrow(read, schema)
    return out.withColumn("page_id", F.col("page_id").cast(kind)).withColumn("refers_to", F.col("refers_to").cast(kind))


def warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: archive all pages in the shared folder and read the archives back."""
    return read_archives(write_archives(table(spark, sf_dir, "pages"), fresh_dir(spark, "warc")))


#: The same columns from the table itself. DuckDB has no base32, so the digest is spelled in fives of bits.
ORACLE = """
WITH p AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), d AS (
    SELECT *, first_value(page_id) OVER (PARTITION BY hex, payload_bytes ORDER BY page_id) AS first_id FROM p
), b AS (
    SELECT *, list_aggregate([lpad(bin(('0x' || substr(hex, (i + 1)::INT, 1))::INT), 4, '0') FOR i IN range(40)], 'string_agg', '') AS bits FROM d
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
    list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        (substr(bits, (i * 5)::INT + 1, 1)::INT * 16 + substr(bits, (i * 5)::INT + 2, 1)::INT * 8 + substr(bits, (i * 5)::INT + 3, 1)::INT * 4
         + substr(bits, (i * 5)::INT + 4, 1)::INT * 2 + substr(bits, (i * 5)::INT + 5, 1)::INT + 1)::INT, 1) FOR i IN range(32)], 'string_agg', '') AS payload_digest,
    CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM b
"""
