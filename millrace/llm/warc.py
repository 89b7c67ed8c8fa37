"""WARC records in seekable Zstandard bundles, and reading them back whole or by record.

A bundle is a ``.warc.zst`` file: records are grouped into independent Zstandard frames and the
file ends in a skippable frame with the seek table (compressed and raw size of each frame). The
index maps every record to its bundle, frame and place within the raw frame, so that one record
costs one footer and one frame.

Writers name files by task attempt. The index is a Spark table, so it lists the files of the
attempts that Spark accepted; what a lost attempt left behind is never read. Bundles and index go
to a folder that all executors share, through pyarrow's file systems.

Payloads: null counts as empty. Page ids may be null (they sort last when a group's response is
chosen) or repeated: rows that share the least id and the payload are all responses. Null urls are
written as an empty header and read as null; control characters in urls are percent-encoded in the
header and restored. An empty table gives no bundle and an empty result. A payload lies in memory whole while its
record is written or read, and is a frame of its own if it is longer than one. Further columns do not matter.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import common
from millrace.sources import scratch

# Fixed values of the seekable Zstandard format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1

FRAME_BYTES = 512 << 10  # raw bytes after which a frame is closed
BUNDLE_BYTES = 64 << 20  # compressed bytes after which a bundle is closed
LEAST_SHARED = 100  # payload bytes from which equal payloads are written once
DATE = "2024-01-01T00:00:00Z"

INDEX = "page_id long, bundle string, frame int, start long, length long"
RECORD = (
    "page_id long, url string, payload binary, payload_bytes long, payload_digest string, "
    "record_type string, refers_to long"
)


class Bundle:
    """Writer of one bundle."""

    def __init__(self, stream, frame_bytes: int = FRAME_BYTES):
        self.stream, self.sizes, self.raw, self.packed, self.frame_bytes = stream, [], bytearray(), 0, frame_bytes
        self.zstd = zstandard.ZstdCompressor(level=3, write_content_size=True)

    def add(self, record: bytes) -> tuple[int, int, int]:
        """Frame number, place in the raw frame and length of the record."""
        place = (len(self.sizes), len(self.raw), len(record))
        self.raw += record
        if len(self.raw) >= self.frame_bytes:
            self._close_frame()
        return place

    def _close_frame(self) -> None:
        packed = self.zstd.compress(bytes(self.raw))
        self.stream.write(packed)
        self.sizes.append((len(packed), len(self.raw)))
        self.packed += len(packed)
        self.raw = bytearray()

    def close(self) -> None:
        if self.raw:
            self._close_frame()
        table = b"".join(struct.pack("<II", *size) for size in self.sizes)
        footer = struct.pack("<IBI", len(self.sizes), 0, SEEKABLE_MAGIC)
        self.stream.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table) + len(footer)) + table + footer)
        self.stream.close()


class BundleReader:
    """Random access to the frames of one bundle."""

    def __init__(self, uri: str):
        files, path = pafs.FileSystem.from_uri(uri)
        self.file = files.open_input_file(path)
        end = self.file.size()
        frames, flags, magic = struct.unpack("<IBI", self.file.read_at(9, end - 9))
        if magic != SEEKABLE_MAGIC or flags & 0x80:
            raise ValueError(f"no seek table without checksums at the end of {uri}")
        table = self.file.read_at(8 * frames, end - 9 - 8 * frames)
        self.places, at = [], 0
        for packed, raw in struct.iter_unpack("<II", table):
            self.places.append((at, packed, raw))
            at += packed
        self.zstd = zstandard.ZstdDecompressor()

    def frame(self, number: int) -> bytes:
        at, packed, raw = self.places[number]
        return self.zstd.decompress(self.file.read_at(packed, at), max_output_size=raw)

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.file.close()


def _record_id(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def _page_id(record_id: str) -> int | None:
    digits = record_id.removeprefix("<urn:x-page:").removesuffix(">")
    return int(digits) if digits else None


def make_record(page_id: int | None, url: str | None, payload: bytes, digest: str, revisit: bool, first: int | None) -> bytes:
    """One WARC/1.1 record; a revisit keeps the HTTP header with the length and leaves the payload out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    fields = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_record_id(page_id)}",
        f"WARC-Date: {DATE}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        # Percent signs are encoded too, so that decoding restores the url exactly.
        safe = "".join(quote(c) if c == "%" or c.isspace() or not c.isprintable() else c for c in url)
        fields.append(f"WARC-Target-URI: {safe}")
    if revisit:
        fields.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        fields.append(f"WARC-Refers-To: {_record_id(first)}")
    return "\r\n".join(fields).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes, at: int = 0) -> tuple[dict, int]:
    """The record that starts at ``at`` and where the next one starts. The digest of a response is taken anew."""
    head = raw.index(b"\r\n\r\n", at)
    fields = dict(line.split(": ", 1) for line in raw[at:head].decode().split("\r\n")[1:])
    begin = head + 4
    end = begin + int(fields["Content-Length"])
    split = raw.index(b"\r\n\r\n", begin, end)
    http = dict(line.split(": ", 1) for line in raw[begin:split].decode().split("\r\n")[1:])
    revisit = fields["WARC-Type"] == "revisit"
    payload = None if revisit else raw[split + 4 : end]
    told = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if not revisit and (found := hashlib.sha256(payload).hexdigest()) != told:
        raise ValueError(f"{fields['WARC-Record-ID']}: payload has digest {found}, its header says {told}")
    uri = fields.get("WARC-Target-URI")
    return {
        "page_id": _page_id(fields["WARC-Record-ID"]),
        "url": None if uri is None else unquote(uri),
        "payload": payload,
        "payload_bytes": int(http["Content-Length"]),
        "payload_digest": told,
        "record_type": fields["WARC-Type"],
        "refers_to": _page_id(fields["WARC-Refers-To"]) if revisit else None,
    }, end + 4


def revisits(pages: DataFrame, least: int = LEAST_SHARED) -> DataFrame:
    """``page_id``, ``payload_digest`` and ``first`` of the records whose payload another record holds.

    Groups are counted with a map-side part. Only groups of two or more meet their rows again, in a
    join whose large partitions adaptive execution splits.
    """
    digests = pages.where(F.col("payload_bytes") >= least).select("page_id", "payload_digest")
    groups = digests.groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    shared = groups.where("n > 1 and first is not null").select("payload_digest", "first")
    again = digests.join(shared, "payload_digest").where("page_id is null or page_id <> first")
    return again.groupBy("page_id", "payload_digest").agg(F.min("first").alias("first"))


def write(
    pages: DataFrame,
    folder: str | None = None,
    url: str = "url",
    payload: str = "html",
    frame_bytes: int = FRAME_BYTES,
    bundle_bytes: int = BUNDLE_BYTES,
) -> DataFrame:
    """Write a record per row (``page_id``, url, payload text) and return the stored index."""
    spark = pages.sparkSession
    common.small_batches(spark)
    folder = folder or scratch.new_path(spark, "warc")
    text = F.coalesce(F.col(payload).cast("string"), F.lit(""))
    rows = pages.select(
        "page_id",
        F.col(url).alias("url"),
        text.alias("payload"),
        F.octet_length(text).alias("payload_bytes"),
        F.sha2(text.cast("binary"), 256).alias("payload_digest"),
    )
    again = common.stored(revisits(rows), "revisits").withColumnsRenamed({"page_id": "again_id", "payload_digest": "same"})
    marked = rows.join(
        again, (F.col("payload_digest") == F.col("same")) & F.col("page_id").eqNullSafe(F.col("again_id")), "left"
    ).select("page_id", "url", "payload", "payload_digest", F.col("same").isNotNull().alias("revisit"), "first")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = pafs.FileSystem.from_uri(folder)
        files.create_dir(path, recursive=True)
        task = TaskContext.get()
        bundle, name = None, None
        for batch in batches:
            places = []
            for row in batch.to_pylist():
                if bundle is None:
                    name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:12]}.warc.zst"
                    bundle = Bundle(files.open_output_stream(f"{path}/{name}", compression=None), frame_bytes)
                record = make_record(
                    row["page_id"], row["url"], row["payload"].encode(), row["payload_digest"], row["revisit"], row["first"]
                )
                places.append((row["page_id"], f"{folder}/{name}", *bundle.add(record)))
                if bundle.packed >= bundle_bytes:
                    bundle.close()
                    bundle = None
            if places:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*places, strict=True), _INDEX_TYPES, strict=True)], names=_INDEX_NAMES
                )
        if bundle is not None:
            bundle.close()

    return common.stored(marked.mapInArrow(work, INDEX), "warc-index")


_INDEX_NAMES = ["page_id", "bundle", "frame", "start", "length"]
_INDEX_TYPES = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
_RECORD_SCHEMA = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("payload", pa.binary()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
    ]
)


def read(index: DataFrame, payload: bool = True) -> DataFrame:
    """All records of the bundles that the index names, one frame in memory at a time."""
    spark: SparkSession = index.sparkSession
    bundles = index.select("bundle").distinct()
    # Paths are tiny: without a number of their own adaptive execution would read all bundles in one task.
    bundles = bundles.repartition(max(1, bundles.count()))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("bundle").to_pylist():
                with BundleReader(uri) as bundle:
                    for number in range(len(bundle.places)):
                        raw, at, records = bundle.frame(number), 0, []
                        while at < len(raw):
                            record, at = parse_record(raw, at)
                            if not payload:
                                record["payload"] = None
                            records.append(record)
                        yield pa.RecordBatch.from_pylist(records, _RECORD_SCHEMA)

    common.small_batches(spark)
    return bundles.mapInArrow(work, RECORD)


def fetch(wanted: DataFrame) -> DataFrame:
    """The records of some index rows: of each bundle the footer and the frames asked for are read."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_bundle: dict[str, list[dict]] = {}
            for row in batch.to_pylist():
                by_bundle.setdefault(row["bundle"], []).append(row)
            for uri, rows in by_bundle.items():
                with BundleReader(uri) as bundle:
                    last, raw = None, b""
                    for row in sorted(rows, key=lambda r: (r["frame"], r["start"])):
                        if row["frame"] != last:
                            last, raw = row["frame"], bundle.frame(row["frame"])
                        record, _ = parse_record(raw[row["start"] : row["start"] + row["length"]])
                        yield pa.RecordBatch.from_pylist([record], _RECORD_SCHEMA)

    return wanted.repartition("bundle").select(*_INDEX_NAMES).mapInArrow(work, RECORD)
