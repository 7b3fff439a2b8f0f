"""WARC archives as seekable Zstandard bundles.

Each task writes one bundle. Records are gathered into frames of about a megabyte, each compressed by itself, and the
bundle ends with a seek table in a skippable frame: the compressed and the plain size of every frame. Any Zstandard
reader reads the bundle from front to end; one that knows the table reads a single frame. The index that is returned maps
a record to its bundle, frame and offset within the frame.

A bundle is written under a name of its own and is part of the archive only if the index names it. The index is written
by Spark, after the bundles; what an attempt left that was lost or run twice is never read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import settings
from sluice.operators.joins import lookup_join, settle
from sluice.session import new_folder

FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 1 << 28
LEVEL = 3
#: Numbers of the seekable format: a skippable frame's, and the one that ends the file.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
INDEX = "page_id bigint, bundle string, frame bigint, offset bigint, length bigint"
RECORD_DATE = "2000-01-01T00:00:00Z"
#: Pages that a task is handed at a time, by number and by bytes.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "8388608"}


class BundleWriter:
    """Records in, frames out; closing adds the seek table."""

    def __init__(self, out, frame_bytes: int = FRAME_BYTES):
        self.out, self.frame_bytes = out, frame_bytes
        self.packer = zstandard.ZstdCompressor(level=LEVEL)
        self.frames: list[tuple[int, int]] = []
        self.waiting: list[bytes] = []
        self.size = 0

    def add(self, record: bytes) -> tuple[int, int]:
        """The frame and the offset in it that the record has got."""
        if self.size and self.size + len(record) > self.frame_bytes:
            self._frame()
        place = len(self.frames), self.size
        self.waiting.append(record)
        self.size += len(record)
        return place

    def _frame(self) -> None:
        packed = self.packer.compress(b"".join(self.waiting))
        self.out.write(packed)
        self.frames.append((len(packed), self.size))
        self.waiting, self.size = [], 0

    def written(self) -> int:
        return sum(size for size, _ in self.frames)

    def close(self) -> None:
        if self.size:
            self._frame()
        table = b"".join(struct.pack("<II", *sizes) for sizes in self.frames)
        table += struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.out.close()


class BundleReader:
    """Single frames of a bundle, found by its seek table."""

    def __init__(self, source):
        self.source, end = source, source.size()
        source.seek(end - 9)
        count, flags, magic = struct.unpack("<IBI", source.read(9))
        if magic != SEEKABLE:
            raise ValueError("the file has no seek table")
        entry = 12 if flags & 0x80 else 8
        source.seek(end - 9 - entry * count)
        table = source.read(entry * count)
        self.frames, place = [], 0
        for i in range(count):
            packed, plain = struct.unpack_from("<II", table, entry * i)
            self.frames.append((place, packed, plain))
            place += packed
        self.held: tuple[int, bytes] = (-1, b"")

    def frame(self, number: int) -> bytes:
        if self.held[0] != number:
            place, packed, plain = self.frames[number]
            self.source.seek(place)
            content = zstandard.ZstdDecompressor().decompress(self.source.read(packed), max_output_size=plain)
            self.held = number, content
        return self.held[1]

    def record(self, frame: int, offset: int, length: int) -> bytes:
        return self.frame(frame)[offset:offset + length]


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_of(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """A response with its payload, or a revisit, which keeps only the payload's digest and HTTP header."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    # A line end in an address would end the header.
    target = re.sub(r"[\r\n]", lambda m: f"%{ord(m[0]):02X}", url or "")
    header = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}",
              f"WARC-Date: {RECORD_DATE}", f"WARC-Target-URI: {target}",
              f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}"]
    if revisit:
        header += [f"WARC-Refers-To: {record_id(refers_to)}",
                   "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    header += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(header).encode() + block + b"\r\n\r\n"


def parsed(record: bytes) -> dict:
    """What a record says: type, ids, digest, size of the payload; the digest is worked out anew where it is present."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest, revisit = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError(f"record {fields['WARC-Record-ID']} is damaged")

    def number(name):
        text = fields.get(name, "").removeprefix("<urn:page:").removesuffix(">")
        return int(text) if text else None

    return {"page_id": number("WARC-Record-ID"), "payload_bytes": size, "payload_digest": digest,
            "record_type": fields["WARC-Type"], "refers_to": number("WARC-Refers-To"),
            "url": fields["WARC-Target-URI"], "payload": None if revisit else payload}


def with_roles(pages: DataFrame, least_bytes: int = 0, max_broadcast_bytes: int | None = None) -> DataFrame:
    """Pages with ``refers_to`` and ``revisit``: of equal payloads the largest page_id is the response.

    Equal payloads are told by SHA-1 and length. Only digests that several pages share are looked up, so as long as these
    are few no payload is moved at all; beyond that a payload that many pages share may be split.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                        payload.alias("payload"))
    keyed = rows.withColumns({"sha1": F.unhex(F.sha1(F.col("payload").cast("binary"))), "size": F.octet_length("payload")})
    repeated = (keyed.where(F.col("size") >= least_bytes).groupBy("sha1", "size")
                .agg(F.max("page_id").alias("first"), F.count("*").alias("pages")).where("pages > 1").drop("pages"))
    return (lookup_join(keyed, repeated, ["sha1", "size"], "left", max_broadcast_bytes)
            .select("page_id", "url", "payload", "first",
                    (F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))).alias("revisit")))


def write_archives(spark: SparkSession, pages: DataFrame, folder: str, least_bytes: int = 0,
                   frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Write a record for each page into bundles below ``folder``; returns the index of the records.

    ``folder`` is one that executors can reach. Columns used are ``page_id``, ``url`` and ``html``. A null html is an empty
    payload and a null url an empty address. Repeated rows are all written; those with the largest page_id of equal
    payloads are responses, each of them. A page without page_id is a response only where all of equal payload have none.
    No pages give an empty index and no bundle.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(folder)
        writer = name = None
        for batch in batches:
            entries = []
            payloads = batch.column(2).cast(pa.large_binary())
            for i in range(batch.num_rows):
                if writer is None:
                    name = f"{uuid.uuid4().hex}.warc.zst"
                    writer = BundleWriter(store.open_output_stream(f"{root}/{name}", compression=None), frame_bytes)
                page, url, first, revisit = (batch.column(c)[i].as_py() for c in (0, 1, 3, 4))
                record = record_of(page, url, payloads[i].as_py(), first, revisit)
                entries.append((page, name, *writer.add(record), len(record)))
                if writer.written() >= bundle_bytes:
                    writer.close()
                    writer = None
            if not entries:
                continue
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*entries), (pa.int64(), pa.string(), *[pa.int64()] * 3))],
                names=["page_id", "bundle", "frame", "offset", "length"])
        if writer is not None:
            writer.close()

    spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(
        spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder))
    roles = with_roles(pages, least_bytes)
    with settings(spark, BATCHES):
        return settle(roles.mapInArrow(run, INDEX))


def stray_bundles(spark: SparkSession, index: DataFrame, folder: str) -> DataFrame:
    """``path`` of the bundles below ``folder`` that the index does not name: what lost or repeated attempts have left.

    They may be deleted once the index is written. Only the folder is listed.
    """
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder).select("path")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        files = spark.createDataFrame([], "path string")
    named = files.withColumn("bundle", F.substring_index("path", "/", -1))
    return named.join(index.select("bundle").distinct(), "bundle", "left_anti").select("path")


def read_archives(index: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """The records that the index names, read frame by frame; with ``payload`` (null for revisits) if asked for."""
    kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(),
             "record_type": pa.string(), "refers_to": pa.int64()} | ({"payload": pa.binary()} if payloads else {})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(folder)
        name = reader = None
        for batch in batches:
            # Some records at a time, as they come back with their payloads.
            for start in range(0, batch.num_rows, 256):
                found = []
                for row in batch.slice(start, 256).to_pylist():
                    if row["bundle"] != name:
                        if reader is not None:
                            reader.source.close()
                        name, reader = row["bundle"], BundleReader(store.open_input_file(f"{root}/{row['bundle']}"))
                    found.append(parsed(reader.record(row["frame"], row["offset"], row["length"])))
                yield pa.RecordBatch.from_arrays([pa.array([f[n] for f in found], k) for n, k in kinds.items()],
                                                 names=list(kinds))
        if reader is not None:
            reader.source.close()

    fields = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    return index.mapInArrow(run, fields + (", payload binary" if payloads else ""))


def archived(spark: SparkSession, pages: DataFrame, least_bytes: int = 0, folder: str | None = None) -> DataFrame:
    """Pages written to archives and read back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Without a ``folder`` the archives go to a fresh one in the shared folder.
    """
    folder = folder or new_folder(spark, "warc")
    return read_archives(write_archives(spark, pages, folder, least_bytes), folder)
