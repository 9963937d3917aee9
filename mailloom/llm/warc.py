"""Web archives as seekable Zstandard bundles.

Each task writes its rows as WARC records into bundles of its own.  Records are
grouped into independent Zstandard frames; a skippable frame at the end holds
the seek table of the public seekable format (compressed and plain size of each
frame).  The index maps a record id to (bundle, frame, offset in the frame,
length).  Bundles get a fresh name in every attempt, and only bundles named in
the index, which Spark commits, are ever read, so a repeated task does no harm.

Of records with equal payloads of ``revisit_from`` bytes or more, the one with
the largest key is written whole and the others as revisits of it.  Only
digests that occur twice or more are joined back, through a stored table, so
the engine can broadcast it if it is small and split skewed digests if not.

Null payloads count as empty, null keys are kept (smaller than any other), and
repeated rows with the largest key are all written whole.
"""

from __future__ import annotations

import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh_dir, stored

REVISIT_FROM = 1000
FRAME_BYTES = 1 << 18
BUNDLE_BYTES = 1 << 28
FRAMES_PER_READ = 64
MOST_READERS = 100_000
# Fixed values of the Zstandard seekable format and of WARC 1.1.
_SKIPPABLE, _SEEKABLE = 0x184D2A5E, 0x8F92EAB1
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "1970-01-01T00:00:00Z"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"


def record_bytes(key: object, url: str | None, payload: bytes, digest: str, size: int,
                 refers_to: object = None) -> bytes:
    """One WARC record; with ``refers_to`` a revisit, which has no payload."""
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    block = _HTTP.format(size).encode() + (payload if refers_to is None else b"")
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if key is None else key}>", f"WARC-Date: {_DATE}",
        f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}",
        *([] if refers_to is None else [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]),
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_records(plain: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, headers, block) of the records of a frame."""
    at = 0
    while at < len(plain):
        end = plain.index(b"\r\n\r\n", at)
        lines = plain[at:end].decode("utf-8", "surrogatepass").split("\r\n")
        headers = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
        size = int(headers["Content-Length"])
        yield at, end + 4 + size + 4 - at, headers, plain[end + 4:end + 4 + size]
        at = end + 4 + size + 4


class BundleWriter:
    """Writes frames and, when closed, the seek table."""

    def __init__(self, stream, level: int = 3):
        self.stream, self.packer = stream, zstandard.ZstdCompressor(level=level)
        self.sizes: list[tuple[int, int]] = []
        self.buffer, self.filled, self.written = [], 0, 0

    def add(self, record: bytes) -> tuple[int, int]:
        """Frame and offset of the record."""
        if self.filled and self.filled + len(record) > FRAME_BYTES:
            self.flush()
        place = len(self.sizes), self.filled
        self.buffer.append(record)
        self.filled += len(record)
        return place

    def flush(self) -> None:
        if self.filled:
            packed = self.packer.compress(b"".join(self.buffer))
            self.stream.write(packed)
            self.sizes.append((len(packed), self.filled))
            self.written += len(packed)
            self.buffer, self.filled = [], 0

    def close(self) -> None:
        self.flush()
        body = b"".join(struct.pack("<II", *s) for s in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, _SEEKABLE)
        self.stream.write(struct.pack("<II", _SKIPPABLE, len(body)) + body)
        self.stream.close()


def seek_table(file) -> list[tuple[int, int, int]]:
    """(start, compressed size, plain size) of each frame, from the end of a bundle."""
    size = file.size()
    count, _, magic = struct.unpack("<IBI", file.read_at(9, size - 9))
    if magic != _SEEKABLE:
        raise ValueError("no seek table at the end of the bundle")
    pairs = struct.iter_unpack("<II", file.read_at(8 * count, size - 9 - 8 * count))
    out, at = [], 0
    for packed, plain in pairs:
        out.append((at, packed, plain))
        at += packed
    return out


def read_record(bundle: str, frame: int, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """One record by its index entry: only its frame is read and unpacked."""
    store, path = fs.FileSystem.from_uri(bundle)
    with store.open_input_file(path) as file:
        at, packed, plain = seek_table(file)[frame]
        data = zstandard.ZstdDecompressor().decompress(file.read_at(packed, at), max_output_size=plain)
    _, _, headers, block = next(parse_records(data[offset:offset + length]))
    return headers, block


def _with_scheme(folder: str) -> str:
    return folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"


def write_archives(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html",
                   revisit_from: int = REVISIT_FROM) -> DataFrame:
    """Write the rows; returns the index (key, bundle, frame, offset, length), already stored."""
    spark = pages.sparkSession
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(key).alias("_key"), F.col(url).cast("string").alias("_url"), body.alias("_body"))
    rows = rows.withColumns({"_digest": F.sha1("_body"), "_size": F.octet_length("_body").cast("long")})
    same = stored(rows.where(F.col("_size") >= revisit_from).groupBy("_digest").agg(
        F.max("_key").alias("_keeper"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "digests")
    refers = F.when(F.col("_key").isNull() | (F.col("_key") < F.col("_keeper")), F.col("_keeper"))
    rows = rows.join(same, "_digest", "left").select("_key", "_url", "_body", "_digest", "_size", refers.alias("_refers"))
    folder = _with_scheme(fresh_dir(spark, "warc"))
    key_type = pages.schema[key].dataType.simpleString()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = fs.FileSystem.from_uri(folder)
        part, writer, name = TaskContext.get().partitionId(), None, ""
        names = ["_key", "bundle", "frame", "offset", "length"]
        for batch in batches:
            placed = []
            for k, u, b, d, s, r in zip(*[c.to_pylist() for c in batch.columns]):
                if writer is None:
                    name = f"part-{part:06d}-{uuid.uuid4().hex}.warc.zst"
                    store.create_dir(path, recursive=True)
                    writer = BundleWriter(store.open_output_stream(f"{path}/{name}", compression=None))
                record = record_bytes(k, u, b, d, s, r)
                placed.append((f"{folder}/{name}", *writer.add(record), len(record)))
                if writer.written >= BUNDLE_BYTES:
                    writer.close()
                    writer = None
            columns = list(zip(*placed)) if placed else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(columns[0], pa.string()), *[pa.array(c, pa.int64()) for c in columns[1:]]],
                names=names)
        if writer is not None:
            writer.close()

    index = rows.mapInArrow(write, f"_key {key_type}, bundle string, frame long, offset long, length long")
    return stored(index, "warc-index").withColumnRenamed("_key", key)


def _id(value: str) -> str | None:
    return value[len("<urn:page:"):-1] or None


def read_archives(spark: SparkSession, index: DataFrame) -> DataFrame:
    """All records of the bundles named in the index; digests are taken anew from what was read."""
    parts = index.select("bundle", F.floor(F.col("frame") / FRAMES_PER_READ).alias("part")).distinct()
    # The list itself is tiny; without a number of its own it would be read by one task.
    parts = parts.repartition(max(1, min(parts.count(), MOST_READERS)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for bundle, part in zip(*[c.to_pylist() for c in batch.columns]):
                store, path = fs.FileSystem.from_uri(bundle)
                with store.open_input_file(path) as file:
                    frames = seek_table(file)[part * FRAMES_PER_READ:(part + 1) * FRAMES_PER_READ]
                    for at, packed, plain in frames:
                        data = unpack.decompress(file.read_at(packed, at), max_output_size=plain)
                        rows = []
                        for _, _, h, block in parse_records(data):
                            head, _, body = block.partition(b"\r\n\r\n")
                            full = int(re.search(rb"Content-Length: (\d+)", head)[1])
                            kind = h["WARC-Type"]
                            rows.append((_id(h["WARC-Record-ID"]), h["WARC-Target-URI"], kind, full,
                                         h["WARC-Payload-Digest"].removeprefix("sha1:"),
                                         _id(h["WARC-Refers-To"]) if kind == "revisit" else None,
                                         body if kind == "response" else None))
                        types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, t) for c, t in zip(zip(*rows), types)],
                            names=["record", "url", "record_type", "payload_bytes", "digest", "refers_to", "payload"])

    records = parts.mapInArrow(read, "record string, url string, record_type string, payload_bytes long, "
                                     "digest string, refers_to string, payload binary")
    # What was read decides for responses; a revisit has only its header.
    whole = F.col("payload").isNotNull()
    return records.withColumns({
        "payload_bytes": F.when(whole, F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes")),
        "payload_digest": F.when(whole, F.sha1("payload")).otherwise(F.col("digest"))})
