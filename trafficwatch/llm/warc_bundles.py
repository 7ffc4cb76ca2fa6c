"""WARC records in seekable Zstandard bundles.

Records are grouped into independent zstd frames.  A bundle ends with a
skippable frame that maps record ids to (frame, offset, length) and the
seek-table footer of the public seekable format, so one record costs one
frame read.

Of records with equal payloads of at least ``least_bytes``, that of the
smallest page_id is a response and the others are revisits of it.

Defined results: null html is an empty payload; a null url leaves its header
out; a page whose page_id is null is a revisit if its payload has a response
elsewhere and a response if not; rows that share the smallest page_id are all
responses; a very long payload is one frame of its own, held whole
by its task; an empty table gives no bundle; other columns are ignored, whatever
their names.
"""

from __future__ import annotations

import hashlib
import json
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficwatch.llm import shared

#: Fixed values of the formats.
SKIPPABLE_INDEX, SKIPPABLE_TABLE, SEEKABLE = 0x184D2A5D, 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MANIFEST = "uri string, n_records long, n_bytes long"
_RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, uri string, frame int, frame_offset long, record_bytes long"
_RECORD_TYPES = pa.schema(
    [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("uri", pa.string()), ("frame", pa.int32()), ("frame_offset", pa.int64()), ("record_bytes", pa.int64())]
)


def record_id(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def page_of(record: str | None) -> int | None:
    tail = (record or "").rpartition(":")[2].rstrip(">")
    return int(tail) if tail else None


def record_bytes(page_id, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """One WARC record; a revisit has an empty block."""
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}")
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {PROFILE}", f"X-Payload-Length: {len(payload)}"]
        payload = b""
    head += ["Content-Type: text/html", f"Content-Length: {len(payload)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, block)."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return headers, rest[: int(headers["Content-Length"])]


class BundleWriter:
    """Collects records into frames; ``parts`` is the bundle's bytes."""

    def __init__(self, frame_bytes: int):
        self.frame_bytes = frame_bytes
        self.squeeze = zstandard.ZstdCompressor(level=3, write_checksum=True)
        self.parts, self.table, self.index = [], [], []
        self.open, self.filled, self.size = [], 0, 0

    def add(self, name: str, record: bytes) -> None:
        self.index.append((name, len(self.table), self.filled, len(record)))
        self.open.append(record)
        self.filled += len(record)
        if self.filled >= self.frame_bytes:
            self.close_frame()

    def close_frame(self) -> None:
        if self.open:
            self._append(self.squeeze.compress(b"".join(self.open)), self.filled)
            self.open, self.filled = [], 0

    def _append(self, frame: bytes, length: int) -> None:
        self.parts.append(frame)
        self.table.append((len(frame), length))
        self.size += len(frame)

    def finish(self) -> list[bytes]:
        self.close_frame()
        index = self.squeeze.compress(json.dumps(self.index).encode())
        self._append(struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index, 0)
        entries = b"".join(struct.pack("<II", *e) for e in self.table)
        footer = struct.pack("<IBI", len(self.table), 0, SEEKABLE)
        return [*self.parts, struct.pack("<II", SKIPPABLE_TABLE, len(entries) + len(footer)), entries, footer]


class Bundle:
    """A bundle opened by its seek table."""

    def __init__(self, uri: str):
        self.file = shared.open_file(uri)
        size = self.file.size()
        n, _, magic = struct.unpack("<IBI", self._bytes(size - 9, 9))
        if magic != SEEKABLE:
            raise ValueError("not a seekable bundle")
        raw = self._bytes(size - 9 - 8 * n, 8 * n)
        self.table = [struct.unpack_from("<II", raw, 8 * k) for k in range(n)]
        self.places, at = [], 0
        for packed, _ in self.table:
            self.places.append(at)
            at += packed
        index = self._bytes(self.places[-1] + 8, self.table[-1][0] - 8)
        self.index = json.loads(zstandard.ZstdDecompressor().decompress(index))
        self._by_id: dict[str, list] | None = None

    def _bytes(self, at: int, length: int) -> bytes:
        self.file.seek(at)
        return self.file.read(length)

    def frame(self, k: int) -> bytes:
        return zstandard.ZstdDecompressor().decompress(self._bytes(self.places[k], self.table[k][0]))

    def record(self, name: str) -> bytes:
        """The first record of that id: one frame is read."""
        if self._by_id is None:
            self._by_id = {x[0]: x for x in reversed(self.index)}
        _, k, at, length = self._by_id[name]
        return self.frame(k)[at : at + length]

    def records(self) -> Iterator[tuple[int, int, bytes]]:
        """(frame, offset in it, record) of all records; one frame is held at a time."""
        held, data = -1, b""
        for _, k, at, length in self.index:
            if k != held:
                held, data = k, self.frame(k)
            yield k, at, data[at : at + length]


def with_decisions(pages: DataFrame, least_bytes: int = 100) -> DataFrame:
    """(page_id, url, html, payload_digest, refers_to): null refers_to means a response."""
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long"), "url", html.alias("html"))
    rows = rows.withColumn("payload_digest", F.sha2(F.col("html").cast("binary"), 256))
    long_enough = F.octet_length("html") >= least_bytes
    groups = rows.filter(long_enough).groupBy("payload_digest")
    firsts = groups.agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    other = ~F.col("page_id").eqNullSafe(F.col("_first"))
    return rows.join(firsts, "payload_digest", "left").select("page_id", "url", "html", "payload_digest", F.when(other, F.col("_first")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str | None = None, frame_bytes: int = 1 << 20, bundle_bytes: int = 64 << 20, least_bytes: int = 100, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write ``pages`` (page_id, url, html) as bundles; returns their manifest table."""
    spark = pages.sparkSession
    shared.with_python(spark)
    folder = folder or shared.shared_dir(spark, "warc")

    def write(batches):
        part, seq, out = TaskContext.get().partitionId(), 0, BundleWriter(frame_bytes)

        def close():
            uri, size = shared.write_file(folder, f"part-{part:06d}-{seq:05d}.warc.zst", out.finish())
            return pa.RecordBatch.from_pydict({"uri": [uri], "n_records": [len(out.index)], "n_bytes": [size]})

        for batch in shared.by_bytes(batches, 2):
            for page_id, url, html, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                out.add(record_id(page_id), record_bytes(page_id, url, html.encode(), digest, refers_to, date))
            if out.size >= bundle_bytes:
                yield close()
                seq, out = seq + 1, BundleWriter(frame_bytes)
        if out.index:
            yield close()

    return shared.materialize(with_decisions(pages, least_bytes).mapInArrow(write, _MANIFEST), "warc-manifest", batch_rows=1024)


def read_archives(manifest: DataFrame) -> DataFrame:
    """Every record of the bundles, with its place; digests and sizes of responses come from their payloads."""

    def read(batches):
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                rows = []
                for frame, at, raw in Bundle(uri).records():
                    head, block = parse_record(raw)
                    revisit = head["WARC-Type"] == "revisit"
                    rows.append(
                        {
                            "page_id": page_of(head["WARC-Record-ID"]),
                            "payload_bytes": int(head["X-Payload-Length"]) if revisit else len(block),
                            "payload_digest": head["WARC-Payload-Digest"].rpartition(":")[2] if revisit else hashlib.sha256(block).hexdigest(),
                            "record_type": head["WARC-Type"],
                            "refers_to": page_of(head.get("WARC-Refers-To")),
                            "uri": uri,
                            "frame": frame,
                            "frame_offset": at,
                            "record_bytes": len(raw),
                        }
                    )
                yield pa.RecordBatch.from_pylist(rows, _RECORD_TYPES)

    return shared.spread(manifest.select("uri"), "uri").mapInArrow(read, _RECORDS)
