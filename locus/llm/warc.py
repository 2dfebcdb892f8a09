"""WARC records in seekable Zstandard bundles.

A bundle is a run of independent Zstandard frames, each holding whole records, and ends with the seek table of the
seekable format: a skippable frame with each frame's compressed and raw size and a footer. Beside it goes an index that
maps record identifiers to a frame and an offset in the frame's raw bytes, so one record is read by inflating one frame.
"""

from __future__ import annotations

import base64
import hashlib
import os
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpointed, table, written

SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
#: Raw bytes after which a frame, and compressed bytes after which a bundle is closed; a record is never split.
FRAME_BYTES, BUNDLE_BYTES = 1 << 17, 1 << 23
#: Repeated digests (20 bytes and two numbers each) that are broadcast at most.
BROADCAST_ROWS = 200_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "array<struct<page_id:bigint,frame:int,offset:bigint,length:bigint>>"


def record(page_id: int | None, url: str | None, payload: bytes, size: int, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC/1.1 record; a revisit keeps the HTTP head alone, which still states the payload's length."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'null' if page_id is None else page_id}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        lines.append("WARC-Target-URI: " + "".join(c if c > " " else f"%{ord(c):02X}" for c in url))
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class Bundle:
    """Records gathered into frames, with their index."""

    def __init__(self, level: int = 3) -> None:
        self.zip = zstandard.ZstdCompressor(level=level)
        self.frames: list[bytes] = []
        self.raw_sizes: list[int] = []
        self.index: list[dict] = []
        self.open, self.open_size = [], 0

    def add(self, page_id: int | None, raw: bytes) -> None:
        self.index.append({"page_id": page_id, "frame": len(self.frames), "offset": self.open_size, "length": len(raw)})
        self.open.append(raw)
        self.open_size += len(raw)
        if self.open_size >= FRAME_BYTES:
            self.close_frame()

    def close_frame(self) -> None:
        if self.open:
            self.frames.append(self.zip.compress(b"".join(self.open)))
            self.raw_sizes.append(self.open_size)
            self.open, self.open_size = [], 0

    @property
    def size(self) -> int:
        return sum(map(len, self.frames))

    def closed(self) -> bytes:
        self.close_frame()
        entries = b"".join(struct.pack("<II", len(f), n) for f, n in zip(self.frames, self.raw_sizes, strict=True))
        footer = struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        return b"".join(self.frames) + struct.pack("<II", SKIPPABLE, len(entries) + len(footer)) + entries + footer


@dataclass(frozen=True)
class Seekable:
    """Random access to the frames of a bundle through its seek table."""

    data: bytes

    @cached_property
    def table(self) -> list[tuple[int, int, int]]:
        return self.frames()

    def frames(self) -> list[tuple[int, int, int]]:
        """(start, compressed size, raw size) of every frame."""
        n, flags, magic = struct.unpack_from("<IBI", self.data, len(self.data) - 9)
        if magic != SEEKABLE:
            raise ValueError("no seek table")
        width = 12 if flags & 0x80 else 8
        at, out, table_at = 0, [], len(self.data) - 9 - n * width
        if struct.unpack_from("<I", self.data, table_at - 8)[0] != SKIPPABLE:
            raise ValueError("no seek table")
        for k in range(n):
            packed, raw = struct.unpack_from("<II", self.data, table_at + k * width)
            out.append((at, packed, raw))
            at += packed
        return out

    def frame(self, k: int) -> bytes:
        at, packed, raw = self.table[k]
        return zstandard.ZstdDecompressor().decompress(self.data[at : at + packed], max_output_size=raw)

    def record(self, frame: int, offset: int, length: int) -> bytes:
        return self.frame(frame)[offset : offset + length]


def parsed(raw: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and end of the record that begins at `at`."""
    head = raw.index(b"\r\n\r\n", at)
    lines = raw[at:head].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record here")
    headers = dict(x.split(": ", 1) for x in lines[1:])
    end = head + 4 + int(headers["Content-Length"])
    return headers, raw[head + 4 : end], end + 4


def _sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def archived(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least: int = 0) -> DataFrame:
    """(bundle, archive, index): pages as bundles of bounded size, equal payloads as revisits.

    Of payloads that are equal (SHA-1 and length) and have `least` bytes or more, the rows with the smallest id are
    responses and the others revisit it; a null id comes last and a null html is an empty payload. Digests alone are
    grouped. Pages meet the digests that occur more than once in one join: these are broadcast if there are at most
    BROADCAST_ROWS of them, and else Spark joins both sides by digest and splits hot ones. Repeated rows are records
    each. An empty table gives no bundle. Only key, url and html are read, so other names cannot clash; a very long
    payload is a frame of its own.
    """
    body = F.coalesce(F.col(f"`{html}`"), F.lit(""))
    rows = pages.select(F.col(f"`{key}`").cast("long").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"), body.cast("binary").alias("payload"))
    rows = rows.withColumns({"size": F.octet_length("payload").cast("long"), "sha": F.unhex(F.sha1("payload"))})
    several = rows.where(F.col("size") >= least).groupBy("sha", "size").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 and first is not null")
    several = checkpointed(several.select(F.col("sha").alias("_sha"), F.col("size").alias("_size"), "first"))
    if several.count() <= BROADCAST_ROWS:
        several = F.broadcast(several)
    joined = rows.join(several, (F.col("sha") == F.col("_sha")) & (F.col("size") == F.col("_size")), "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    joined = joined.select("page_id", "url", F.when(~revisit, F.col("payload")).alias("payload"), "size", "sha", "first", revisit.alias("revisit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        bundle, n = Bundle(), 0

        def out() -> pa.RecordBatch:
            index = pa.array([bundle.index], pa.list_(pa.struct([("page_id", pa.int64()), ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())])))
            archive = bundle.closed()
            return pa.RecordBatch.from_arrays([pa.array([f"{task:06d}-{n:06d}"]), pa.array([archive], pa.binary()), index], names=["bundle", "archive", "index"])

        for b in batches:
            for page_id, address, payload, size, sha, first, again in zip(*(b[c] for c in ("page_id", "url", "payload", "size", "sha", "first", "revisit")), strict=True):
                digest = base64.b32encode(sha.as_py()).decode()
                bundle.add(page_id.as_py(), record(page_id.as_py(), address.as_py(), payload.as_py() or b"", size.as_py(), digest, first.as_py(), again.as_py()))
                if bundle.size >= BUNDLE_BYTES:
                    yield out()
                    bundle, n = Bundle(), n + 1
        if bundle.index:
            yield out()

    return joined.mapInArrow(run, f"bundle string, archive binary, index {INDEX}")


def read(archives: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record, read by frame and offset.

    Each record is found through the index and the seek table. A response's payload must have the length and the
    digest that its headers state; a revisit states those of the payload that it stands for. Pages without an id come
    back without one, those without html with an empty payload, and repeated rows as often as they were written. Bundles
    are read one by one, so a very long page is held once by one task. An empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def number(urn: str) -> int | None:
            value = urn.rpartition(":")[2].rstrip(">")
            return None if value == "null" else int(value)

        for b in batches:
            for archive, index in zip(b["archive"], b["index"], strict=True):
                seek = Seekable(archive.as_py())
                out, at, raw = [], -1, b""
                for x in index.as_py():
                    if x["frame"] != at:
                        at = x["frame"]
                        raw = seek.frame(at)
                    headers, block, end = parsed(raw, x["offset"])
                    if end != x["offset"] + x["length"] or number(headers["WARC-Record-ID"]) != x["page_id"]:
                        raise ValueError(f"the index does not fit record {headers['WARC-Record-ID']}")
                    head, _, payload = block.partition(b"\r\n\r\n")
                    size = int(next(v for k, v in (h.split(b": ", 1) for h in head.split(b"\r\n")[1:]) if k == b"Content-Length"))
                    digest, kind = headers["WARC-Payload-Digest"].removeprefix("sha1:"), headers["WARC-Type"]
                    if kind == "response" and (len(payload), _sha1(payload)) != (size, digest):
                        raise ValueError(f"the payload of {headers['WARC-Record-ID']} has changed")
                    refers = headers.get("WARC-Refers-To")
                    out.append((x["page_id"], size, digest, kind, number(refers) if refers else None))
                cols = list(zip(*out, strict=True))
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return archives.select("archive", "index").mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def exported(archives: DataFrame, folder: str) -> DataFrame:
    """Writes each bundle to `folder` as a .warc.zst file, for folders that every executor mounts: (file, bytes).

    A task that runs again writes the same files anew. An empty table writes none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, sizes = [], []
            for bundle, archive in zip(b["bundle"].to_pylist(), b["archive"], strict=True):
                names.append(f"{folder}/{bundle}.warc.zst")
                data = archive.as_py()
                with open(part := f"{names[-1]}.{TaskContext.get().taskAttemptId()}", "wb") as f:
                    f.write(data)
                os.replace(part, names[-1])  # a repeated task writes the same bytes
                sizes.append(len(data))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sizes, pa.int64())], names=["file", "bytes"])

    return archives.select("bundle", "archive").mapInArrow(run, "file string, bytes long")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(written(archived(table(spark, sf_dir, "pages")), "warc"))


QUERIES = {"op4_warc": op4_warc}
#: Base32 of a digest, five bits at a time.
_B32 = "array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (('0b' || substr(bits, 1 + 5 * k::BIGINT, 5))::INT), 1)), '')"
SQL = {
    "op4_warc": f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha1(b) AS h, unhex(sha1(b))::BIT::VARCHAR AS bits FROM p),
m AS (SELECT h, payload_bytes AS n, min(page_id) AS first FROM d GROUP BY ALL)
SELECT page_id, payload_bytes, {_B32} AS payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM d JOIN m ON d.h = m.h AND d.payload_bytes = m.n
"""
}
