"""WARC archives in seekable Zstandard bundles.

A bundle is one file: the records in groups, each group an independent Zstandard frame, and last a
seek table in a skippable frame, as the seekable format of Zstandard lays down: the compressed and
uncompressed length of every frame, and a footer. Any Zstandard or WARC reader reads it from the start;
the index, a row per record with its frame and its place in it, lets one record be read alone.

Records with equal payloads of at least MIN_REVISIT bytes: the one with the smallest id is a response,
the others revisit it. Only ids and digests are compared for that, and the smallest id of each digest
is aggregated before the shuffle, so a payload that a third of all pages have is no group in memory.

Null payload: empty. Rows with a null id can't be referred to: they are responses. Rows that repeat an id
are all written; of those with the smallest id the payload is equal, and they are all responses. An
empty table gives no bundle and no row. Other columns are ignored, but for `url` (null: absent).
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.files import read_part, size_of, write_whole
from tidemark.sources.lake import new_folder, staged

MIN_REVISIT = 100
FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 64 << 20

# Fixed values of the seekable format.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1

_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def _record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, str(page_id))}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, original: int | None) -> bytes:
    """A response, or a revisit of the page `original`, which leaves the payload out."""
    http = _HTTP % len(payload)
    block = http if original is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if original is None else 'revisit'}", f"WARC-Record-ID: {_record_id(page_id)}",
             "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(payload)}"]
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if url is not None:
        lines.append("WARC-Target-URI: " + "".join(c for c in url if c >= " "))
    if original is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: {_record_id(original)}", f"X-Refers-To-Page-ID: {original}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        head = data[at:end].decode().split("\r\n")
        headers = dict(line.split(": ", 1) for line in head[1:])
        length = int(headers["Content-Length"])
        yield headers, data[end + 4 : end + 4 + length]
        at = end + 8 + length


class Bundle:
    """Frames of records under way."""

    def __init__(self):
        self.frames: list[bytes] = []
        self.sizes: list[tuple[int, int]] = []
        self.open: list[bytes] = []
        self.open_bytes = self.bytes = 0

    def add(self, data: bytes) -> tuple[int, int]:
        """(frame, offset in the uncompressed frame) of the record."""
        if self.open and self.open_bytes + len(data) > FRAME_BYTES:
            self.close_frame()
        place = len(self.frames), self.open_bytes
        self.open.append(data)
        self.open_bytes += len(data)
        return place

    def close_frame(self) -> None:
        if self.open:
            raw = b"".join(self.open)
            frame = zstandard.ZstdCompressor(level=3, write_content_size=True).compress(raw)
            self.frames.append(frame)
            self.sizes.append((len(frame), len(raw)))
            self.bytes += len(frame)
            self.open, self.open_bytes = [], 0

    def parts(self) -> list[bytes]:
        self.close_frame()
        table = b"".join(struct.pack("<2I", *s) for s in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        return [*self.frames, struct.pack("<2I", SKIPPABLE, len(table)), table]


def seek_table(path: str) -> list[tuple[int, int, int]]:
    """(start in the file, compressed length, uncompressed length) of every frame."""
    size = size_of(path)
    n, flags, magic = struct.unpack("<IBI", read_part(path, size - 9, 9))
    if magic != SEEKABLE or flags & 0x80:
        raise ValueError(f"no seek table that can be read in {path}")
    table = read_part(path, size - 9 - 8 * n, 8 * n)
    out, at = [], 0
    for c, d in struct.iter_unpack("<2I", table):
        out.append((at, c, d))
        at += c
    return out


def read_frame(path: str, start: int, length: int) -> bytes:
    return zstandard.ZstdDecompressor().decompress(read_part(path, start, length))


def read_record(path: str, frame: int, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """One record by its index row: the seek table and one frame are read."""
    start, size, _ = seek_table(path)[frame]
    return next(parse(read_frame(path, start, size)[offset : offset + length]))


_INDEX = "page_id long, path string, frame int, offset int, length int"


def _write(folder: str):
    def run(batches):
        part, seq, bundle, rows = TaskContext.get().partitionId(), 0, Bundle(), []

        def close():
            nonlocal bundle, rows, seq
            path = f"{folder}/part-{part:07d}-{seq:05d}.warc.zst"
            write_whole(path, bundle.parts())
            out = pa.RecordBatch.from_pydict({
                "page_id": pa.array([r[0] for r in rows], pa.int64()), "path": pa.array([path] * len(rows)), "frame": pa.array([r[1] for r in rows], pa.int32()),
                "offset": pa.array([r[2] for r in rows], pa.int32()), "length": pa.array([r[3] for r in rows], pa.int32())})
            bundle, rows, seq = Bundle(), [], seq + 1
            return out

        for batch in batches:
            for page_id, url, html, digest, original in zip(*(batch.column(c) for c in ("page_id", "url", "html", "digest", "original")), strict=True):
                data = record(page_id.as_py(), url.as_py(), html.as_py().encode(), digest.as_py(), original.as_py())
                rows.append((page_id.as_py(), *bundle.add(data), len(data)))
                if bundle.bytes >= BUNDLE_BYTES:
                    yield close()
        if rows:
            yield close()

    return run


def write_bundles(pages: DataFrame) -> DataFrame:
    """Write the bundles and return their index: (page_id, path, frame, offset, length) per record."""
    url = F.col("url").cast("string") if "url" in pages.columns else F.lit(None).cast("string")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), url.alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha2(F.encode("html", "UTF-8"), 256))
    first = rows.where(F.octet_length("html") >= MIN_REVISIT).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    first = first.where("n > 1 AND first IS NOT NULL").select("digest", "first")
    original = F.when(F.col("page_id") > F.col("first"), F.col("first"))
    rows = rows.join(first, "digest", "left").select("page_id", "url", "html", "digest", original.alias("original"))
    return staged(rows.mapInArrow(_write(new_folder(pages.sparkSession, "warc")), _INDEX), "warc-index")


def _read(batches):
    for batch in batches:
        for path in batch.column("path").to_pylist():
            for start, size, _ in seek_table(path):
                out = {k: [] for k in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")}
                for headers, block in parse(read_frame(path, start, size)):
                    kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha256:")
                    length = int(headers["X-Payload-Length"])
                    payload = block[block.index(b"\r\n\r\n") + 4 :]
                    if kind == "response" and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
                        raise ValueError(f"damaged record in {path}")
                    number = lambda name, h=headers: int(h[name]) if name in h else None
                    for name, x in zip(out, (number("X-Page-ID"), length, digest, kind, number("X-Refers-To-Page-ID")), strict=True):
                        out[name].append(x)
                yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.string() if k in ("payload_digest", "record_type") else pa.int64()) for k, v in out.items()})


def read_bundles(index: DataFrame) -> DataFrame:
    """Every record of the bundles, read back: page_id, payload_bytes, payload_digest, record_type,
    refers_to. The payload of each response is checked against its digest."""
    paths = staged(index.select("path").distinct(), "warc-paths")
    return paths.repartition(max(paths.count(), 1)).mapInArrow(
        _read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def warc_round_trip(pages: DataFrame) -> DataFrame:
    return read_bundles(write_bundles(pages))
