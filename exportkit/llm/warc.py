"""WARC archives: one gzip member per record, written once, read back in byte ranges.

Writing: payloads are digested, the row with the smallest id of each payload becomes a response,
its repetitions become revisits. Each task writes one archive into the folder under a name of its
own and then moves it to the final name, so a repeated task replaces its first attempt.

Reading: archives are cut into byte ranges. A task looks for gzip magic from the start of its
range, believes a place only when the member's header decodes to a WARC record, and from there
follows member after member. It owns the records that start inside its range, reads the last one
past the end, and leaves everything else to its neighbours.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import narrow, partitions, through_arrow

MAGIC = b"\x1f\x8b\x08\x04"  # gzip, deflate, with an extra field
VERSION = b"WARC/1.1\r\n"
VERSIONS = (b"WARC/1.0\r\n", VERSION)
EXTRA_ID = b"WO"  # extra subfield of our archives: where in the file the member starts
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SPLIT_BYTES = 32 << 20
PROBE = 64 << 10
BLOCK = 1 << 20


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(page_id: int | None, url: str | None, payload: bytes, kind: str, refers_to: int | None, sha: str) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    body = http + payload if kind == "response" else http
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Target-URI", "".join(c if c.isprintable() else "%%%02X" % ord(c) for c in url or "")),
        ("WARC-Payload-Digest", f"sha1:{sha}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if kind == "revisit":
        fields += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", REVISIT_PROFILE)]
    fields.append(("Content-Length", str(len(body))))
    return VERSION + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + body + b"\r\n\r\n"


def _member(record: bytes, at: int) -> bytes:
    """A gzip member that tells in its extra field where it starts."""
    extra = EXTRA_ID + struct.pack("<HQ", 8, at)
    head = MAGIC + struct.pack("<IBB", 0, 0, 255) + struct.pack("<H", len(extra)) + extra
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(record) + packer.flush()
    return head + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


def _open_folder(folder: str) -> tuple[pafs.FileSystem, str]:
    if "://" in folder or folder.startswith("file:"):
        return pafs.FileSystem.from_uri(folder if "://" in folder else "file://" + folder[5:])
    return pafs.LocalFileSystem(), folder


def with_types(pages: DataFrame, min_bytes: int, id: str, url: str, html: str) -> DataFrame:
    """Rows with digest, record type and the response they repeat.

    Payloads are grouped by digest after one row per digest and task is left, so a payload that
    fills a third of the table moves as single rows; the join back is one that adaptive execution
    can split.
    """
    rows = narrow(pages, page_id=id, url=url, html=html)
    rows = rows.withColumn("payload", F.encode(F.coalesce("html", F.lit("")), "UTF-8")).drop("html")
    rows = rows.withColumn("sha", F.sha1("payload"))
    long_enough = F.octet_length("payload") >= min_bytes
    first = rows.where(long_enough).groupBy("sha").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    first = first.where("n > 1 and first is not null").select("sha", "first")
    rows = rows.join(first, "sha", "left")
    revisit = F.col("first").isNotNull() & long_enough & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.select("page_id", "url", "payload", F.when(revisit, F.col("first")).alias("refers_to"))


def write_archives(
    pages: DataFrame, folder: str, min_bytes: int = 0, id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """Write all rows below ``folder``; returns one row per archive: ``path``, ``bytes``, ``records``.

    Null html is an empty payload, a null url an empty target. Rows that share the smallest id of
    a payload (repeated rows) are all responses; rows without an id are revisits of the smallest
    id, or responses when no row of that payload has one. Other columns are not archived; an empty
    table leaves no archive. The folder has to be one that all executors reach.
    """
    typed = with_types(pages, min_bytes, id, url, html)

    def run(batches) -> Iterator[pa.RecordBatch]:
        store, base = _open_folder(folder)
        task, records, at = TaskContext.get().partitionId(), 0, 0
        name, staged = f"part-{task:06d}.warc.gz", f"_staged-{task:06d}-{uuid.uuid4().hex}"
        out = None
        for rows in batches:
            for page_id, target, payload, refers_to in zip(*(rows.column(i) for i in range(4))):
                if out is None:
                    store.create_dir(base, recursive=True)
                    out = store.open_output_stream(f"{base}/{staged}")
                body, earlier = payload.as_py() or b"", refers_to.as_py()
                kind = "response" if earlier is None else "revisit"
                member = _member(_record(page_id.as_py(), target.as_py(), body, kind, earlier, digest(body)), at)
                out.write(member)
                at, records = at + len(member), records + 1
        if out is not None:
            out.close()
            store.move(f"{base}/{staged}", f"{base}/{name}")
            yield pa.RecordBatch.from_pylist([{"path": name, "bytes": at, "records": records}])

    return typed.mapInArrow(run, "path string, bytes long, records long")


class _Window:
    """Random reads of one archive through a sliding block."""

    def __init__(self, source, size: int) -> None:
        self.source, self.size, self.at, self.block = source, size, 0, b""

    def read(self, at: int, n: int) -> bytes:
        if not (self.at <= at and at + n <= self.at + len(self.block)):
            self.source.seek(at)
            self.at, self.block = at, self.source.read(min(max(n, BLOCK), max(0, self.size - at)))
        return self.block[at - self.at : at - self.at + n]


def _starts_record(window: _Window, at: int, next_one: bool = False) -> bool:
    """Does a gzip member start here whose content begins like a WARC record?

    A place found by its magic alone may lie inside a payload; one where the member before ended
    (``next_one``) cannot, so the offset that our archives store is not asked for there: it is another one
    behind the seam of archives laid end to end.
    """
    probe = window.read(at, PROBE)
    if not next_one and probe[3:4] == MAGIC[3:] and probe[12:14] == EXTRA_ID and struct.unpack("<Q", probe[16:24])[0] != at:
        return False  # the member of an archive that is itself a payload
    try:
        return zlib.decompressobj(31).decompress(probe, len(VERSION)) in VERSIONS
    except zlib.error:
        return False


def _decode(window: _Window, at: int) -> tuple[bytes, int]:
    """The member that starts at ``at`` and the place behind it."""
    unpack, parts = zlib.decompressobj(31), []
    while not unpack.eof:
        block = window.read(at, BLOCK)
        if not block:
            raise ValueError("the last member of the archive is cut off")
        parts.append(unpack.decompress(block))
        at += len(block)
    return b"".join(parts), at - len(unpack.unused_data)


def records_of(window: _Window, start: int, end: int) -> Iterator[bytes]:
    """Decoded members that start in ``[start, end)``."""
    at, next_one = start, start == 0
    while at < min(end, window.size):
        if _starts_record(window, at, next_one):
            record, at = _decode(window, at)
            next_one = True
            yield record
        else:
            next_one = False
            at += 1
            while at < min(end, window.size):
                block = window.read(at, BLOCK)
                place = block.find(MAGIC[:3])
                if place >= 0:
                    at += place
                    break
                at += max(1, len(block) - 2)


def parse(record: bytes) -> dict:
    """The fields a page is rebuilt from; the digest of a response is taken from its payload."""
    head, _, block = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:] if ": " in line)
    block = block[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(line[16:]) for line in http.split(b"\r\n") if line.lower().startswith(b"content-length: "))
    kind, sha = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != length or digest(payload) != sha):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    number = lambda text: int(text) if (text := text[len("<urn:page:") : -1]) else None
    return {
        "page_id": number(fields["WARC-Record-ID"]),
        "url": fields["WARC-Target-URI"],
        "payload": payload if kind == "response" else None,
        "payload_bytes": length,
        "payload_digest": sha,
        "record_type": kind,
        "refers_to": number(fields["WARC-Refers-To"]) if kind == "revisit" else None,
    }


RECORD = (
    "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long"
)


def read_archives(spark: SparkSession, folder: str, archives: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """One row per record of the ``archives`` (``path`` below ``folder``, ``bytes``), in byte ranges.

    WARC 1.0 and 1.1 are read. A range that begins behind the seam of two of our archives laid end to end
    finds no record by itself; :func:`require_all` tells when records are missing.
    """
    spots = F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long"))
    ranges = archives.where("bytes > 0").select("path", "bytes", F.explode(spots).alias("start"))
    # A fixed number of partitions, or adaptive execution would leave the few rows to one reader.
    ranges = ranges.repartition(partitions(spark), "path", "start")

    def each(columns):
        store, base = _open_folder(folder)
        for path, size, start in zip(*(columns[c].to_pylist() for c in ("path", "bytes", "start"))):
            with store.open_input_file(f"{base}/{path}") as source:
                rows = []
                for record in records_of(_Window(source, size), start, start + split_bytes):
                    rows.append(parse(record))
                    if len(rows) == 256:
                        yield {name: [row[name] for row in rows] for name in rows[0]}
                        rows = []
                if rows:
                    yield {name: [row[name] for row in rows] for name in rows[0]}

    return through_arrow(ranges, each, RECORD)


def require_all(records: DataFrame, archives: DataFrame) -> None:
    """Raise when ``records`` are not as many as the ``archives`` say they hold."""
    found, held = records.count(), archives.agg(F.coalesce(F.sum("records"), F.lit(0))).first()[0]
    if found != held:
        raise ValueError(f"{found} of {held} records were read back")
