"""WARC archives as seekable Zstandard bundles.

Writing. A bundle is a file ``<uuid>.warc.zst``. Its records are grouped into
frames of about ``FRAME_BYTES``; each frame is compressed alone, so it can be
read alone. Behind the frames comes a seek table, a skippable frame that gives
the compressed size, the plain size and a checksum of every frame (the public
"Zstandard seekable format"); any Zstandard reader skips it. The index, a
Parquet table beside the bundles, maps every record to bundle, frame and the
place of the record within the plain bytes of that frame.

Every task writes bundles of its own with one open frame in memory. A bundle
counts only if the index names it, and the index is written by Spark in one
commit: files of failed or repeated attempts are never read.

Copies. Of records with equal payloads of at least ``min_bytes`` those with the
largest page_id are responses, the others are revisits that refer to it and
carry no payload. Copies are found by the SHA-256 of the payload, counted with
map-side combine; html itself is not shuffled unless the groups of copies are
too many to broadcast, and then by salted keys.

Reading. ``records`` takes every frame from the seek tables and checks sizes,
checksums and payload digests; ``fetch`` reads the frames that hold given ids.

Defined results: null html is an empty payload; equal rows with the largest
page_id are all responses; a null page_id is smaller than any and never referred
to (copies without any page_id are all responses); a null url has no
WARC-Target-URI and comes back null, an url with control characters is
percent-encoded there and kept beside it; a long page fills a frame of its own;
an empty table gives an archive without bundles; other columns are ignored.
The folder may be a path or a URI of any file system that pyarrow opens.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.llm.common import written
from tickweave.session import scratch_path

FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 128 << 20
LEVEL = 3
SALTS = 32
COPIES_BROADCAST = 200_000  # rows of 32 + 8 bytes
DATE = "1970-01-01T00:00:00Z"

# Magic numbers and layout of the seekable format, and names of the WARC standard.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
HAS_CHECKSUMS = 0x80
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = "page_id long, record_id string, bundle string, frame int, frame_start long, frame_bytes long, offset long, length long"
FRAMES = "bundle string, frame int, start long, bytes long, plain long, checksum long"
RECORDS = "page_id long, record_id string, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    if "://" in folder or folder.startswith("file:"):
        return fs.FileSystem.from_uri(folder)
    return fs.LocalFileSystem(), folder


# ------------------------------------------------------------------ records
def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str = DATE) -> tuple[str, bytes]:
    """(record id, the record): a response, or a revisit where ``refers_to`` is given."""
    digest = digest_of(payload)
    own = record_id(page_id, digest)
    head = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", own), ("WARC-Date", date)]
    if url is not None:
        safe = re.sub(r"[\x00-\x1f\x7f]", lambda m: quote(m.group()), url).strip()
        head.append(("WARC-Target-URI", safe))
        if safe != url:
            head.append(("X-Target-URI", base64.b64encode(url.encode()).decode()))
    if page_id is not None:
        head.append(("X-Page-ID", str(page_id)))
    if refers_to is not None:
        head += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)), ("X-Refers-To-Page-ID", str(refers_to))]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    head += [("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return own, b"".join([VERSION, b"\r\n", *(f"{k}: {v}\r\n".encode() for k, v in head), b"\r\n", block, b"\r\n\r\n"])


def _head(data: memoryview, start: int, end: int) -> tuple[dict[str, str], int]:
    """Named fields after the first line from ``start``, and where the block begins."""
    stop = bytes(data[start:min(start + 65_536, end)]).find(b"\r\n\r\n")
    stop = stop if stop >= 0 else bytes(data[start:end]).find(b"\r\n\r\n")
    if stop < 0:
        raise ValueError("a record without the end of its head")
    lines = bytes(data[start:start + stop]).decode().split("\r\n")[1:]
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}, start + stop + 4


def parse(plain: bytes) -> Iterator[tuple]:
    """The records in plain bytes, as rows of RECORDS."""
    data, at = memoryview(plain), 0
    while at < len(data):
        if data[at:at + len(VERSION)] != VERSION:
            raise ValueError(f"no record at byte {at}")
        head, block = _head(data, at, len(data))
        end = block + int(head["content-length"])
        if bytes(data[end:end + 4]) != b"\r\n\r\n":
            raise ValueError(f"record {head['warc-record-id']} does not end where it should")
        http, body = _head(data, block, end)
        digest, size = head["warc-payload-digest"].removeprefix("sha1:"), int(http["content-length"])
        payload = None
        if head["warc-type"] == "response":
            payload = bytes(data[body:end])
            if len(payload) != size or digest_of(payload) != digest:
                raise ValueError(f"record {head['warc-record-id']} is damaged")
        url = base64.b64decode(head["x-target-uri"]).decode() if "x-target-uri" in head else head.get("warc-target-uri")
        number = lambda k: int(head[k]) if k in head else None  # noqa: E731, B023
        yield number("x-page-id"), head["warc-record-id"], url, head["warc-type"], number("x-refers-to-page-id"), size, digest, payload
        at = end + 4


# ------------------------------------------------------------------ bundles
class Bundle:
    """One file that is being written: an open frame, and the sizes of the closed ones."""

    def __init__(self, folder: str, frame_bytes: int):
        system, path = _opened(folder)
        self.name, self.frame_bytes = f"{uuid.uuid4().hex}.warc.zst", frame_bytes
        # the frames are compressed here: pyarrow is not to do it again for the ending .zst
        self.out = system.open_output_stream(f"{path.rstrip('/')}/{self.name}", compression=None)
        self.position, self.table, self.plain, self.waiting = 0, [], bytearray(), []
        self.press = zstandard.ZstdCompressor(level=LEVEL)

    def add(self, page_id: int | None, own: str, data: bytes) -> list[tuple]:
        """Index rows of the frame that this record closes, if it does."""
        self.waiting.append((page_id, own, len(self.plain), len(data)))
        self.plain += data
        return self.flush() if len(self.plain) >= self.frame_bytes else []

    def flush(self) -> list[tuple]:
        if not self.waiting:
            return []
        plain = bytes(self.plain)
        packed = self.press.compress(plain)
        self.out.write(packed)
        rows = [(i, own, self.name, len(self.table), self.position, len(packed), at, n) for i, own, at, n in self.waiting]
        self.table.append((len(packed), len(plain), xxhash.xxh64(plain).intdigest() & 0xFFFFFFFF))
        self.position += len(packed)
        self.plain, self.waiting = bytearray(), []
        return rows

    def close(self) -> list[tuple]:
        rows = self.flush()
        body = b"".join(struct.pack("<III", *x) for x in self.table) + struct.pack("<IBI", len(self.table), HAS_CHECKSUMS, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(body)) + body)
        self.out.close()
        return rows


def seek_table(system: fs.FileSystem, path: str) -> list[tuple[int, int, int, int]]:
    """(start, bytes, plain bytes, checksum) of each frame, from the end of the file."""
    size = system.get_file_info(path).size
    with system.open_input_file(path) as f:
        frames, flags, magic = struct.unpack("<IBI", f.read_at(9, size - 9))
        entry = 12 if flags & HAS_CHECKSUMS else 8
        length = frames * entry + 9
        if magic != SEEKABLE or struct.unpack("<II", f.read_at(8, size - length - 8)) != (SKIPPABLE, length):
            raise ValueError(f"{path} has no seek table")
        entries = f.read_at(frames * entry, size - length)
    out, start = [], 0
    for packed, plain, *check in struct.iter_unpack("<III" if entry == 12 else "<II", entries):
        out.append((start, packed, plain, check[0] if check else None))
        start += packed
    return out


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _with_copies(pages: DataFrame, min_bytes: int, broadcast_rows: int) -> DataFrame:
    """page_id, url, payload, refers_to: null for the responses."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    rows = rows.withColumn("key", F.when(F.octet_length("payload") >= min_bytes, F.sha2("payload", 256)))
    copies = rows.filter(F.col("key").isNotNull()).groupBy("key").agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
    copies = written(copies.filter("n > 1 and first is not null").select("key", "first"), "warc-copies")
    if copies.count() <= broadcast_rows:
        joined = rows.join(F.broadcast(copies), "key", "left")
    else:  # too many for every task: html moves once, a hot payload over all salts
        salt = F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")
        # rows without a key match nothing; their salt and a key of their own spread them
        own = F.coalesce("key", F.xxhash64("page_id", "url").cast("string"))
        many = copies.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = rows.withColumns({"salt": salt, "key": own}).join(many, ["key", "salt"], "left")
    refers = F.when(F.coalesce(F.col("page_id") < F.col("first"), F.col("first").isNotNull()), F.col("first"))
    return joined.select("page_id", "url", "payload", refers.alias("refers_to"))


def write(pages: DataFrame, folder: str | None = None, min_bytes: int = 0, date: str = DATE, frame_bytes: int = FRAME_BYTES,
          bundle_bytes: int = BUNDLE_BYTES, broadcast_rows: int = COPIES_BROADCAST) -> str:
    """Write ``pages`` (page_id, url, html) as bundles with their index below
    ``folder`` (default: a new one in the shared checkpoint folder)."""
    folder = (folder or scratch_path(pages.sparkSession, "warc")).rstrip("/")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle, names = None, _names(INDEX)

        def index(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], INDEX_ARROW)

        for batch in batches:
            for row in batch.to_pylist():
                if bundle is None:
                    system, path = _opened(folder)
                    system.create_dir(f"{path}/bundles", recursive=True)
                    bundle = Bundle(f"{folder}/bundles", frame_bytes)
                closed = bundle.add(row["page_id"], *record(row["page_id"], row["url"], row["payload"], row["refers_to"], date))
                if closed:
                    yield index(closed)
                if bundle.position >= bundle_bytes:
                    yield index(bundle.close())
                    bundle = None
        if bundle is not None:
            yield index(bundle.close())

    rows = _with_copies(pages, min_bytes, broadcast_rows)
    rows.mapInArrow(run, INDEX).write.parquet(f"{folder}/index")
    return folder


INDEX_ARROW = pa.schema([(c.split()[0], {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}[c.split()[1]]) for c in INDEX.split(", ")])
RECORDS_ARROW = pa.schema([(c.split()[0], {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[c.split()[1]]) for c in RECORDS.split(", ")])


# ------------------------------------------------------------------ reading
def index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(f"{folder.rstrip('/')}/index")


def frames(spark: SparkSession, folder: str) -> DataFrame:
    """The frames of all bundles that the index names, from their seek tables."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, path = _opened(f"{folder.rstrip('/')}/bundles")
        for batch in batches:
            for name in batch["bundle"]:
                table = seek_table(system, f"{path}/{name}")
                yield pd.DataFrame([(name, i, *x) for i, x in enumerate(table)], columns=_names(FRAMES))

    return index(spark, folder).select("bundle").distinct().mapInPandas(run, FRAMES)


def _plain(file: pa.NativeFile, start: int, size: int, plain: int | None = None, checksum: int | None = None) -> bytes:
    data = zstandard.ZstdDecompressor().decompress(file.read_at(size, start))
    if plain is not None and len(data) != plain or checksum is not None and xxhash.xxh64(data).intdigest() & 0xFFFFFFFF != checksum:
        raise ValueError(f"damaged frame at byte {start}")
    return data


def records(spark: SparkSession, folder: str, payload: bool = True) -> DataFrame:
    """Every record of the archive, a frame at a time; ``payload``: whether the
    column is filled (null for revisits anyway)."""
    table = written(frames(spark, folder), "warc-frames")
    count, size = table.agg(F.count("*"), F.sum("plain")).first()
    parts = max(1, min(count, max(spark.sparkContext.defaultParallelism, -(-(size or 0) // (128 << 20)))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _opened(f"{folder.rstrip('/')}/bundles")
        names = _names(RECORDS)
        for batch in batches:
            for f in batch.to_pylist():
                with system.open_input_file(f"{path}/{f['bundle']}") as file:
                    data = _plain(file, f["start"], f["bytes"], f["plain"], f["checksum"])
                rows = [dict(zip(names, r)) for r in parse(data)]
                if not payload:
                    rows = [r | {"payload": None} for r in rows]
                yield pa.RecordBatch.from_pylist(rows, RECORDS_ARROW)

    return table.repartition(parts, "bundle", "frame").mapInArrow(run, RECORDS)


def fetch(spark: SparkSession, folder: str, ids: DataFrame) -> DataFrame:
    """The records whose page_id is in ``ids``: only their frames are read, each
    once. A revisit comes without payload; its ``refers_to`` can be fetched."""
    wanted = index(spark, folder).join(ids.select(F.col("page_id").cast("long")).distinct(), "page_id", "left_semi")
    by_frame = wanted.groupBy("bundle", "frame_start", "frame_bytes").agg(F.array_sort(F.collect_list(F.struct("offset", "length"))).alias("places"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _opened(f"{folder.rstrip('/')}/bundles")
        names = _names(RECORDS)
        for batch in batches:
            for f in batch.to_pylist():
                with system.open_input_file(f"{path}/{f['bundle']}") as file:
                    data = _plain(file, f["frame_start"], f["frame_bytes"])
                rows = [r for p in f["places"] for r in parse(data[p["offset"]:p["offset"] + p["length"]])]
                yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], RECORDS_ARROW)

    return by_frame.mapInArrow(run, RECORDS)


def digests(pages: DataFrame) -> DataFrame:
    """Write the archive, read it back: page_id, payload_bytes, payload_digest,
    record_type, refers_to of every record found in it."""
    found = records(pages.sparkSession, write(pages), payload=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")
