"""Seekable Zstandard WARC bundles.

Records are grouped into frames of about ``frame_bytes``; every frame is an
independent Zstandard frame, so one record is read by decompressing one frame.
A bundle ends with the seek table of the Zstandard seekable format (a
skippable frame with the sizes of all frames). The index maps each record to
(bundle, frame, offset in the frame, length).

Of records with equal payloads of at least ``min_revisit`` bytes the one with
the largest id is the response, the others are revisits that name it. Only ids
and digests are shuffled to find it: the largest id per digest is a partial
aggregate, so a payload that a third of all pages share costs one row per map
task. The pages themselves are written by the tasks that scan them.

Bundles are written through ``pyarrow.fs`` into the shared folder, under a name
of the task attempt; the index lists only what committed attempts wrote, so a
lost executor or a repeated task leaves at most an unlisted file.

Defined results: a null payload is empty; payloads under ``min_revisit`` bytes
are always responses; rows that repeat an id with the same payload all become
records (a repeat of the response row is a response); a null id has record id
``null``, and is a response only if no other record holds its payload; empty
tables give an empty index and no bundle.
"""

from __future__ import annotations

import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_batch, staged, start, utf8, work_dir

FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 256 << 20
MIN_REVISIT = 1000
LEVEL = 3

# The Zstandard seekable format and WARC 1.1.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
WARC_VERSION = b"WARC/1.1\r\n"
REVISIT_PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: A fixed date keeps archives of equal input equal byte for byte.
DATE = b"1970-01-01T00:00:00Z"


def folder(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder's URI; a plain path is a shared local mount."""
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else "file://" + path)


# ---- records ---------------------------------------------------------------

def record(key: int | None, url: str | None, payload: bytes, digest: str, size: int,
           refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record. A revisit holds the HTTP header only, with the length
    and digest of the full payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = http if revisit else http + payload
    head = [(b"WARC-Type", b"revisit" if revisit else b"response"), (b"WARC-Record-ID", _id(key)),
            (b"WARC-Date", DATE), (b"WARC-Target-URI", _clean(url)), (b"WARC-Payload-Digest", b"sha1:" + digest.encode())]
    if revisit:
        head += [(b"WARC-Refers-To", _id(refers_to)), (b"WARC-Profile", REVISIT_PROFILE)]
    head += [(b"Content-Type", b"application/http; msgtype=response"), (b"Content-Length", b"%d" % len(block))]
    return WARC_VERSION + b"".join(k + b": " + v + b"\r\n" for k, v in head) + b"\r\n" + block + b"\r\n\r\n"


def _id(key: int | None) -> bytes:
    return b"<urn:page:%s>" % (b"null" if key is None else b"%d" % key)


def _key(value: bytes) -> int | None:
    name = value[len(b"<urn:page:"):-1]
    return None if name == b"null" else int(name)


def _clean(url: str | None) -> bytes:
    """A header value: no line break can end the header early."""
    return b"".join(b"%%%02X" % c if c < 0x20 or c == 0x7F else bytes([c]) for c in utf8(url)) if url else b""


def parse(data: bytes, at: int) -> tuple[dict[bytes, bytes], bytes, int]:
    """Header, block and end of the record at an offset."""
    split = data.index(b"\r\n\r\n", at)
    lines = data[at:split].split(b"\r\n")
    if lines[0] + b"\r\n" != WARC_VERSION:
        raise ValueError("no WARC record at this offset")
    header = dict(line.split(b": ", 1) for line in lines[1:])
    begin = split + 4
    end = begin + int(header[b"Content-Length"])
    return header, data[begin:end], end + 4


# ---- bundles ---------------------------------------------------------------

class BundleWriter:
    """Writes frames and, at the end, the seek table."""

    def __init__(self, out):
        self.out, self.frames = out, []
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)
        self.size = 0

    def frame(self, data: bytes) -> None:
        packed = self.compressor.compress(data)
        self.out.write(packed)
        self.frames.append((len(packed), len(data)))
        self.size += len(packed)

    def close(self) -> None:
        entries = b"".join(struct.pack("<II", *f) for f in self.frames)
        self.out.write(struct.pack("<II", SKIPPABLE, len(entries) + 9) + entries
                       + struct.pack("<IBI", len(self.frames), 0, SEEKABLE))
        self.out.close()


def seek_table(source) -> list[tuple[int, int, int]]:
    """(offset, compressed size, size) of every frame, from the footer."""
    size = source.seek(0, io.SEEK_END)
    source.seek(size - 9)
    count, _, magic = struct.unpack("<IBI", source.read(9))
    if magic != SEEKABLE:
        raise ValueError("the bundle has no seek table")
    source.seek(size - 9 - 8 * count)
    entries, at, out = source.read(8 * count), 0, []
    for packed, plain in struct.iter_unpack("<II", entries):
        out.append((at, packed, plain))
        at += packed
    return out


def read_frame(source, where: tuple[int, int, int]) -> bytes:
    source.seek(where[0])
    return zstandard.ZstdDecompressor().decompress(source.read(where[1]), max_output_size=max(where[2], 1))


INDEX = [("record_id", pa.int64()), ("bundle", pa.string()), ("frame", pa.int64()),
         ("frame_offset", pa.int64()), ("length", pa.int64())]
INDEX_SQL = "record_id long, bundle string, frame long, frame_offset long, length long"


def write_bundles(pages: DataFrame, path: str | None = None, frame_bytes: int = FRAME_BYTES,
                  bundle_bytes: int = BUNDLE_BYTES, min_revisit: int = MIN_REVISIT) -> tuple[str, DataFrame]:
    """Write all pages (page_id, url, html); returns the folder and the index."""
    spark = start(pages.sparkSession)
    path = path or work_dir(spark, "warc")
    body = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        body.alias("html"), F.octet_length(body).cast("long").alias("size"), F.sha1(body).alias("digest"))
    large = rows.where(F.col("size") >= min_revisit).select("page_id", "size", "digest")
    shared = (large.groupBy("size", "digest").agg(F.max("page_id").alias("response"), F.count("*").alias("n"))
              .where("n > 1").select("size", "digest", "response"))
    revisits = staged(large.join(shared, ["size", "digest"]).where(~F.col("page_id").eqNullSafe(F.col("response")))
                      .select(F.col("page_id").alias("_page"), F.col("digest").alias("_digest"), "response").distinct(),
                      "revisits")
    marked = (rows.join(revisits, F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("digest") == F.col("_digest")), "left")
              .select("page_id", "url", F.when(F.col("_digest").isNull(), F.col("html")).alias("html"),
                      "size", "digest", "response", F.col("_digest").isNotNull().alias("revisit")))

    def write(batches):
        target, root = folder(path)
        writer, name, held, held_bytes = None, None, [], 0

        def flush():
            writer.frame(b"".join(r for _, r in held))
            at, out = 0, []
            for key, r in held:
                out.append((key, name, len(writer.frames) - 1, at, len(r)))
                at += len(r)
            return as_batch(out, INDEX)

        for batch in batches:
            for key, url, html, size, digest, response, revisit in zip(*(c.to_pylist() for c in batch.columns)):
                if writer is None:
                    target.create_dir(root, recursive=True)
                    name = f"bundle-{uuid.uuid4().hex}.warc.zst"
                    writer = BundleWriter(target.open_output_stream(f"{root}/{name}", compression=None))
                held.append((key, record(key, url, utf8(html), digest, size, response, revisit)))
                held_bytes += len(held[-1][1])
                if held_bytes >= frame_bytes:
                    yield flush()
                    held, held_bytes = [], 0
                    if writer.size >= bundle_bytes:
                        writer.close()
                        writer = None
        if held:
            yield flush()
        if writer:
            writer.close()

    return path, staged(marked.mapInArrow(write, INDEX_SQL), "warc-index")


RECORD = [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
          ("record_type", pa.string()), ("refers_to", pa.int64())]
RECORD_SQL = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def described(header: dict[bytes, bytes], block: bytes) -> tuple:
    """(page_id, payload bytes, payload digest, type, refers to) of a record;
    a response's figures come from its payload and must agree with its header."""
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    digest = header[b"WARC-Payload-Digest"].removeprefix(b"sha1:").decode()
    key, kind = _key(header[b"WARC-Record-ID"]), header[b"WARC-Type"].decode()
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"record {key} does not hold the payload that its header names")
    refers = _key(header[b"WARC-Refers-To"]) if kind == "revisit" else None
    return key, size, digest, kind, refers


def frames_of(index: DataFrame) -> DataFrame:
    """The (bundle, frame) pairs of an index, dealt out evenly."""
    return index.select("bundle", "frame").distinct()


def read_bundles(path: str, index: DataFrame) -> DataFrame:
    """Read every record of the bundles that the index lists, frame by frame."""
    start(index.sparkSession)

    def read(batches):
        source, root = folder(path)
        opened, table, current = None, [], None
        for batch in batches:
            for bundle, number in sorted(zip(*(c.to_pylist() for c in batch.columns))):
                if bundle != current:
                    if opened:
                        opened.close()
                    opened = source.open_input_file(f"{root}/{bundle}")
                    table, current = seek_table(opened), bundle
                data, at, rows = read_frame(opened, table[number]), 0, []
                while at < len(data):
                    header, block, at = parse(data, at)
                    rows.append(described(header, block))
                yield as_batch(rows, RECORD)
        if opened:
            opened.close()

    return frames_of(index).mapInArrow(read, RECORD_SQL)


def read_records(path: str, index: DataFrame, wanted: DataFrame) -> DataFrame:
    """Single records by id (column ``record_id`` of ``wanted``): record_id and
    its raw WARC bytes. Each needs its own frame only."""
    start(index.sparkSession)

    def read(batches):
        source, root = folder(path)
        for batch in batches:
            out = []
            for key, bundle, number, at, length in zip(*(c.to_pylist() for c in batch.columns)):
                with source.open_input_file(f"{root}/{bundle}") as opened:
                    data = read_frame(opened, seek_table(opened)[number])
                out.append((key, data[at:at + length]))
            yield as_batch(out, [("record_id", pa.int64()), ("record", pa.binary())])

    return index.join(wanted.select("record_id").distinct(), "record_id").select(*(n for n, _ in INDEX)) \
        .mapInArrow(read, "record_id long, record binary")
