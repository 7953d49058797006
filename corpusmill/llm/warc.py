"""WARC archives in seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each a group of whole WARC
records, closed by a seek table in a skippable frame (the published seekable
format: per frame compressed and decompressed size, then frame count, descriptor
and magic number). The index maps a record to (bundle, frame, offset in the
frame, length), so one record is read by decompressing one frame.

Of pages with equal payload the one with the smallest id is a ``response``; the
others are ``revisit`` records, which refer to it and hold no payload.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import tasks, work_folder, written

#: Raw bytes from which a frame is closed.
FRAME_BYTES = 1 << 18
#: Raw bytes from which a bundle is closed.
BUNDLE_BYTES = 1 << 28
#: Frames that are read back at a time: 16 MB of records.
RUN_FRAMES = 64
SEEK_MAGIC, SKIPPABLE, FOOTER_MAGIC = 0x8F92EAB1, 0x184D2A5E, struct.pack("<I", 0x8F92EAB1)
#: All records bear this date, so that archives of equal pages are equal.
DATE = "2000-01-01T00:00:00Z"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'page {page_id}')}>"


def record(page_id, url: str | None, payload: bytes, digest: str, size: int, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; with ``refers_to`` a revisit, which has no payload."""
    revisit = refers_to is not None
    block = _HTTP if revisit else _HTTP + payload
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id)), ("WARC-Date", DATE)]
    target = "".join(c if 32 < ord(c) < 127 else "".join(f"%{b:02X}" for b in c.encode()) for c in url or "")
    if target:
        head.append(("WARC-Target-URI", target))
    head.append(("WARC-Payload-Digest", f"sha1:{digest}"))
    if page_id is not None:
        head.append(("X-Page-ID", str(page_id)))
    if revisit:
        head += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", record_id(refers_to)), ("X-Refers-To-Page-ID", str(refers_to)), ("X-Payload-Length", str(size))]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, at: int = 0):
    """Records of raw WARC bytes: (headers, block, where, length)."""
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError(f"no WARC record at {at}")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        start = end + 4
        stop = start + int(headers["Content-Length"])
        yield headers, data[start:stop], at, stop + 4 - at
        at = stop + 4


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The closing skippable frame: sizes of all frames, without checksums."""
    body = b"".join(struct.pack("<II", *f) for f in frames) + struct.pack("<IB", len(frames), 0) + FOOTER_MAGIC
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def read_seek_table(read_at, size: int) -> list[tuple[int, int, int]]:
    """(file offset, compressed, decompressed) of every frame, from the end of the file.

    ``read_at(offset, n)`` reads n bytes of the file, which has ``size`` bytes.
    """
    footer = read_at(size - 9, 9)
    count, flags = struct.unpack("<IB", footer[:5])
    if footer[5:] != FOOTER_MAGIC:
        raise ValueError("no seek table")
    entry = 12 if flags & 0x80 else 8
    table = read_at(size - 9 - count * entry, count * entry)
    out, at = [], 0
    for i in range(count):
        packed, raw = struct.unpack_from("<II", table, i * entry)
        out.append((at, packed, raw))
        at += packed
    return out


class BundleWriter:
    """Writes records to one open file; a frame is closed when it is large enough."""

    def __init__(self, out):
        import zstandard

        self.out, self.press = out, zstandard.ZstdCompressor(level=3)
        self.frames: list[tuple[int, int]] = []
        self.raw, self.total = bytearray(), 0

    def add(self, data: bytes) -> tuple[int, int, int]:
        """(frame, offset in the frame, length) of the record."""
        if self.raw and len(self.raw) + len(data) > FRAME_BYTES:
            self._frame()
        at = len(self.raw)
        self.raw += data
        self.total += len(data)
        return len(self.frames), at, len(data)

    def _frame(self) -> None:
        packed = self.press.compress(bytes(self.raw))
        self.out.write(packed)
        self.frames.append((len(packed), len(self.raw)))
        self.raw = bytearray()

    def close(self) -> None:
        if self.raw:
            self._frame()
        self.out.write(seek_table(self.frames))


def _store(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def payload_groups(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Every page with ``size, sha1`` and ``refers_to`` (null for responses).

    Only digests are grouped, with partial aggregation; the pages then join their
    group by digest, where a skew join may split a frequent payload.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    rows = rows.withColumn("size", F.octet_length("html").cast("long")).withColumn("sha1", F.sha1("html"))
    first = rows.where(F.col("size") >= min_bytes).groupBy("sha1", "size").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    copies = first.where("n > 1").drop("n")
    known = rows.join(copies, ["sha1", "size"], "left")
    return known.select("page_id", "url", "html", "size", "sha1", F.when(F.col("page_id") != F.col("first_id"), F.col("first_id")).alias("refers_to"))


def write_bundles(pages: DataFrame, min_bytes: int = 0, folder: str | None = None) -> DataFrame:
    """Writes one record per page; returns the index, a written table:
    ``page_id, bundle, frame, offset, length``.

    Null html is an empty payload. Rows with the smallest page id of their
    payload are responses, also where that row is repeated; a page whose id is
    null is a response. Files carry the name of their task attempt, and the index
    names those of committed attempts only.
    """
    folder = folder or work_folder(pages.sparkSession, "warc")

    def write(batches):
        from pyspark import TaskContext

        store, root = _store(folder)
        store.create_dir(root, recursive=True)
        part, number, bundle, out, writer = TaskContext.get().partitionId(), 0, None, None, None
        for b in batches:
            cols = [c.to_pylist() for c in b.columns]
            rows: list[tuple] = []
            for page_id, url, html, size, sha1, refers in zip(*cols):
                if writer is None:
                    name = f"part-{part:06d}-{number:04d}-{uuid.uuid4().hex}.warc.zst"
                    bundle, out = f"{folder}/{name}", store.open_output_stream(f"{root}/{name}", compression=None)
                    writer, number = BundleWriter(out), number + 1
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                data = record(page_id, url, html.encode() if refers is None else b"", digest, size, refers)
                rows.append((page_id, bundle, *writer.add(data)))
                if writer.total >= BUNDLE_BYTES:
                    writer.close()
                    out.close()
                    writer = None
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64()))], names=["page_id", "bundle", "frame", "offset", "length"])
        if writer is not None:
            writer.close()
            out.close()

    index = payload_groups(pages, min_bytes).mapInArrow(write, "page_id long, bundle string, frame int, offset long, length long")
    return written(index, "warc-index")


def _frame_bytes(f, wanted=None):
    """(frame number, raw bytes) of an open bundle, frame by frame; all, or those wanted."""
    import zstandard

    def read_at(at, n):
        f.seek(at)
        return f.read(n)

    for i, (at, packed, raw) in enumerate(read_seek_table(read_at, f.size())):
        if wanted is None or i in wanted:
            yield i, zstandard.ZstdDecompressor().decompress(read_at(at, packed), max_output_size=raw)


def read_units(index: DataFrame) -> DataFrame:
    """``bundle, run, frames``: the indexed frames in runs of :data:`RUN_FRAMES`, dealt
    out to all tasks of the session, so that a large bundle is read by several."""
    spark = index.sparkSession
    frames = index.select("bundle", "frame").distinct()
    runs = frames.groupBy("bundle", F.floor(F.col("frame") / RUN_FRAMES).alias("run")).agg(F.collect_set("frame").alias("frames"))
    width = max(tasks(spark), spark.sparkContext.defaultParallelism)
    # rows, not keys, are dealt: a repartition by the keys of the aggregate would be optimised away
    return runs.withColumn("turn", F.xxhash64("bundle", "run")).repartition(width, "turn").select("bundle", "run", "frames")


def read_bundles(index: DataFrame) -> DataFrame:
    """Every record of the indexed frames, parsed from the files:
    ``page_id, record_type, payload_bytes, payload_digest, refers_to, url, payload``.

    For a response, size and digest are computed anew from the payload read.
    """
    schema = "page_id long, record_type string, payload_bytes long, payload_digest string, refers_to long, url string, payload binary"
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary())

    def read(batches):
        for b in batches:
            for path, frames in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                store, name = _store(path)
                with store.open_input_file(name) as f:
                    for _, raw in _frame_bytes(f, set(frames)):
                        rows = [_page(headers, block) for headers, block, _, _ in parse(raw)]
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=[x.split()[0] for x in schema.split(", ")])

    return read_units(index).mapInArrow(read, schema)


def _page(headers: dict, block: bytes) -> tuple:
    page = headers.get("X-Page-ID")
    page_id = None if page is None else int(page)
    if headers["WARC-Type"] == "revisit":
        return page_id, "revisit", int(headers["X-Payload-Length"]), headers["WARC-Payload-Digest"].removeprefix("sha1:"), int(headers["X-Refers-To-Page-ID"]), headers.get("WARC-Target-URI"), None
    payload = block[block.index(b"\r\n\r\n") + 4 :]
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    if headers["WARC-Payload-Digest"] != f"sha1:{digest}":
        raise ValueError(f"page {page_id}: the payload does not match its digest")
    return page_id, "response", len(payload), digest, None, headers.get("WARC-Target-URI"), payload


def fetch(index: DataFrame, page_ids: list[int]) -> DataFrame:
    """Single records by random access: one frame is decompressed for each."""

    def look(batches):
        for b in batches:
            for page_id, path, frame, offset, length in zip(*(c.to_pylist() for c in b.columns)):
                store, name = _store(path)
                with store.open_input_file(name) as f:
                    _, data = next(_frame_bytes(f, {frame}))
                yield pa.RecordBatch.from_arrays([pa.array([page_id], pa.int64()), pa.array([data[offset : offset + length]])], names=["page_id", "record"])

    return index.where(F.col("page_id").isin(page_ids)).mapInArrow(look, "page_id long, record binary")
