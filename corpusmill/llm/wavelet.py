"""Token-id shards as wavelet matrices: one compressed file per shard.

A wavelet matrix keeps a sequence of ids as one bit-plane per id bit, highest
first; each plane holds that bit of every id in the order left by a stable
partition on the planes before it. With rank samples per plane it answers
``access(i)``, ``rank(id, i)``, ``count(id)`` and ``select(id, k)`` in time in the
number of planes, from the file alone.

File: ``WMX1``, header length (uint32), JSON header, then the named sections one
after another, each its own Zstandard frame: ``planes`` (packed bits, lowest
first, each plane padded to whole blocks), ``ranks`` (ones before each block of
:data:`BLOCK` bits, uint32), ``docs`` (doc_id int64), ``valid`` (uint8, 0 where
the id is null), ``starts`` (int64, n_docs + 1, offsets in the shard).
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import tasks, text_or_empty, work_folder, written
from .tokens import ids_of

MAGIC = b"WMX1"
#: Bits per rank sample.
BLOCK = 512
#: A shard is closed once it holds this many ids; a document is never split.
SHARD_IDS = 1 << 21


def _pack(bits: np.ndarray) -> np.ndarray:
    padded = np.zeros(-(-len(bits) // BLOCK) * BLOCK, dtype=np.uint8)
    padded[: len(bits)] = bits
    return np.packbits(padded, bitorder="little")


class WaveletMatrix:
    """Succinct sequence of ids below ``2 ** levels``."""

    def __init__(self, n: int, levels: int, zeros: list[int], planes: np.ndarray, ranks: np.ndarray):
        self.n, self.levels, self.zeros = n, levels, zeros
        self.planes = planes.reshape(levels, -1)
        self.ranks = ranks.reshape(levels, -1)

    @classmethod
    def build(cls, ids: np.ndarray) -> "WaveletMatrix":
        n = len(ids)
        levels = max(1, int(ids.max()).bit_length()) if n else 1
        now = ids.astype(np.uint16 if levels <= 16 else np.uint32)
        planes, ranks, zeros = [], [], []
        for level in range(levels):
            ones = ((now >> (levels - 1 - level)) & 1).astype(bool)
            packed = _pack(ones)
            per_block = np.bitwise_count(packed.reshape(-1, BLOCK // 8)).sum(axis=1, dtype=np.uint32)
            planes.append(packed)
            ranks.append(np.concatenate([[0], np.cumsum(per_block)]).astype(np.uint32))
            low = now[~ones]
            zeros.append(len(low))
            now = np.concatenate([low, now[ones]])
        return cls(n, levels, zeros, np.array(planes), np.array(ranks))

    def _ones(self, level: int, i: int) -> int:
        """Ones among the first i bits of a plane."""
        block, rest = divmod(i, BLOCK)
        total = int(self.ranks[level, block])
        if rest:
            part = self.planes[level, block * BLOCK // 8 : block * BLOCK // 8 + -(-rest // 8)].copy()
            if rest % 8:
                part[-1] &= (1 << rest % 8) - 1
            total += int(np.bitwise_count(part).sum())
        return total

    def _bit(self, level: int, i: int) -> int:
        return int(self.planes[level, i >> 3] >> (i & 7)) & 1

    def access(self, i: int) -> int:
        """The id at position i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        out = 0
        for level in range(self.levels):
            bit = self._bit(level, i)
            ones = self._ones(level, i)
            i = self.zeros[level] + ones if bit else i - ones
            out = out << 1 | bit
        return out

    def _range(self, token: int, i: int) -> tuple[int, int]:
        """Where the token's occurrences before i lie below the last plane."""
        if token >> self.levels:
            return 0, 0
        lo, hi = 0, min(i, self.n)
        for level in range(self.levels):
            a, b = self._ones(level, lo), self._ones(level, hi)
            if token >> (self.levels - 1 - level) & 1:
                lo, hi = self.zeros[level] + a, self.zeros[level] + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def rank(self, token: int, i: int) -> int:
        """Occurrences of the token before position i."""
        lo, hi = self._range(token, i)
        return hi - lo

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def _select_bit(self, level: int, bit: int, k: int) -> int:
        """Position of the k-th (from 0) such bit of a plane."""
        ranks = self.ranks[level].astype(np.int64)
        if not bit:
            ranks = np.arange(len(ranks), dtype=np.int64) * BLOCK - ranks
        block = int(np.searchsorted(ranks, k, side="right")) - 1
        bits = np.unpackbits(self.planes[level, block * BLOCK // 8 : (block + 1) * BLOCK // 8], bitorder="little")
        return block * BLOCK + int(np.flatnonzero(bits == bit)[k - int(ranks[block])])

    def select(self, token: int, k: int) -> int:
        """Position of the k-th (from 0) occurrence of the token; -1 if there is none."""
        lo, hi = self._range(token, self.n)
        if not 0 <= k < hi - lo:
            return -1
        i = lo + k
        for level in reversed(range(self.levels)):
            if token >> (self.levels - 1 - level) & 1:
                i = self._select_bit(level, 1, i - self.zeros[level])
            else:
                i = self._select_bit(level, 0, i)
        return i

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, k) for k in range(self.count(token))]

    def decode(self) -> np.ndarray:
        """All ids, undoing the partitions from the last plane up."""
        bits = np.unpackbits(self.planes, axis=1, count=self.n, bitorder="little").view(bool) if self.n else None
        ids = np.zeros(self.n, dtype=np.uint32 if self.levels > 16 else np.uint16)
        for level in reversed(range(self.levels if self.n else 0)):
            ones, zeros = bits[level], self.zeros[level]
            before = np.empty_like(ids)
            before[~ones] = ids[:zeros]
            before[ones] = ids[zeros:] | ids.dtype.type(1 << (self.levels - 1 - level))
            ids = before
        return ids.astype(np.uint32)


def shard_bytes(ids: np.ndarray, docs: list, starts: np.ndarray) -> bytes:
    """The file of one shard."""
    import zstandard

    wm = WaveletMatrix.build(ids)
    press = zstandard.ZstdCompressor(level=1)
    sections = {
        "planes": wm.planes.tobytes(),
        "ranks": wm.ranks.astype("<u4").tobytes(),
        "docs": np.array([0 if d is None else d for d in docs], dtype="<i8").tobytes(),
        "valid": np.array([d is not None for d in docs], dtype=np.uint8).tobytes(),
        "starts": starts.astype("<i8").tobytes(),
    }
    frames = {k: press.compress(v) for k, v in sections.items()}
    header = json.dumps({"n": wm.n, "levels": wm.levels, "zeros": wm.zeros, "sections": {k: len(v) for k, v in frames.items()}}).encode()
    return MAGIC + struct.pack("<I", len(header)) + header + b"".join(frames.values())


class Shard:
    """A shard file in memory: its documents and its wavelet matrix."""

    def __init__(self, data: bytes):
        import zstandard

        if data[:4] != MAGIC:
            raise ValueError("not a token shard")
        size = struct.unpack("<I", data[4:8])[0]
        header = json.loads(data[8 : 8 + size])
        press, at, raw = zstandard.ZstdDecompressor(), 8 + size, {}
        for name, length in header["sections"].items():
            raw[name] = press.decompress(data[at : at + length]) if length else b""
            at += length
        valid = np.frombuffer(raw["valid"], dtype=np.uint8)
        self.docs = [int(d) if v else None for d, v in zip(np.frombuffer(raw["docs"], dtype="<i8"), valid)]
        self.starts = np.frombuffer(raw["starts"], dtype="<i8")
        self.tokens = WaveletMatrix(
            header["n"], header["levels"], header["zeros"], np.frombuffer(raw["planes"], dtype=np.uint8), np.frombuffer(raw["ranks"], dtype="<u4")
        )


def _store(uri: str):
    """The store of a URI, open to Python on executors (file, hdfs, s3, gs, ...)."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_shards(docs: DataFrame, tokenizer_path: str, end_id: int = 1, folder: str | None = None, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Encodes all documents in ascending ``doc_id`` order (null first, ties by
    text) into shard files; returns their manifest, a written table:
    ``part, shard, path, n_docs, n_ids``.

    Rows are dealt by ranges of doc_id, so part and shard order is id order. A
    task attempt writes files of its own name; the manifest names the files of
    the attempts that were committed, others are left-overs that nothing reads.
    """
    spark = docs.sparkSession
    folder = folder or work_folder(spark, "shards")

    def encode(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        store, root = _store(folder)
        store.create_dir(root, recursive=True)
        ids, held, names, shard = [], 0, [], 0

        def close():
            starts = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
            name = f"part-{part:06d}-{shard:06d}-{uuid.uuid4().hex}.wm"
            with store.open_output_stream(f"{root}/{name}", compression=None) as out:
                out.write(shard_bytes(np.concatenate(ids), names, starts))
            row = [[part], [shard], [f"{folder}/{name}"], [len(ids)], [int(starts[-1])]]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()))], names=["part", "shard", "path", "n_docs", "n_ids"])

        for b in batches:
            docs_of = b.column(0).to_pylist()
            for row, got in ids_of(tokenizer_path, b, 1):
                ids.append(np.append(got, np.uint32(end_id)))
                names.append(docs_of[row])
                held += len(got) + 1
                if held >= shard_ids:
                    yield close()
                    ids, held, names, shard = [], 0, [], shard + 1
        if ids:
            yield close()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    dealt = rows.repartitionByRange(tasks(spark), "doc_id").sortWithinPartitions("doc_id", "text")
    return written(dealt.mapInArrow(encode, "part long, shard long, path string, n_docs long, n_ids long"), "manifest")


def shard_starts(manifest: DataFrame) -> DataFrame:
    """Adds ``first``: ids in all shards before. Sums by part, then within a part."""
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    parts = manifest.groupBy("part").agg(F.sum("n_ids").alias("part_ids"))
    earlier = parts.select("part", F.coalesce(F.sum("part_ids").over(before(Window.orderBy("part"))), F.lit(0)).alias("earlier"))
    inside = F.coalesce(F.sum("n_ids").over(before(Window.partitionBy("part").orderBy("shard"))), F.lit(0))
    return manifest.withColumn("inside", inside).join(earlier, "part").withColumn("first", F.col("earlier") + F.col("inside")).drop("inside", "earlier")


def read_shards(manifest: DataFrame) -> DataFrame:
    """Documents of the shard files: ``doc_id, start, n_tokens, token_ids``."""
    schema = "doc_id long, start long, n_tokens long, token_ids array<int>"

    def decode(batches):
        for shard, first in _opened(batches):
            ids = pa.array(shard.tokens.decode().astype(np.int32))
            lists = pa.ListArray.from_arrays(pa.array(shard.starts.astype(np.int32)), ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard.docs, pa.int64()), pa.array(shard.starts[:-1] + first), pa.array(np.diff(shard.starts)), lists], names=["doc_id", "start", "n_tokens", "token_ids"]
            )

    return _spread(manifest).mapInArrow(decode, schema)


def _spread(manifest: DataFrame) -> DataFrame:
    return shard_starts(manifest).select("path", "first").repartition(tasks(manifest.sparkSession), "path")


def _opened(batches):
    for b in batches:
        for path, first in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            store, name = _store(path)
            with store.open_input_stream(name, compression=None) as f:
                yield Shard(f.read()), first


def shard_digests(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` as read back from the shard files."""

    def digest(batches):
        for shard, first in _opened(batches):
            ids, at = shard.tokens.decode().astype("<u4"), shard.starts
            crc = [zlib.crc32(ids[at[i] : at[i + 1]]) for i in range(len(shard.docs))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard.docs, pa.int64()), pa.array(at[:-1] + first), pa.array(np.diff(at)), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"]
            )

    return _spread(manifest).mapInArrow(digest, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_counts(manifest: DataFrame, tokens: list[int]) -> DataFrame:
    """Occurrences of tokens per shard by rank queries: ``path, token, n``."""

    def look(batches):
        for b in batches:
            for path in b.column(0).to_pylist():
                store, name = _store(path)
                with store.open_input_stream(name, compression=None) as f:
                    wm = Shard(f.read()).tokens
                got = [(path, t, wm.count(t)) for t in tokens]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*got)], names=["path", "token", "n"])

    return _spread(manifest).mapInArrow(look, "path string, token long, n long")
