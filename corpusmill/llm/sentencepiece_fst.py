"""SentencePiece encoding and decoding as a weighted finite-state transducer.

The model file compiles to three machines: the normaliser (character map, longest
match first, then the dummy prefix and blanks to U+2581), an acceptor of pieces (a
trie whose final states emit piece ids) and a byte fallback, whose arcs read a
character without a piece and emit its byte pieces. Composed with an input they form
a lattice over its positions; the encoding is the lattice's shortest path in the
tropical semiring (weights add along a path, the least path wins).

Unigram models weigh an arc by its negative score. Merge (BPE) models have no
additive scores: which pieces result depends on the order of merges. Their
lattice is composed with one more machine, which follows piece x by piece y at
weight 0 where merging the text of both alone gives just (x, y), and at infinite
weight otherwise. A piece sequence is the merge result exactly if each piece
alone and each adjacent pair is, so the one path of finite weight is it, and a
position has one finite path to it at most. So states are positions for both kinds,
and one search, least weight first and farthest position first of equals, serves both.

No piece crosses the start of a blank run or a character that no longer piece
contains, so an input falls into segments, and each worker remembers segments.
Weights are double precision; of paths of equal weight the one found first counts, which
may be another than that of a library that adds in single precision. Models with user-defined or unused pieces are refused.
"""

from __future__ import annotations

import heapq
import math
import re
import struct
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from .common import text_or_empty

NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = range(1, 7)
UNIGRAM, BPE = 1, 2
BLANK = "▁"
#: Segments a worker remembers since the last turn; as many of the turn before stay.
CACHE = 250_000
#: Open arcs of a search from which those that lead nowhere new are dropped, and how
#: far behind the farthest position a merge model's may start (all are kept if it fails).
OPEN, BEHIND = 1 << 16, 4096
#: Piece pairs remembered before starting anew (the pairs in use are far fewer than all).
PAIRS = 1_000_000


def _fields(data: bytes):
    """(number, value) of a protocol buffer message: ints, floats as bytes, or bytes."""
    at = 0

    def varint():
        nonlocal at
        out = shift = 0
        while True:
            b = data[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield key >> 3, data[at : at + size]
            at += size


class CharMap:
    """Normalising transducer of a compiled character map: a double-array trie over
    UTF-8 bytes, whose final states name texts to write instead.

    At each position the longest rule is taken; a character without a rule stays.
    """

    def __init__(self, data: bytes):
        size = struct.unpack_from("<I", data)[0] if data else 0
        self.units = array("I", data[4 : 4 + size]) if size else array("I")
        self.texts = data[4 + size :]
        self.single: dict[str, str | None] = {}  # a character's own output; None where a rule may go on

    def _longest(self, data: bytes, at: int) -> tuple[int, str] | None:
        """(bytes read, text written) of the longest rule at a position."""
        units, found = self.units, None
        unit = units[0]
        node = (unit >> 10) << ((unit & 512) >> 6)
        for i in range(at, len(data)):
            node ^= data[i]
            unit = units[node]
            if unit & 0x800000FF != data[i]:
                break
            node ^= (unit >> 10) << ((unit & 512) >> 6)
            if unit >> 8 & 1:
                found = (i + 1 - at, units[node] & 0x7FFFFFFF)
        if found is None:
            return None
        return found[0], self.texts[found[1] : self.texts.index(b"\0", found[1])].decode()

    def _alone(self, c: str) -> str | None:
        """What a character gives whatever follows it, or None if longer rules start with it."""
        units, unit = self.units, self.units[0]
        node = (unit >> 10) << ((unit & 512) >> 6)
        for byte in c.encode():
            node ^= byte
            unit = units[node]
            if unit & 0x800000FF != byte:
                return c
            node ^= (unit >> 10) << ((unit & 512) >> 6)
        for byte in range(1, 256):
            if units[node ^ byte] & 0x800000FF == byte:
                return None
        return self._longest(c.encode(), 0)[1] if unit >> 8 & 1 else c

    def apply(self, text: str) -> str:
        if not self.units:
            return text
        out, at, single = [], 0, self.single
        while at < len(text):
            c = text[at]
            if c not in single:
                single[c] = self._alone(c)
            own = single[c]
            if own is None:
                data = text[at : at + 64].encode()
                found = self._longest(data, 0)
                if found:
                    out.append(found[1])
                    at += len(data[: found[0]].decode())
                    continue
                own = c
            out.append(own)
            at += 1
        return "".join(out)


class Transducer:
    """Encoder and decoder of one model file."""

    def __init__(self, data: bytes):
        self.pieces: list[tuple[str, float, int]] = []
        self.kind, self.byte_fallback, self.prefix, self.squeeze, self.charsmap = UNIGRAM, False, True, True, b""
        for number, value in _fields(data):
            if number == 1:
                own = dict(_fields(value))
                self.pieces.append((own[1].decode(), struct.unpack("<f", own[2])[0] if 2 in own else 0.0, own.get(3, NORMAL)))
            elif number == 2:
                spec = dict(_fields(value))
                self.kind, self.byte_fallback = spec.get(3, UNIGRAM), bool(spec.get(35, 0))
            elif number == 3:
                spec = dict(_fields(value))
                self.prefix, self.squeeze, self.charsmap = bool(spec.get(3, 1)), bool(spec.get(4, 1)), spec.get(2, b"")
        if any(k in (USER, UNUSED) for _, _, k in self.pieces):
            raise ValueError("models with user-defined or unused pieces are not supported")
        self.map = CharMap(self.charsmap)
        self.ids = {p: i for i, (p, _, k) in enumerate(self.pieces) if k == NORMAL}
        self.scores = {p: s for p, s, k in self.pieces if k == NORMAL}
        self.bytes = {int(p[3:5], 16): i for i, (p, _, k) in enumerate(self.pieces) if k == BYTE}
        self.unknown = next(i for i, (_, _, k) in enumerate(self.pieces) if k == UNKNOWN)
        self.trie: dict = {}
        for p in self.ids:
            node = self.trie
            for c in p:
                node = node.setdefault(c, {})
            node[""] = p
        inner = {c for p in self.ids if len(p) > 1 for c in p}
        self.adjacent = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        crossing = any(BLANK in p.lstrip(BLANK) for p in self.ids)
        joined = "".join(map(re.escape, sorted(inner - {BLANK})))
        # blanks then characters that may join, or one that joins with nothing
        self.cut = None if crossing else re.compile(f"{BLANK}*[{joined}]+|{BLANK}+|[^{BLANK}{joined}]", re.S)
        # a constant a character, so that no weight is negative: all paths of an input get the same
        lift = max([0.0, *(s / len(p) for p, s in self.scores.items())])
        self.weights = {p: 0.0 if self.kind == BPE else lift * len(p) - s for p, s in self.scores.items()}
        self.fallback_weight = 0.0 if self.kind == BPE else lift + 10.0 - min(self.scores.values(), default=0.0)
        self.labels = {p: struct.pack("=I", i) for p, i in self.ids.items()}
        self.surfaces = ["" if k == CONTROL else " ⁇ " if k == UNKNOWN else p.replace(BLANK, " ") for p, _, k in self.pieces]
        self.byte_ids = np.array([k == BYTE for _, _, k in self.pieces])
        self.segments: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.pairs: dict[tuple[str, str], bool] = {}

    # the normaliser

    def normalise(self, text: str) -> str:
        text = self.map.apply(text)
        if self.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        if not text:
            return ""
        text = (BLANK if self.prefix else "") + text.replace(" ", BLANK)
        return text.rstrip(BLANK) if self.squeeze else text

    # the machine of adjacent pieces, for merge models

    def merged(self, text: str) -> list[str]:
        """Best-scored merge first, leftmost of equals, until none applies."""
        parts = list(text)
        while len(parts) > 1:
            best, at = -math.inf, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and score > best:
                    best, at = score, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def follows(self, x: str, y: str) -> bool:
        """Weight 0 (true) or infinity (false) of piece y after piece x; x is empty at the start."""
        name = (x, y)
        known = self.pairs.get(name)
        if known is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            known = self.merged(x + y) == ([x, y] if x else [y])
            self.pairs[name] = known
        return known

    # composition with an input, and its shortest path

    def shortest_path(self, text: str, behind: int = BEHIND) -> list[str]:
        """Pieces, and characters that take the byte fallback, of the least path."""
        n, merge, trie, weights = len(text), self.kind == BPE, self.trie, self.weights
        back = array("I", bytes(4 * (n + 1)))  # length of the arc that first reached a position
        heap, limit, far, dropped = [(0.0, 0, 0)], OPEN, 0, False  # weight, minus end, start
        while heap:
            weight, end, start = heapq.heappop(heap)
            end = -end
            if end:
                if back[end] or (merge and not self.follows(text[start - back[start] : start], text[start:end])):
                    continue
                back[end] = end - start
                if end == n:
                    break
                far = max(far, end)
            node, stop = trie, end
            while stop < n and (node := node.get(text[stop])) is not None:
                stop += 1
                if "" in node and not back[stop]:
                    heapq.heappush(heap, (weight if merge else weight + weights[node[""]], -stop, end))
            if end < n and text[end] not in weights and not back[end + 1]:
                heapq.heappush(heap, (weight + self.fallback_weight, -end - 1, end))
            if len(heap) > limit:
                kept = [a for a in heap if not back[-a[1]] and (not merge or a[2] >= far - behind)]
                dropped = dropped or merge
                heapq.heapify(kept)
                heap, limit = kept, max(OPEN, 2 * len(kept))
        if n and not back[n]:
            return self.shortest_path(text, n) if dropped and behind < n else self.merged(text)
        out, at = [], n
        while at:
            out.append(text[at - back[at] : at])
            at -= back[at]
        return out[::-1]

    def _fallback(self, c: str) -> bytes:
        """What the byte fallback emits for a character: its byte pieces, or the unknown piece."""
        found = [self.bytes[b] for b in c.encode()] if self.byte_fallback else [self.unknown]
        out = struct.pack(f"={len(found)}I", *found)
        if len(self.labels) < len(self.ids) + CACHE:
            self.labels[c] = out
        return out

    def _ids(self, text: str) -> bytes:
        """The output labels along the shortest path."""
        labels = self.labels
        return b"".join([labels.get(p) or self._fallback(p) for p in self.shortest_path(text)])

    def _segment(self, segment: str) -> bytes:
        """Ids of a segment, cut where two neighbours stand side by side in no piece."""
        cuts = [i for i in range(1, len(segment)) if segment[i - 1 : i + 1] not in self.adjacent]
        if cuts:
            parts = [segment[i:j] for i, j in zip([0, *cuts], [*cuts, len(segment)])]
            out = b"".join([self.segments.get(p) or self._remembered(p) for p in parts])
        else:
            out = self._ids(segment)
        return out

    def _remembered(self, segment: str) -> bytes:
        out = self.older.get(segment) or self._segment(segment)
        if len(segment) <= 48:
            if len(self.segments) >= CACHE:
                self.older, self.segments = self.segments, {}
            self.segments[segment] = out
        return out

    def encode(self, text: str) -> np.ndarray:
        """Piece ids of a whole text, as uint32."""
        text = self.normalise(text)
        if self.cut is None:
            out = self._ids(text)
        else:
            out = b"".join([self.segments.get(s) or self._remembered(s) for s in self.cut.findall(text)])
        ids = np.frombuffer(out, dtype=np.uint32)
        if self.byte_fallback or len(ids) < 2:
            return ids
        none = ids == self.unknown  # unknown characters in a row are one piece
        return ids[np.concatenate(([True], ~(none[1:] & none[:-1])))]

    def decode(self, ids) -> str:
        """The text of piece ids: byte pieces in a row are UTF-8; the dummy prefix goes."""
        ids, surfaces, lead = np.asarray(ids, dtype=np.int64), self.surfaces, ""
        if self.prefix or self.squeeze:  # a blank goes off the first piece, or off each before any text
            skip = 0
            while skip < len(ids) and not lead and self.pieces[ids[skip]][2] in (NORMAL, CONTROL):
                lead = surfaces[ids[skip]]
                skip += 1
                if lead.startswith(" "):
                    lead = lead[1:]
                    if not self.squeeze:
                        break
            ids = ids[skip:]
        edges = np.flatnonzero(np.diff(self.byte_ids[ids].astype(np.int8), prepend=0, append=0)).tolist()  # of runs of byte pieces
        listed, out, at = ids.tolist(), [lead], 0
        for first, end in zip(edges[::2], edges[1::2]):
            out.extend(map(surfaces.__getitem__, listed[at:first]))
            out.append(bytes(int(self.pieces[i][0][3:5], 16) for i in listed[first:end]).decode("utf-8", "replace"))
            at = end
        out.extend(map(surfaces.__getitem__, listed[at:]))
        return "".join(out)


_LOADED: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    """The compiled model of a file, once in each Python worker."""
    if path not in _LOADED:
        with open(path, "rb") as f:
            _LOADED[path] = Transducer(f.read())
    return _LOADED[path]


def encode(docs: DataFrame, model_path: str, text_col: str = "text", into: str = "piece_ids") -> DataFrame:
    """All columns and the piece ids of each whole text; null text counts as empty.

    A column that has the name ``into`` is replaced.
    """
    kept = docs.drop(into)

    def run(batches):
        machine = transducer(model_path)
        for b in batches:
            ids = pa.array([machine.encode(t.as_py() or "").astype(np.int32) for t in b.column(text_col)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*b.columns, ids], names=[*b.schema.names, into])

    return kept.mapInArrow(run, StructType([*kept.schema.fields, StructField(into, ArrayType(IntegerType()))]))


def decode(df: DataFrame, model_path: str, ids_col: str = "piece_ids", into: str = "decoded") -> DataFrame:
    """All columns and the text of the piece ids; null ids give null."""
    kept = df.drop(into)

    def run(batches):
        machine = transducer(model_path)
        for b in batches:
            texts = [None if i is None else machine.decode(i) for i in b.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=[*b.schema.names, into])

    return kept.mapInArrow(run, StructType([*kept.schema.fields, StructField(into, StringType())]))


def encode_documents(docs: DataFrame, model_path: str) -> DataFrame:
    """``doc_id, n_pieces, ids_crc32, n_chars, round_trip`` of every row: encoded,
    and decoded again. Null text counts as empty (no pieces)."""

    def run(batches):
        machine = transducer(model_path)
        for b in batches:
            rows = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                text = text.as_py()
                ids = machine.encode(text)
                rows.append((doc, len(ids), zlib.crc32(ids.astype("<u4")), len(text), machine.decode(ids) == text))
            cols = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()))], names=["doc_id", "n_pieces", "ids_crc32", "n_chars", "round_trip"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_pieces long, ids_crc32 long, n_chars long, round_trip boolean")
