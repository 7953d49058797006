"""Document fingerprints from improbable features in chained Bloom filters.

Every window of :data:`WINDOW` bytes has an entropy, quantised to 0..1000. How
often each value occurs in the corpus is its rank: the less often, the more
improbable. In each run of :data:`NEAR` neighbouring windows the most improbable
one (the leftmost of equals) scores; windows with enough scores are the
document's features. Features are hashed in text order into Bloom filters of
:data:`FILTER_BYTES` bytes, a new filter following once one holds
:data:`FILTER_FEATURES`. Two fingerprints are compared filter by filter through
their common bits, normalised between what chance gives and the most possible.

All arithmetic on windows is in integers over concatenated texts, so a text's
fingerprint does not depend on its neighbours.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import tasks, text_or_empty

WINDOW = 32
NEAR = 32
#: Wins out of at most NEAR from which a window is a feature.
POPULAR = 8
FILTER_BYTES = 256
FILTER_FEATURES = 160
#: Bits that a feature sets, 11 hash bits each.
HASHES = 5
#: Share of the way from chance to the largest overlap that counts as nothing.
CUT = 0.3
LEVELS = 1001
#: Bytes handled as one array: small enough for a core's cache.
SLAB = 1 << 17

_F = np.array([0] + [round(n * math.log2(n) * (1 << 16)) for n in range(1, WINDOW + 1)], dtype=np.int64)
_GAIN = np.diff(_F)  # what the sum of n log n gains when a count goes from n to n + 1
_FULL = _F[WINDOW]


def window_entropies(data: np.ndarray) -> np.ndarray:
    """Quantised entropy of every window of a byte array of at least WINDOW bytes."""
    n = len(data)
    before = np.zeros(n, dtype=np.uint8)  # equal bytes among the WINDOW - 1 before
    after = np.zeros(n, dtype=np.uint8)
    for lag in range(1, WINDOW):
        same = (data[lag:] == data[:-lag]).view(np.uint8)
        before[lag:] += same
        after[:-lag] += same
    change = _GAIN[before]
    change[WINDOW:] -= _GAIN[after[: n - WINDOW]]
    total = np.cumsum(change)[WINDOW - 1 :]
    return ((_FULL - total) * (LEVELS - 1)) // _FULL  # entropy in 0..log2(WINDOW), scaled


def _slabs(texts: list[bytes]):
    """Runs of texts of together at least SLAB bytes, or the rest: (first index, texts)."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= SLAB or i == len(texts) - 1:
            yield at, texts[at : i + 1]
            at, size = i + 1, 0


def entropy_counts(texts: list[bytes]) -> np.ndarray:
    """How many windows of these texts have each quantised entropy."""
    out = np.zeros(LEVELS, dtype=np.int64)
    for _, run in _slabs(texts):
        data = np.frombuffer(b"".join(run), dtype=np.uint8)
        if len(data) < WINDOW:
            continue
        q = window_entropies(data)
        at = 0
        inside = np.zeros(len(q), dtype=bool)
        for t in run:
            if len(t) >= WINDOW:
                inside[at : at + len(t) - WINDOW + 1] = True
            at += len(t)
        out += np.bincount(q[inside], minlength=LEVELS)
    return out


def ranks_of(counts: np.ndarray) -> np.ndarray:
    """Rank of each quantised entropy: 0 is the rarest; equals in order of entropy."""
    out = np.empty(LEVELS, dtype=np.int64)
    out[np.argsort(counts, kind="stable")] = np.arange(LEVELS)
    return out


def _features(ranks: np.ndarray, n: int) -> np.ndarray:
    """Positions of the features among the windows of one text."""
    if len(ranks) <= NEAR:
        return np.array([int(ranks.argmin())])
    key = (ranks << 32) | np.arange(len(ranks))
    step = 1
    while step < NEAR:  # minima over 2, 4, ... neighbours
        key = np.minimum(key[:-step], key[step:])
        step *= 2
    wins = np.bincount(key & 0xFFFFFFFF, minlength=len(ranks))
    return np.flatnonzero(wins >= POPULAR)


class Digest:
    """Chained filters and how many features the last one holds."""

    __slots__ = ("filters", "last")

    def __init__(self, filters: np.ndarray, last: int):
        self.filters, self.last = filters, last

    def __str__(self) -> str:
        return f"{len(self.filters)}:{self.last}:{self.filters.tobytes().hex()}"

    @classmethod
    def parse(cls, text: str) -> "Digest":
        n, last, data = text.split(":")
        return cls(np.frombuffer(bytes.fromhex(data), dtype=np.uint8).reshape(int(n), FILTER_BYTES), int(last))


def _filters(hashes: list[int]) -> Digest:
    bits = FILTER_BYTES * 8
    distinct = np.array(list(dict.fromkeys(hashes)), dtype=np.uint64)  # a repeated feature sets no new bit
    if not len(distinct):
        return Digest(np.zeros((0, FILTER_BYTES), dtype=np.uint8), 0)
    n = -(-len(distinct) // FILTER_FEATURES)
    which = np.arange(len(distinct)) // FILTER_FEATURES
    cells = np.zeros(n * bits, dtype=np.uint8)
    for k in range(HASHES):
        cells[which * bits + ((distinct >> np.uint64(11 * k)) & np.uint64(bits - 1)).astype(np.int64)] = 1
    return Digest(np.packbits(cells).reshape(n, FILTER_BYTES), len(distinct) - (n - 1) * FILTER_FEATURES)


def digests(texts: list[bytes], ranks: np.ndarray) -> list[Digest]:
    """The fingerprint of each text. Texts under a window are one feature; empty ones have none."""
    from xxhash import xxh64_intdigest

    out: list[Digest] = []
    for _, run in _slabs(texts):
        joined = b"".join(run)
        data = np.frombuffer(joined, dtype=np.uint8)
        by_window = ranks[window_entropies(data)] if len(data) >= WINDOW else None
        at = 0
        for t in run:
            if len(t) < WINDOW:
                hashes = [xxh64_intdigest(t)] if t else []
            else:
                found = _features(by_window[at : at + len(t) - WINDOW + 1], len(t)).tolist()
                hashes = [xxh64_intdigest(t[p : p + WINDOW]) for p in found]
            out.append(_filters(hashes))
            at += len(t)
    return out


def likeness(a: Digest, b: Digest) -> float:
    """0 to 1: the mean, over the filters of the one with fewer, of the best match."""
    if not len(a.filters) or not len(b.filters):
        return 1.0 if len(a.filters) == len(b.filters) else 0.0
    if (len(a.filters), a.last) > (len(b.filters), b.last):
        a, b = b, a
    ones_a = np.bitwise_count(a.filters).sum(axis=1, dtype=np.int64)
    ones_b = np.bitwise_count(b.filters).sum(axis=1, dtype=np.int64)
    weights = np.full(len(a.filters), FILTER_FEATURES)
    weights[-1] = a.last
    total = 0.0
    for i in range(len(a.filters)):
        common = np.bitwise_count(a.filters[i] & b.filters).sum(axis=1, dtype=np.int64)
        most = np.minimum(ones_a[i], ones_b)
        chance = ones_a[i] * ones_b / (FILTER_BYTES * 8)
        floor = chance + CUT * (most - chance)
        score = np.where(most > floor, (common - floor) / np.maximum(most - floor, 1e-9), (common == most) * 1.0)
        total += max(0.0, float(score.max())) * weights[i]
    return min(1.0, total / float(weights.sum()))


# ------------------------------------------------------------ on the corpus


def corpus_ranks(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Ranks from the windows of all texts: one row of :data:`LEVELS` counts a task."""

    def count(batches):
        out = np.zeros(LEVELS, dtype=np.int64)
        for b in batches:
            out += entropy_counts([t.as_py().encode() for t in b.column(0)])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(LEVELS)), pa.array(out)], names=["q", "n"])

    rows = docs.select(text_or_empty(text_col).alias("text")).mapInArrow(count, "q long, n long")
    counts = np.zeros(LEVELS, dtype=np.int64)
    for r in rows.groupBy("q").agg(F.sum("n").alias("n")).collect():  # <= LEVELS rows
        counts[r["q"]] = r["n"]
    return ranks_of(counts)


def fingerprints(docs: DataFrame, ranks: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint) of every row; null text counts as empty."""

    def run(batches):
        for b in batches:
            found = digests([t.as_py().encode() for t in b.column(1)], ranks)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([str(d) for d in found])], names=["id", "fingerprint"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {kind}, fingerprint string")


def followed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows dealt to ranges of ids, each range with the row that follows it.

    Columns ``range, tail, id, text``, sorted by the first three and text within
    partitions. A range's rows have tail false; the one or more rows with tail
    true begin the next range that has rows, after the last range the first. So
    each row's successor is next to it, and the texts are shuffled once.
    """
    ranges = tasks(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    cuts = [i / ranges for i in range(1, ranges)]
    found = rows.agg(F.percentile_approx("id", F.array(*map(F.lit, cuts)), F.lit(100 * ranges)).alias("cuts")).first()["cuts"] if cuts else []
    bounds = sorted(set(found or []))
    place = F.lit(0)
    if bounds:
        limits = F.array(*[F.lit(b).cast("long") for b in bounds])
        place = F.size(F.filter(limits, lambda b: b <= F.col("id")))
    placed = rows.withColumn("range", place)
    firsts = sorted((r["range"], r["first"]["id"]) for r in placed.groupBy("range").agg(F.min(F.struct("id")).alias("first")).collect())  # a row a range
    # the range before, by the id that begins a range
    before = {first: firsts[i - 1][0] for i, (_, first) in enumerate(firsts)}
    named = [k for k in before if k is not None]
    earlier = F.lit(None).cast("int")
    if named:
        table = F.map_from_arrays(F.array(*[F.lit(k).cast("long") for k in named]), F.array(*[F.lit(before[k]) for k in named]))
        earlier = F.try_element_at(table, F.col("id"))
    earlier = F.when(F.col("id").isNull(), F.lit(before.get(None)).cast("int")).otherwise(earlier)
    own = F.struct(F.col("range").alias("range"), F.lit(False).alias("tail"))
    more = F.struct(earlier.alias("range"), F.lit(True).alias("tail"))
    copies = F.when(earlier.isNull(), F.array(own)).otherwise(F.array(own, more))
    dealt = placed.select(F.explode(copies).alias("c"), "id", "text").select("c.range", "c.tail", "id", "text")
    return dealt.repartitionById(ranges, "range").sortWithinPartitions("range", "tail", "id", "text")


def fingerprint_edits(docs: DataFrame, ranks: np.ndarray | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how like they are.

    The edited text has the last quarter of the code points (rounded down)
    replaced by the first as many of the next document by doc_id, ties by text,
    null ids first; the first document follows the last. Null text counts as
    empty. Repeated rows count as documents of their own. An empty table gives
    no rows. ``ranks`` are those of all texts if not given.
    """
    ranks = corpus_ranks(docs) if ranks is None else ranks

    def run(batches):
        held = None  # (range, id, text, digest) still without its successor
        for b in batches:
            cols = [c.to_pylist() for c in b.columns]
            own = digests([t.encode() for t in cols[3]], ranks)
            ready, edits = [], []
            for where, tail, doc, text, digest in zip(*cols, own):
                if held is not None and held[0] == where:
                    k = len(held[2]) // 4
                    ready.append((held, digest))
                    edits.append((held[2][: len(held[2]) - k] + text[:k]).encode())
                held = None if tail else (where, doc, text, digest)
            out = []
            for (old, following), edit, changed in zip(ready, edits, digests(edits, ranks)):
                out.append((old[1], len(old[2]), hashlib.sha256(edit).hexdigest(), str(old[3]), str(changed), likeness(old[3], changed), likeness(old[3], following)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
    return followed(docs).mapInArrow(run, schema)
