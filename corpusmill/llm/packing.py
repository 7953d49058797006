"""Best-fit packing of documents into sequences by a linear grouping scheme.

Everything that decides the packing is a histogram: how many pieces there are of
each length from 1 to the capacity. That table has at most ``capacity`` rows
whatever the corpus, so the plan is made on the driver in bounded memory:

1. lengths above ``capacity * small`` are *large*. Sorted by length they form
   groups of equal cardinality, and each length is rounded up to its group's
   largest (linear grouping), which leaves few sizes;
2. over these sizes the configuration programme (fewest sequences that cover all
   groups) is solved by column generation with a knapsack as pricing problem,
   and its solution is rounded down;
3. actual lengths take the places of the rounded ones, group by group;
4. what rounding left over and all small pieces go by best fit, longest first,
   to the sequence with the least room that still holds them.

The plan says for the k-th piece of a length which sequence and offset it gets.
Pieces learn their k from counts per input task and length (no sort, no single
task, no group that grows with a frequent length), then join the plan.
"""

from __future__ import annotations

import bisect
import warnings
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import beside, text_or_empty, written
from .tokens import ids_of

#: Lengths over this share of the capacity are grouped and configured.
SMALL = 0.4
#: Groups of equal cardinality.
GROUPS = 128
#: A plan row per length and kind of sequence; more would be a programming error.
PLAN_ROWS = 400_000


# ---------------------------------------------------------------- the plan


def linear_groups(hist: dict[int, int], least: int, groups: int) -> list[list[tuple[int, int]]]:
    """Lengths over ``least``, longest first, dealt into groups of equal cardinality.

    A group is a list of (length, count); a length may lie in two groups.
    """
    large = sorted(((n, c) for n, c in hist.items() if n > least and c > 0), reverse=True)
    total = sum(c for _, c in large)
    if not total:
        return []
    share = -(-total // groups)
    out, room = [[]], share
    for n, c in large:
        while c:
            if not room:
                out.append([])
                room = share
            take = min(room, c)
            out[-1].append((n, take))
            room -= take
            c -= take
    return out


def _best_configuration(value: np.ndarray, size: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The multiset of sizes within the capacity that has the largest value."""
    most = capacity // int(size.min())
    best = np.zeros(capacity + 1)
    picks = []
    for _ in range(most):
        room = np.arange(capacity + 1)[None, :] - size[:, None]
        with_one = np.where(room >= 0, best[np.maximum(room, 0)] + value[:, None], -1.0)
        which = with_one.argmax(axis=0)
        gain = with_one[which, np.arange(capacity + 1)]
        better = gain > best + 1e-12
        if not better.any():
            break
        picks.append(np.where(better, which, -1))
        best = np.where(better, gain, best)
    counts, at = np.zeros(len(size), dtype=np.int64), capacity
    for which in reversed(picks):
        if which[at] >= 0:
            counts[which[at]] += 1
            at -= int(size[which[at]])
    return float((counts * value).sum()), counts


def _inverse(matrix: np.ndarray) -> np.ndarray:
    """Gauss-Jordan with row pivoting, element-wise (no BLAS threads in the driver)."""
    k = len(matrix)
    work = np.concatenate([matrix.astype(float), np.eye(k)], axis=1)
    for i in range(k):
        best = i + int(np.abs(work[i:, i]).argmax())
        work[[i, best]] = work[[best, i]]
        work[i] /= work[i, i]
        factor = work[:, i].copy()
        factor[i] = 0
        work -= factor[:, None] * work[i][None, :]
    return work[:, k:]


#: Steps of the configuration programme after which it says that it has not settled.
ROUNDS = 30_000


def configurations(size: np.ndarray, demand: np.ndarray, capacity: int, rounds: int | None = None):
    """Fractional fewest sequences: (configuration, multiplicity) pairs of the basis.

    Should the programme not settle in ``rounds`` steps, its pairs still hold all the
    demand, in more sequences than need be; a warning says so.
    """
    rounds = ROUNDS if rounds is None else rounds
    k = len(size)
    basis = np.diag(capacity // size).astype(float)
    inverse = _inverse(basis)
    for step in range(rounds):
        x = (inverse * demand).sum(axis=1)
        duals = inverse.sum(axis=0)
        value, column = _best_configuration(np.maximum(duals, 0), size, capacity)
        if value <= 1 + 1e-7:
            break
        direction = (inverse * column).sum(axis=1)
        usable = direction > 1e-9
        if not usable.any():
            break
        ratios = np.where(usable, x / np.where(usable, direction, 1), np.inf)
        out = int(ratios.argmin())
        basis[:, out] = column
        if step % 50 == 49:
            inverse = _inverse(basis)
        else:  # the product form of the inverse
            pivot = inverse[out] / direction[out]
            inverse -= np.outer(direction, pivot)
            inverse[out] = pivot
    else:
        warnings.warn(f"packing: the configuration programme did not settle in {rounds} steps", stacklevel=2)
    x = (_inverse(basis) * demand).sum(axis=1)
    return [(basis[:, j].round().astype(np.int64), float(max(0.0, x[j]))) for j in range(k)]


@dataclass
class Kind:
    """``times`` sequences that hold the same lengths."""

    times: int
    lengths: list[int]
    room: int


def plan_kinds(hist: dict[int, int], capacity: int, small: float = SMALL, groups: int = GROUPS) -> list[Kind]:
    """Kinds of sequences that together hold every piece of the histogram once."""
    left = {int(n): int(c) for n, c in hist.items() if c > 0}
    kinds: list[Kind] = []
    if full := left.pop(capacity, 0):
        kinds.append(Kind(full, [capacity], 0))
    dealt = linear_groups(left, int(capacity * small), groups)
    by_size: dict[int, list[tuple[int, int]]] = {}
    for group in dealt:  # groups that round up to the same size are one
        by_size.setdefault(group[0][0], []).extend(group)
    if by_size:
        size = np.array(sorted(by_size, reverse=True), dtype=np.int64)
        runs = [[list(x) for x in by_size[int(s)]][::-1] for s in size]
        demand = np.array([sum(c for _, c in by_size[int(s)]) for s in size], dtype=float)
        solved = configurations(size, demand, capacity)
        for shape, times in sorted(solved, key=lambda p: -p[1]):
            times = int(times + 1e-6)
            wanted = [(g, int(a)) for g, a in enumerate(shape) if a]
            while times > 0:  # identical sequences at a time
                same, lengths = times, []
                for g, a in wanted:
                    if runs[g]:
                        same = min(same, max(1, runs[g][-1][1] // a))
                for g, a in wanted:
                    need = a * same
                    got: list[int] = []
                    while need and runs[g]:
                        n, c = runs[g][-1]
                        take = min(c, need)
                        got += [n] * (take // same if same > 1 else take)
                        left[n] -= take
                        need -= take
                        runs[g][-1][1] -= take
                        if not runs[g][-1][1]:
                            runs[g].pop()
                    lengths += got
                if not lengths:
                    break
                kinds.append(Kind(same, lengths, capacity - sum(lengths)))
                times -= same
    return _best_fit(kinds, left, capacity)


def _best_fit(kinds: list[Kind], left: dict[int, int], capacity: int) -> list[Kind]:
    """Longest first, each to the sequence with the least sufficient room."""
    by_room: dict[int, list[Kind]] = {}
    for kind in kinds:
        by_room.setdefault(kind.room, []).append(kind)
    rooms = sorted(by_room)

    def put(kind: Kind) -> None:
        if kind.room not in by_room:
            by_room[kind.room] = []
            bisect.insort(rooms, kind.room)
        by_room[kind.room].append(kind)

    for n in sorted((n for n, c in left.items() if c > 0), reverse=True):
        count = left[n]
        while count:
            at = bisect.bisect_left(rooms, n)
            while at < len(rooms) and not by_room[rooms[at]]:
                del by_room[rooms[at]]
                rooms.pop(at)
            if at < len(rooms):
                kind = by_room[rooms[at]].pop()
            else:
                kind = Kind(count, [], capacity)
            each = min(kind.room // n, count)
            bins = min(kind.times, count // each)
            put(Kind(bins, kind.lengths + [n] * each, kind.room - each * n))
            if kind.times > bins and kind.lengths:
                put(Kind(kind.times - bins, kind.lengths, kind.room))
            count -= bins * each
    return [k for same in by_room.values() for k in same if k.lengths]


def plan_table(kinds: list[Kind]) -> pd.DataFrame:
    """Intervals of the k-th piece of a length: where they go.

    Piece k (from 0) of ``length`` with ``lo <= k < hi`` is number ``k - lo`` of
    its interval: sequence ``base + (k - lo) // per_bin``, offset
    ``offsets[(k - lo) % per_bin]``.
    """
    seen: dict[int, int] = {}
    rows, base = [], 0
    for kind in sorted(kinds, key=lambda k: (sorted(k.lengths, reverse=True), k.times), reverse=True):
        offsets: dict[int, list[int]] = {}
        at = 0
        for n in sorted(kind.lengths, reverse=True):
            offsets.setdefault(n, []).append(at)
            at += n
        for n, places in offsets.items():
            lo = seen.get(n, 0)
            hi = lo + kind.times * len(places)
            rows.append((n, lo, hi, base, len(places), places))
            seen[n] = hi
        base += kind.times
    return pd.DataFrame(rows, columns=["length", "lo", "hi", "base", "per_bin", "offsets"])


# ------------------------------------------------------------ on the corpus


def tokenised_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """Every document's ids and the end id, cut where they exceed the capacity.

    Columns: ``doc_id, piece, start, length, token_ids, part, nth``. Only
    documents over the capacity are cut; all pieces but the first have exactly
    ``capacity`` ids. ``part`` is the input task and ``nth`` counts its pieces of
    the same length. The result is a written table, so ids are made once.
    """

    def cut(batches):
        part = TaskContext.get().partitionId()
        nth: dict[int, int] = {}
        cols: list[list] = [[], [], [], [], [], []]
        flat: list[np.ndarray] = []
        held = 0

        def batch():
            lengths = np.array(cols[3], dtype=np.int32)
            ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(flat), pa.int32()))
            arrays = [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64()), ids, pa.array(cols[4], pa.int64()), pa.array(cols[5], pa.int64())]
            return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "piece", "start", "length", "token_ids", "part", "nth"])

        for b in batches:
            names = b.column(0).to_pylist()
            for row, ids in ids_of(tokenizer_path, b, 1):
                doc, ids = names[row], np.append(ids, np.uint32(end_id)).astype(np.int32)
                n = len(ids)
                first = n if n <= capacity else (n % capacity or capacity)
                at = 0
                for piece in range(1 + -(-(n - first) // capacity)):
                    size = first if piece == 0 else capacity
                    k = nth.get(size, 0)
                    nth[size] = k + 1
                    for col, v in zip(cols, (doc, piece, at, size, part, k)):
                        col.append(v)
                    flat.append(ids[at : at + size])
                    at += size
                    held += size
                if held >= 1 << 20:
                    yield batch()
                    cols, flat, held = [[], [], [], [], [], []], [], 0
        if flat:
            yield batch()

    schema = "doc_id long, piece int, start long, length long, token_ids array<int>, part long, nth long"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return written(rows.mapInArrow(cut, schema), "pieces")


def place(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces that have ``part, nth, length``.

    Sequences have no gaps; their number is near the least possible. Uses counts
    by (part, length) only: rank = pieces of that length in earlier parts + nth.
    """
    spark = pieces.sparkSession
    counts = written(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "counts")
    hist = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= capacity rows
    if not hist:
        return pieces.withColumn("sequence_id", F.lit(0).cast("long")).withColumn("offset", F.lit(0).cast("long"))
    plan = plan_table(plan_kinds(hist, capacity))
    if len(plan) > PLAN_ROWS:
        raise RuntimeError(f"the plan has {len(plan)} rows; it is bounded by the capacity, not by the corpus")
    plan_rows = spark.createDataFrame(plan, "length long, lo long, hi long, base long, per_bin int, offsets array<int>")
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    k = F.col("earlier") + F.col("nth")
    ranked = pieces.join(beside(firsts), ["part", "length"]).withColumn("k", k)
    q = F.broadcast(plan_rows.withColumnRenamed("length", "plan_length"))
    hit = (F.col("length") == F.col("plan_length")) & (F.col("k") >= F.col("lo")) & (F.col("k") < F.col("hi"))
    at = F.col("k") - F.col("lo")
    return ranked.join(q, hit).withColumn(
        "sequence_id", F.col("base") + F.floor(at / F.col("per_bin")).cast("long")
    ).withColumn("offset", F.element_at("offsets", (F.pmod(at, F.col("per_bin")) + 1).cast("int")).cast("long")).drop(
        "k", "earlier", "lo", "hi", "base", "per_bin", "offsets", "plan_length"
    )


def ids_crc32(pieces: DataFrame, keep: list[str], ids: str = "token_ids") -> DataFrame:
    """``keep`` and the CRC-32 of the ids as little-endian unsigned 32-bit integers."""

    def digest(batches):
        for b in batches:
            col = b.column(len(keep))
            ends = col.offsets.to_numpy()
            flat = col.values.to_numpy(zero_copy_only=False).astype("<u4")
            crc = [zlib.crc32(flat[ends[i] : ends[i + 1]]) for i in range(len(col))]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(crc, pa.int64())], names=[*keep, "ids_crc32"])

    fields = ", ".join(f"{c} {pieces.schema[c].dataType.simpleString()}" for c in keep)
    return pieces.select(*keep, ids).mapInArrow(digest, f"{fields}, ids_crc32 long")


def packed_sequences(pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """The packed ids: one row per sequence, ``sequence_id, token_ids, doc_ids``.

    A sequence holds at most ``capacity`` ids, so each group is bounded.
    """
    key = ["part", "length", "nth"]
    rows = pieces.select(*key, "doc_id", "token_ids").join(placed.select(*key, "sequence_id", "offset"), key)
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "token_ids")))
    return rows.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id",
        F.flatten(F.transform("parts", lambda p: p["token_ids"])).alias("token_ids"),
        F.transform("parts", lambda p: p["doc_id"]).alias("doc_ids"),
    )


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """Packs all documents; per piece its place and the CRC-32 of its ids.

    Null text counts as empty (one end id). Repeated rows are packed once each;
    null ``doc_id`` stays null. An empty table gives no rows. Other columns of
    ``docs`` are ignored, whatever their names.
    """
    pieces = tokenised_pieces(docs, tokenizer_path, capacity, end_id)
    narrow = ids_crc32(pieces, ["doc_id", "piece", "start", "length", "part", "nth"])
    return place(written(narrow, "digests"), capacity).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
