"""SimHash near-duplicates: fingerprints, pigeonhole blocks, verified distance.

A fingerprint has 64 bits, so two that differ in at most two bits agree on at
least ``BLOCKS - 2`` of its ``BLOCKS`` blocks. Distinct fingerprints are joined
on every choice of that many blocks, and pairs are verified by Hamming distance.
A block bucket that holds more than ``SMALL_BUCKET`` fingerprints (a large group
of near copies) is not paired up: there each fingerprint is filed under itself
and under each of its one-bit neighbours outside the shared blocks. Two differ
in at most two bits exactly if they meet under such a name, and all that meet
there are linked to the smallest, so the rows stay linear in the bucket and no
link between different components is lost.
"""

from __future__ import annotations

import hashlib
import math
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from .common import forget, rows_of, tasks, text_or_empty, work_folder, written
from ..operators.components import connected_components

BITS = 64
#: Differing bits up to which fingerprints link.
DISTANCE = 2
#: Blocks of the fingerprint; keys are all choices of BLOCKS - DISTANCE of them.
BLOCKS = 5
#: Fingerprints of a bucket that are compared pair by pair.
SMALL_BUCKET = 32

_WORD = re.compile("[^\x20\x09-\x0D]+")
_UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
#: Bits set in each byte value, lowest bit first: row b is the bits of b.
_BITS_OF = ((np.arange(256)[:, None] >> np.arange(8)[None, :]) & 1).astype(np.int64)


def shingles(text: str, width: int) -> list[str]:
    """Word shingles, repeats included; fewer words than the width make one."""
    words = _WORD.findall(text.translate(_UPPER) if not text.isascii() else text.lower())
    if len(words) <= width:
        return [" ".join(words)] if words else []
    columns = [words[i : len(words) - width + 1 + i] for i in range(width)]
    return [" ".join(s) for s in zip(*columns)]


def fingerprint(text: str | None, width: int = 3, seed: int = 42) -> int:
    """A bit is set if it is set in over half the shingles' XXH64 values."""
    from xxhash import xxh64_intdigest

    parts = shingles(text or "", width)
    if not parts:
        return 0
    hashes = np.array([xxh64_intdigest(s, seed) for s in parts], dtype="<u8")
    lanes = hashes.view(np.uint8).reshape(-1, 8)
    out = 0
    for lane in range(8):
        seen = np.bincount(lanes[:, lane], minlength=256)
        ones = (seen[:, None] * _BITS_OF).sum(axis=0)
        for bit in np.flatnonzero(2 * ones > len(parts)):
            out |= 1 << (8 * lane + int(bit))
    return out


def with_fingerprints(docs: DataFrame, id_col: str = "doc_id", width: int = 3, text_col: str = "text") -> DataFrame:
    """(id, fp) with the fingerprint as a signed 64-bit integer."""

    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), width) for t in b.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], names=["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {kind}, fp long")


def _block_masks() -> list[int]:
    cuts = [round(i * BITS / BLOCKS) for i in range(BLOCKS + 1)]
    blocks = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(cuts, cuts[1:])]
    return [sum(c) for c in combinations(blocks, BLOCKS - DISTANCE)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(fps: DataFrame) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column ``fp``) that connect all
    pairs within :data:`DISTANCE`: every such pair of a small bucket, and stars
    with the same components in a large one. Linear in the fingerprints."""
    masks = _block_masks()
    keys = F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in masks]))
    filed = fps.select("fp", keys.alias("choice", "block"))
    shared = filed.groupBy("choice", "block").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    filed = written(filed.join(shared, ["choice", "block"]), "blocks")

    near = lambda x, y: F.bit_count(x.bitwiseXOR(y)) <= DISTANCE
    small = filed.where(F.col("n") <= SMALL_BUCKET).groupBy("choice", "block").agg(F.collect_list("fp").alias("fps"))
    pairs = F.flatten(
        F.transform("fps", lambda x: F.transform(
            F.filter("fps", lambda y: (x < y) & near(x, y)), lambda y: F.struct(x.alias("a"), y.alias("b"))
        ))
    )
    by_pair = small.select(F.explode(pairs).alias("p")).select("p.a", "p.b")

    outside = F.array(*[
        F.array(*[F.lit(_signed(1 << i)) for i in range(BITS) if not m >> i & 1]) for m in masks
    ])
    names = F.array_append(
        F.transform(F.element_at(outside, F.col("choice") + 1), lambda bit: F.col("fp").bitwiseXOR(bit)), F.col("fp")
    )
    named = filed.where(F.col("n") > SMALL_BUCKET).select("choice", "fp", F.explode(names).alias("name"))
    centres = named.groupBy("choice", "name").agg(F.min("fp").alias("least"), F.count(F.lit(1)).alias("met")).where("met > 1")
    by_name = named.join(centres, ["choice", "name"]).where("fp <> least").select(
        F.col("least").alias("a"), F.col("fp").alias("b")
    )
    return by_pair.unionByName(by_name).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", width: int = 3, text_col: str = "text") -> DataFrame:
    """(id, fingerprint, component_id) of every row.

    ``component_id`` is the smallest id reachable over links of fingerprints that
    differ in at most two bits, the row's own included. Null text counts as
    empty: no words, fingerprint zero, linked like any other. Repeated rows keep
    their number; a row with null id gets the component's smallest id, null if
    all ids of the component are null. An empty table gives no rows.
    """
    rows = written(with_fingerprints(docs, id_col, width, text_col), "fingerprints")
    fps = written(rows.groupBy("fp").agg(F.min("id").alias("least_id")), "distinct")
    labels = connected_components(links(fps.select("fp"))).withColumnRenamed("node", "fp")
    joined = fps.join(labels, "fp", "left").withColumn("root", F.coalesce("component", "fp"))
    least = joined.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = joined.select("fp", "root").join(least, "root").select("fp", "component_id")
    return rows.join(named, "fp").select(
        "id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


# ------------------------------------------- by similarity of word shingles

#: Bits of a parity sketch: each shingle turns one bit over.
SKETCH = 1024
#: One text in so many is looked at to tell common shingles.
SAMPLE_OF = 16
#: Texts of the sample from which a shingle counts as common, and the most that are listed.
COMMON_IN, COMMON_MOST = 3, 1_000_000
#: Sampled texts from which a shingle's block is grouped by aggregation, not packed.
HOT_IN = 16
#: Keys that a packed bucket holds on average.
BUCKET_KEYS = 250_000
#: Members of a group that are compared pair by pair in one task.
BUCKET = 512
#: A row's number is that of the task that wrote it, and this many bits for the row in it.
PART_BITS = 32
#: Rounding that a comparison of shares forgives.
_EPS = 1e-9


def shingle_hashes(text: str, width: int = 5) -> np.ndarray:
    """XXH64 of each distinct word shingle, ascending."""
    from xxhash import xxh64_intdigest

    return np.unique(np.array([xxh64_intdigest(s, 42) for s in set(shingles(text, width))], dtype=np.uint64))


def differing_most(total: float, similarity: float) -> float:
    """Elements that two sets of ``total`` together may have alone at this Jaccard similarity."""
    return total * (1 - similarity) / (1 + similarity) + _EPS


def alike(x: set, y: set, similarity: float) -> bool:
    """Whether the exact Jaccard similarity of two sets is at least this."""
    if min(len(x), len(y)) < similarity * max(len(x), len(y)) - _EPS:
        return False
    both = len(x & y)
    return both >= similarity * (len(x) + len(y) - both) - _EPS


def common_shingles(docs: DataFrame, width: int, text_col: str) -> tuple[np.ndarray, np.ndarray]:
    """(hash ascending, count) of shingles seen in several sampled texts.

    They only order a text's shingles, rare ones first: any order gives the same
    pairs, this one keeps shared passages out of the prefixes.
    """

    def run(batches):
        for b in batches:
            for part in rows_of(b, 500):
                found = [shingle_hashes(t.as_py(), width) for t in part.column(0)]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], names=["h"])

    text = text_or_empty(text_col).alias("text")
    seen = docs.select(text).where(F.pmod(F.xxhash64("text"), F.lit(SAMPLE_OF)) == 0).mapInArrow(run, "h long")
    often = seen.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= COMMON_IN)
    rows = often.orderBy(F.desc("n"), "h").limit(COMMON_MOST).toArrow()
    hashes = rows["h"].to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], rows["n"].to_numpy().astype(np.int64)[order]


def with_prefixes(docs: DataFrame, width: int, similarity: float, text_col: str, common: np.ndarray, counts: np.ndarray) -> DataFrame:
    """All columns and ``__row`` (a number), ``__set`` (digest of the shingle set),
    ``__n`` (its size), ``__sketch``, ``__keys`` (the rarest shingles, so many that
    two sets at ``similarity`` have one of them in common); a written table."""
    shared = docs.sparkSession.sparkContext.broadcast((common, counts))  # COMMON_MOST at most

    def keys_of(hashes: np.ndarray) -> np.ndarray:
        known, counts = shared.value
        n = len(hashes)
        prefix = n - math.ceil(similarity * n - _EPS) + 1
        if len(known) and n:
            at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            hashes = hashes[np.argsort(np.where(known[at] == hashes, counts[at], 0), kind="stable")]
        return hashes[:prefix].view(np.int64)

    def run(batches):
        at = TaskContext.get().partitionId() << PART_BITS
        for b in batches:
            for part in rows_of(b, 1000):
                found = [shingle_hashes(t.as_py() or "", width) for t in part.column(text_col)]
                sketches = [np.packbits(np.bincount(h % np.uint64(SKETCH), minlength=SKETCH).astype(np.uint8) & 1).tobytes() for h in (f.astype(np.uint64) for f in found)]
                new = [
                    pa.array(np.arange(at, at + part.num_rows, dtype=np.int64)),
                    pa.array([hashlib.blake2b(h.tobytes(), digest_size=16).digest() for h in found], pa.binary()),
                    pa.array([len(h) for h in found], pa.int64()),
                    pa.array(sketches, pa.binary()),
                    pa.array([keys_of(h) for h in found], pa.list_(pa.int64())),
                ]
                at += part.num_rows
                yield pa.RecordBatch.from_arrays([*part.columns, *new], names=[*part.schema.names, *(f.name for f in fields)])

    fields = [
        StructField("__row", LongType()), StructField("__set", BinaryType()), StructField("__n", LongType()),
        StructField("__sketch", BinaryType()), StructField("__keys", ArrayType(LongType())),
    ]
    return written(docs.mapInArrow(run, StructType([*docs.schema.fields, *fields])), "prefixes")


def those(ids: DataFrame):
    """A function over record batches that keeps the rows whose ``__row`` is in ``ids``;
    the rows themselves need not be shuffled.

    A row's number names the task that wrote it, and a file of the written table
    holds the rows of one task. So the ids are filed by that task in the shared
    folder, and whoever reads rows looks their own tasks' few files up. It is not an
    operator of its own, so that no task needs two Python workers.
    """
    folder = work_folder(ids.sparkSession, "lookup")
    filed = ids.select("__row", F.shiftright("__row", PART_BITS).alias("part"))
    filed.repartition(tasks(ids.sparkSession), "part").write.partitionBy("part").parquet(folder)

    def keep(batches):
        import pyarrow.parquet as pq
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        known: dict[int, np.ndarray] = {}

        def listed(part: int) -> np.ndarray:
            if part not in known:
                if len(known) >= 8:
                    known.clear()
                files = store.get_file_info(fs.FileSelector(f"{root}/part={part}", allow_not_found=True))
                found = [pq.ParquetFile(store.open_input_file(f.path)).read(["__row"])["__row"].to_numpy() for f in files if f.path.endswith(".parquet")]
                known[part] = np.concatenate(found) if found else np.zeros(0, dtype=np.int64)
            return known[part]

        for b in batches:
            at = b.column("__row").to_numpy()
            parts = at >> PART_BITS
            hit = np.zeros(len(at), dtype=bool)
            for part in np.unique(parts):
                mine = parts == part
                hit[mine] = np.isin(at[mine], listed(int(part)))
            yield b.filter(pa.array(hit))

    return keep


def possible(pairs: DataFrame, entries: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) that sizes and sketches of ``entries`` don't exclude; a written table."""
    end = lambda i: entries.select(F.col("id").alias(i), F.col("n").alias(f"n_{i}"), F.col("sketch").alias(f"s_{i}"))

    def run(batches):
        for part in batches:
            if part.num_rows:
                sizes = np.stack([part.column(i).to_numpy() for i in ("n_a", "n_b")])
                x, y = (np.frombuffer(b"".join(part.column(i).to_pylist()), dtype=np.uint64).reshape(part.num_rows, -1) for i in ("s_a", "s_b"))
                far = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
                good = (far <= differing_most(sizes.sum(axis=0), similarity)) & (sizes.min(axis=0) >= similarity * sizes.max(axis=0) - _EPS)
                yield part.select(["a", "b"]).filter(pa.array(good))

    return written(pairs.join(end("a"), "a").join(end("b"), "b").mapInArrow(run, "a long, b long"), "candidates")


def verified(pairs: DataFrame, texts: DataFrame, width: int, similarity: float) -> DataFrame:
    """The pairs (a, b) whose texts' shingle sets are alike by exact Jaccard; a written table.

    ``pairs`` is a written table and ``texts`` has ``__row`` and ``text``; only texts of pairs move.
    """

    def run(batches):
        last, x = None, set()
        for b in batches:
            for part in rows_of(b, 500):
                ids = part.column(0).to_pylist()
                good = []
                for i, a in enumerate(ids):
                    if a != last:
                        last, x = a, set(shingles(part.column(2)[i].as_py(), width))
                    good.append(alike(x, set(shingles(part.column(3)[i].as_py(), width)), similarity))
                keep = pa.array(good, pa.bool_())
                yield pa.RecordBatch.from_arrays([part.column(0).filter(keep), part.column(1).filter(keep)], names=["a", "b"])

    wanted = pairs.select(F.explode(F.array("a", "b")).alias("__row")).distinct()
    used = written(texts.mapInArrow(those(wanted), texts.schema), "texts")
    one, two = used.select(F.col("__row").alias("a"), F.col("text").alias("x")), used.select(F.col("__row").alias("b"), F.col("text").alias("y"))
    out = written(pairs.join(two, "b").join(one, "a").select("a", "b", "x", "y").mapInArrow(run, "a long, b long"), "verified")
    forget(used)
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    """A hash of 64-bit numbers (the finaliser of a published generator)."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def block_groups(keys: np.ndarray, ids: np.ndarray):
    """Of entries filed under keys: pairs (a, b) of each group's members with its
    pivot, and the groups of over two members as (name, id); equal groups once."""
    order = np.lexsort((ids, keys))
    keys, ids = keys[order], ids[order]
    fresh = np.ones(len(keys), dtype=bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1])
    keys, ids = keys[fresh], ids[fresh]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, dtype=np.int64)
    sizes = np.diff(np.append(starts, len(keys)))
    shared = np.repeat(sizes > 1, sizes)
    keys, ids, sizes = keys[shared], ids[shared], sizes[sizes > 1]
    if not len(ids):
        return ids, ids, ids, ids
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    # four pivots at most for a group that shares all blocks, the same for all members of one
    turn = _mixed(ids.astype(np.uint64) * np.uint64(4) + (keys.astype(np.uint64) & np.uint64(3)))
    least = np.repeat(np.minimum.reduceat(turn, starts), sizes)
    pivots = np.repeat(ids[np.flatnonzero(turn == least)], sizes)
    low, high = np.minimum(ids, pivots), np.maximum(ids, pivots)
    order = np.lexsort((high, low))
    low, high = low[order], high[order]
    new = low != high
    new[1:] &= (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    names = np.add.reduceat(_mixed(ids.astype(np.uint64)), starts)
    first = np.zeros(len(names), dtype=bool)
    first[np.unique(names, return_index=True)[1]] = True
    member = np.repeat(first & (sizes > 2), sizes)
    return low[new], high[new], np.repeat(names, sizes)[member].view(np.int64), ids[member]


def filed_together(rows: DataFrame, keep, total: int, hot: np.ndarray) -> DataFrame:
    """What meets in a block: rows (a, b) are pairs of a member with the block's
    pivot; rows with ``g`` say that entry ``a`` is in group g, of over two. Written.

    ``rows`` has ``__row`` and ``__keys``, in all ``total`` keys at most; ``keep``
    picks rows from its batches (:func:`those`). Blocks travel packed: per batch and
    bucket one row of 8 bytes a key. ``hot`` blocks, which many texts share, are
    grouped by aggregation and a join instead, so that no bucket grows with them.
    """
    keyed, common = rows.select("__row", "__keys"), rows.sparkSession.sparkContext.broadcast(hot)
    buckets = max(1, -(-total // BUCKET_KEYS))

    def flat(b):
        """Keys and row numbers of a batch, and which keys are hot."""
        lists = b.column("__keys")
        keys = lists.flatten().to_numpy().view(np.uint64)
        ids = np.repeat(b.column("__row").to_numpy(), lists.value_lengths().to_numpy())
        known = common.value
        if not len(known) or not len(keys):
            return keys, ids, np.zeros(len(keys), dtype=bool)
        return keys, ids, known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys

    def pack(batches):
        for b in keep(batches):
            keys, ids, often = flat(b)
            keys, ids = keys[~often], ids[~often]
            bucket, part = ((keys >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32), ids >> PART_BITS
            order = np.lexsort((part, bucket))
            bucket, part = bucket[order], part[order]
            words = np.stack([(keys[order] & np.uint64(0xFFFFFFFF)).astype("<u4"), (ids[order] & ((1 << PART_BITS) - 1)).astype("<u4")], axis=1)
            cuts = np.flatnonzero((np.diff(bucket) != 0) | (np.diff(part) != 0)) + 1
            firsts = np.concatenate([[0], cuts]).astype(np.int64) if len(bucket) else np.zeros(0, dtype=np.int64)
            blobs = [w.tobytes() for w in np.split(words, cuts)] if len(bucket) else []
            yield pa.RecordBatch.from_arrays([pa.array(bucket[firsts]), pa.array(part[firsts]), pa.array(blobs, pa.binary())], names=["bucket", "part", "blob"])

    def meet(t: pa.Table) -> pa.Table:
        blobs = t.column("blob").to_pylist()
        words = np.frombuffer(b"".join(blobs), dtype="<u4").reshape(-1, 2)
        part = np.repeat(t.column("part").to_numpy(), [len(x) // 8 for x in blobs])
        low, high, names, ids = block_groups(words[:, 0], (part << PART_BITS) | words[:, 1])
        none = lambda n: pa.nulls(n, pa.int64())
        return pa.table({
            "g": pa.concat_arrays([none(len(low)), pa.array(names, pa.int64())]),
            "a": pa.array(np.concatenate([low, ids]), pa.int64()), "b": pa.concat_arrays([pa.array(high, pa.int64()), none(len(ids))]),
        })

    def often(batches):
        for b in keep(batches):
            keys, ids, hot_ones = flat(b)
            yield pa.RecordBatch.from_arrays([pa.array(keys[hot_ones].view(np.int64)), pa.array(ids[hot_ones])], names=["g", "id"])

    rare = keyed.mapInArrow(pack, "bucket int, part long, blob binary").groupBy("bucket").applyInArrow(meet, "g long, a long, b long")
    filed = keyed.mapInArrow(often, "g long, id long")
    pivot = F.min_by("id", F.xxhash64(F.pmod("g", F.lit(4)), F.col("id"))).alias("p")
    shared = filed.groupBy("g").agg(pivot, F.count(F.lit(1)).alias("members")).where("members > 1")
    met = filed.join(shared, "g")
    pairs = met.where("id <> p").select(F.lit(None).cast("long").alias("g"), F.least("id", "p").alias("a"), F.greatest("id", "p").alias("b")).distinct()
    groups = met.where("members > 2").select("g", F.col("id").alias("a"), F.lit(None).cast("long").alias("b"))
    return written(rare.unionByName(pairs).unionByName(groups), "met")


def bucket_pairs(ids: np.ndarray, roots: np.ndarray, sizes: np.ndarray, sketches: np.ndarray, similarity: float):
    """Index pairs of different roots that may be alike: sizes and sketches don't
    exclude it. A sketch differs in no more bits than the sets do in elements."""
    words = sketches.view(np.uint64)
    out = []
    for lo in range(0, len(ids), 64):
        x = slice(lo, lo + 64)
        far = np.zeros((len(ids[x]), len(ids)), dtype=np.int64)
        for w in range(words.shape[1]):
            far += np.bitwise_count(words[x, w][:, None] ^ words[:, w][None, :])
        least, most = np.minimum(sizes[x][:, None], sizes[None, :]), np.maximum(sizes[x][:, None], sizes[None, :])
        good = (ids[x][:, None] < ids[None, :]) & (roots[x][:, None] != roots[None, :])
        good &= (far <= differing_most(least + most, similarity)) & (least >= similarity * most - _EPS)
        i, j = np.nonzero(good)
        out.append((i + lo, j))
    return np.concatenate([i for i, _ in out]), np.concatenate([j for _, j in out])


def remaining_pairs(grouped: DataFrame, entries: DataFrame, labels: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of every group (block, id) that are not in one component yet; a written table.

    A group's largest component needs no pairs within itself, so its members are
    split into chunks that meet the other members only; those meet each other
    chunk by chunk. Rows are linear where nearly all of a group is one component.
    """
    rooted = entries.select("id", "n", "sketch").join(labels.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("component", "id"))
    members = written(grouped.join(rooted.select("id", "root"), "id").select("block", "id", "root"), "members")
    by_root = members.groupBy("block", "root").agg(F.count(F.lit(1)).alias("k"))
    whole = by_root.groupBy("block").agg(F.max_by("root", F.struct("k", "root")).alias("main"), F.max("k").alias("in_main"), F.sum("k").alias("all"))
    mixed = whole.where(F.col("all") > F.col("in_main")).select(
        "block", "main", F.ceil(F.col("in_main") / BUCKET).cast("int").alias("mains"), F.ceil((F.col("all") - F.col("in_main")) / BUCKET).cast("int").alias("others")
    )
    met = members.join(mixed, "block")
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    own = F.pmod(F.xxhash64("id"), F.when(F.col("root") == F.col("main"), F.col("mains")).otherwise(F.col("others"))).cast("int")
    key = lambda main, i, j: F.struct(F.lit(main).alias("main"), i.cast("int").alias("i"), j.cast("int").alias("j"))
    as_main = F.transform(upto("others"), lambda j: key(True, F.col("own"), j))
    as_other = F.concat(
        F.transform(upto("mains"), lambda i: key(True, i, F.col("own"))),
        F.transform(F.filter(upto("others"), lambda j: j != F.col("own")), lambda j: key(False, F.least(j, F.col("own")), F.greatest(j, F.col("own")))),
    )
    dealt = met.withColumn("own", own).select("block", "id", F.explode(F.when(F.col("root") == F.col("main"), as_main).otherwise(as_other)).alias("at"))
    # many blocks are shared by the very same members
    groups = dealt.groupBy("block", "at").agg(F.sort_array(F.collect_list("id")).alias("ids")).select("ids").distinct()
    numbered = written(groups.withColumn("g", F.monotonically_increasing_id()), "buckets")
    filled = numbered.select("g", F.explode("ids").alias("id")).join(rooted.select("id", "root", "n", "sketch"), "id")
    filled = filled.groupBy("g").agg(F.collect_list(F.struct("id", "root", "n", "sketch")).alias("m")).select("m")

    def run(batches):
        for b in batches:
            for part in rows_of(b, 100):
                lists = part.column(0)
                flat, cuts = lists.flatten(), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
                ids, roots, sizes = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(3))
                sketches = np.frombuffer(b"".join(flat.field(3).to_pylist()), dtype=np.uint8).reshape(len(ids), -1)
                for lo, hi in zip(cuts, cuts[1:]):
                    i, j = bucket_pairs(ids[lo:hi], roots[lo:hi], sizes[lo:hi], sketches[lo:hi], similarity)
                    yield pa.RecordBatch.from_arrays([pa.array(ids[lo:hi][i]), pa.array(ids[lo:hi][j])], names=["a", "b"])

    out = written(filled.mapInArrow(run, "a long, b long").distinct(), "candidates")
    for used in (members, numbered):
        forget(used)
    return out


def similar_labels(rows: DataFrame, chosen: DataFrame, hot: np.ndarray, width: int, similarity: float, text_col: str) -> DataFrame:
    """(node, component) over all pairs of rows that are ``similarity`` alike.

    ``rows`` is a table of :func:`with_prefixes`; ``chosen`` has the ``__row`` of one
    row of each set. Two sets alike share a key, so each such pair lies in a block.
    First all members of a block are compared with one of them; then every pair not
    yet in one component is. Each candidate that sizes and sketches leave is decided
    by exact Jaccard, so the components are those of all pairs.
    """
    keep, narrow = those(chosen), rows.select("__row", "__n", "__sketch")
    entries = written(narrow.mapInArrow(keep, narrow.schema).toDF("id", "n", "sketch"), "entries")
    texts = rows.select("__row", text_or_empty(text_col).alias("text"))
    total = rows.agg(F.coalesce(F.sum(F.size("__keys")), F.lit(0)).alias("n")).first()["n"]
    met = filed_together(rows, keep, total, hot)
    likely = possible(met.where("b is not null").select("a", "b").distinct(), entries, similarity)
    first = verified(likely, texts, width, similarity)
    labels = written(connected_components(first), "labels")
    grouped = met.where("b is null").select(F.col("g").alias("block"), F.col("a").alias("id")).distinct()
    rest = remaining_pairs(grouped, entries, labels, similarity)
    for used in (likely, labels, met, entries):  # each table goes when its last reader has written its own
        forget(used)
    second = verified(rest, texts, width, similarity)
    out = connected_components(first.unionByName(second))
    for used in (rest, first, second):
        forget(used)
    return out


def deduplicated(docs: DataFrame, width: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each class of near-duplicates, all columns as they were.

    Classes are the components of links between documents whose word-shingle
    sets have a Jaccard similarity of at least ``similarity``; every such pair is
    found and decided exactly. The row with the smallest id stays (null ids last,
    then the first row read). Texts without a word form one class; null text
    counts as empty. An empty table gives no rows. Columns named ``__row``, ``__set``,
    ``__n``, ``__sketch`` or ``__keys`` are kept: the stage's own stand beside them.
    """
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}  # no column clashes with the stage's own
    plain = docs.toDF(*names.values())
    common, counts = common_shingles(plain, width, names[text_col])
    rows = with_prefixes(plain, width, similarity, names[text_col], common, counts)
    id_of = F.col(names[id_col])
    best = F.min(F.struct(id_of.isNull().alias("no_id"), id_of.alias("id"), F.col("__row").alias("row")))
    sets = written(rows.groupBy("__set").agg(best.alias("best")).select("best", F.col("best.row").alias("id")), "sets")
    labels = similar_labels(rows, sets.select(F.col("id").alias("__row")), common[counts >= HOT_IN], width, similarity, names[text_col])
    rooted = sets.join(labels.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("component", "id"))
    stay = rooted.groupBy("root").agg(F.min("best").alias("b")).select(F.col("b.row").alias("__row"))
    return rows.mapInArrow(those(stay), rows.schema).select(*names.values()).toDF(*docs.columns)
