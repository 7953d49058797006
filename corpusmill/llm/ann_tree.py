"""Approximate nearest neighbours by a hierarchical k-means tree.

The tree is grown on the driver from a bounded sample of distinct vectors. A
query walks it best bin first: a priority queue holds the branches passed by,
nearest centre first, and the next leaf is always taken from its top. How many
leaves are visited is calibrated: on sample queries visits are widened until the
recall against brute force over the sample reaches :data:`CALIBRATED`.

Every vector is filed in its leaf. Leaves with many vectors or many visitors are
cut into blocks of both, so no task gets a whole hot leaf, and equal vectors are
one entry with their smallest ids, so copies do not multiply the work.
"""

from __future__ import annotations

import hashlib
import heapq
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Distinct vectors that the tree is grown from, and bytes they may take.
SAMPLE_ROWS, SAMPLE_BYTES = 32_768, 64 << 20
BRANCHES = 8
LEAF = 64
LLOYD = 6
#: Sample queries and the recall they must reach.
CALIBRATE_QUERIES, CALIBRATED = 150, 0.97
#: Vectors and visitors of a leaf that meet in one block.
BLOCK_ROWS, BLOCK_QUERIES = 2048, 1024


def _distances(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances (rows x centres); einsum keeps BLAS threads out."""
    cross = np.einsum("ij,kj->ik", rows, centres)
    return (rows * rows).sum(axis=1)[:, None] - 2 * cross + (centres * centres).sum(axis=1)[None, :]


def _kmeans(rows: np.ndarray, k: int, rng) -> np.ndarray:
    centres = rows[rng.choice(len(rows), k, replace=False)]
    for _ in range(LLOYD):
        near = _distances(rows, centres).argmin(axis=1)
        count = np.bincount(near, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, rows)
        centres = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centres)
    return centres


@dataclass
class Tree:
    """Inner nodes as (centres, children); a child below 0 is leaf ``-child - 1``."""

    nodes: list[tuple[np.ndarray, list[int]]] = field(default_factory=list)
    leaf_rows: list[np.ndarray] = field(default_factory=list)
    visits: int = 1
    least_rows: int = 0

    @classmethod
    def grow(cls, rows: np.ndarray, seed: int = 17) -> "Tree":
        tree, rng = cls(), np.random.default_rng(seed)

        def split(part: np.ndarray) -> int:
            if len(part) > LEAF:
                centres = _kmeans(part, BRANCHES, rng)
                near = _distances(part, centres).argmin(axis=1)
                used = np.unique(near)
                if len(used) > 1:
                    at = len(tree.nodes)
                    tree.nodes.append((centres[used], []))
                    tree.nodes[at][1].extend([split(part[near == u]) for u in used])
                    return at
            tree.leaf_rows.append(part)
            return -len(tree.leaf_rows)

        split(rows)
        return tree

    def leaves_of(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of each row: nearest centre at every node."""
        out = np.zeros(len(rows), dtype=np.int64)
        todo = [(0, np.arange(len(rows)))] if self.nodes else []
        while todo:
            node, which = todo.pop()
            centres, children = self.nodes[node]
            near = _distances(rows[which], centres).argmin(axis=1)
            for c, child in enumerate(children):
                part = which[near == c]
                if len(part) and child >= 0:
                    todo.append((child, part))
                elif len(part):
                    out[part] = -child - 1
        return out

    def best_bins(self, query: np.ndarray):
        """Leaves in best-bin-first order."""
        if not self.nodes:
            yield 0
            return
        queue = [(0.0, 0)]
        while queue:
            _, at = heapq.heappop(queue)
            while at >= 0:
                centres, children = self.nodes[at]
                gap = centres - query
                far = (gap * gap).sum(axis=1)
                best = int(far.argmin())
                for c, child in enumerate(children):
                    if c != best:
                        heapq.heappush(queue, (float(far[c]), child))
                at = children[best]
            yield -at - 1

    def visited(self, query: np.ndarray, keep: int) -> tuple[list[int], float]:
        """The calibrated number of leaves, more while they held too few sample rows,
        and how far the keep-th nearest sample row in them is: as these rows are
        entries of the visited leaves, nothing farther can be among the nearest."""
        out, far, rows = [], [], 0
        for leaf in self.best_bins(query):
            gap = self.leaf_rows[leaf] - query
            out.append(leaf)
            far.append(np.sqrt((gap * gap).sum(axis=1)))
            rows += len(gap)
            if len(out) >= self.visits and rows >= self.least_rows:
                break
        every = np.concatenate(far)
        return out, float(np.partition(every, keep - 1)[keep - 1]) if len(every) >= keep else float("inf")

    def calibrate(self, rows: np.ndarray, k: int, seed: int = 17) -> float:
        """Widens ``visits`` until the sample's recall at k is reached; returns it."""
        rng = np.random.default_rng(seed)
        picked = rng.choice(len(rows), min(CALIBRATE_QUERIES, len(rows)), replace=False)
        home = self.leaves_of(rows)
        needed = []  # per true neighbour, how many leaves must be visited to meet it
        for q in picked:
            gap = rows - rows[q]
            far = (gap * gap).sum(axis=1)
            far[q] = np.inf
            true = np.argsort(far, kind="stable")[: min(k, len(rows) - 1)]
            order = {leaf: i for i, leaf in enumerate(self.best_bins(rows[q]))}
            needed += [order[int(home[t])] + 1 for t in true]
        needed = np.array(needed)
        self.visits, self.least_rows = 1, 4 * (k + 1)
        while needed.size and (needed <= self.visits).mean() < CALIBRATED and self.visits < len(self.leaf_rows):
            self.visits += max(1, self.visits // 4)
        return float((needed <= self.visits).mean()) if needed.size else 1.0


# ------------------------------------------------------------ on the table


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id, key, v``: vectors that take part, with a digest of their values.

    Left out are rows with null id, and vectors null, empty, zero, or with null
    or non-finite components, or of another dimension than the most frequent
    (the smaller of two as frequent).
    """
    v = F.col(vec_col).cast("array<double>")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("v", lambda x: x != 0)
    rows = df.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where("id is not null and v is not null and size(v) > 0").where(fine)
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if sizes is None:
        return rows.select("id", F.lit(b"").alias("key"), "v")
    dim = sizes["d"]

    def keyed(batches):
        for b in batches:
            flat = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim) + 0.0  # -0.0 equals 0.0
            keys = [hashlib.md5(r.tobytes()).digest() for r in flat]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(keys, pa.binary()), b.column(1)], names=["id", "key", "v"])

    return written(rows.where(F.size("v") == dim).mapInArrow(keyed, "id long, key binary, v array<double>"), "vectors")


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(column):
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def grow_tree(entries: DataFrame, k: int) -> Tree:
    """A calibrated tree from at most SAMPLE_ROWS entries, those first by key."""
    first = entries.select(F.size("v").alias("d")).first()
    rows = max(LEAF, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * first["d"])))
    sample = entries.select("key", "v").orderBy("key").limit(rows)
    vectors = np.array([r["v"] for r in sample.select("v").toLocalIterator()], dtype=float)
    tree = Tree.grow(vectors)
    tree.calibrate(vectors, k)
    return tree


def _blocks(counts: dict[int, int], per: int):
    return {leaf: -(-n // per) for leaf, n in counts.items()}


def nearest(df: DataFrame, every: int = 100, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row whose id is divisible by
    ``every`` its k nearest other rows found, by Euclidean distance in double
    precision, nearest first, ties to the smaller id.

    All candidates are returned if there are fewer than k. Rows with the query's
    id are its own. See :func:`usable` for what takes no part; repeated rows are
    entries of their own only by id. Without usable rows the result is empty.
    """
    spark = df.sparkSession
    rows = usable(df, id_col, vec_col)
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if rows.isEmpty():
        return empty
    keep = k + 1
    order = Window.partitionBy("key").orderBy("id")
    few = rows.dropDuplicates(["id", "key"]).withColumn("n", F.row_number().over(order)).where(F.col("n") <= keep)  # limited before the shuffle too
    entries = written(few.groupBy("key").agg(F.array_sort(F.collect_set("id")).alias("ids"), F.first("v").alias("v")), "entries")
    tree = spark.sparkContext.broadcast(grow_tree(entries, k))  # bounded by the sample

    def file(batches):
        for b in batches:
            leaf = tree.value.leaves_of(_matrix(b.column(2)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(leaf)], names=["key", "ids", "v", "leaf"])

    filed = written(entries.select("key", "ids", "v").mapInArrow(file, "key binary, ids array<long>, v array<double>, leaf long"), "leaves")

    queries = written(rows.where(F.col("id") % every == 0).select("id", "key"), "queries")
    asked = entries.join(queries.select("key").distinct(), "key").select("key", "v")

    def visit(batches):
        for b in batches:
            keys, vs, leaves, bounds = [], [], [], []
            for key, v in zip(b.column(0).to_pylist(), _matrix(b.column(1))):
                seen, bound = tree.value.visited(v, keep)
                keys += [key] * len(seen)
                vs += [v] * len(seen)
                leaves += seen
                bounds += [bound] * len(seen)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(vs, pa.list_(pa.float64())), pa.array(leaves, pa.int64()), pa.array(bounds, pa.float64())], names=["key", "v", "leaf", "bound"])

    visits = written(asked.mapInArrow(visit, "key binary, v array<double>, leaf long, bound double"), "visits")
    count = lambda t: {r["leaf"]: r["count"] for r in t.groupBy("leaf").count().collect()}  # noqa: E731  a row a leaf of the tree
    row_blocks, query_blocks = _blocks(count(filed), BLOCK_ROWS), _blocks(count(visits), BLOCK_QUERIES)
    sizes = spark.createDataFrame([(leaf, n, query_blocks.get(leaf, 0)) for leaf, n in row_blocks.items()], "leaf long, rb int, qb int")
    salt = lambda n: F.pmod(F.xxhash64("key"), F.col(n)).cast("int")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = filed.join(F.broadcast(sizes.where("qb > 0")), "leaf").withColumn("r", salt("rb")).withColumn("q", spread("qb"))
    right = visits.join(F.broadcast(sizes.where("qb > 0")), "leaf").withColumn("q", salt("qb")).withColumn("r", spread("rb"))

    def meet(a: pa.Table, b: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if a.num_rows and b.num_rows:
            vectors, ids = _matrix(a.column("v")), a.column("ids").to_pylist()
            least = np.array([i[0] for i in ids])
            for key, v, bound in zip(b.column("key").to_pylist(), _matrix(b.column("v")), b.column("bound").to_pylist()):
                gap = vectors - v
                far = np.sqrt((gap * gap).sum(axis=1))
                near = np.flatnonzero(far <= bound)
                for j in near[np.lexsort((least[near], far[near]))[:keep]]:
                    out.append((key, float(far[j]), int(least[j]), ids[j]))
        cols = list(zip(*out)) or [[], [], [], []]
        return pa.table([pa.array(c, t) for c, t in zip(cols, (pa.binary(), pa.float64(), pa.int64(), pa.list_(pa.int64())))], names=["key", "score", "least", "ids"])

    keys = ["leaf", "r", "q"]
    met = left.select(*keys, "ids", "v").groupBy(*keys).cogroup(right.select(*keys, "key", "v", "bound").groupBy(*keys)).applyInArrow(meet, "key binary, score double, least long, ids array<long>")
    best = Window.partitionBy("key").orderBy("score", "least")
    top = met.withColumn("n", F.row_number().over(best)).where(F.col("n") <= keep)
    listed = F.array_sort(F.flatten(F.collect_list(F.transform("ids", lambda i: F.struct(F.col("score").alias("score"), i.alias("vec_id"))))))
    found = top.groupBy("key").agg(listed.alias("found"))
    others = F.slice(F.filter("found", lambda f: f["vec_id"] != F.col("id")), 1, k)
    return queries.distinct().join(found, "key").select(F.col("id").alias("query_id"), F.posexplode(others).alias("p", "f")).select(
        "query_id", (F.col("p") + 1).cast("int").alias("rank"), "f.vec_id", "f.score"
    )
