"""Importance resampling towards a target distribution of hashed word features.

Features of a text are its runs of 1 to ``most`` consecutive words, hashed to
buckets. A task counts them in a trie of its own: a node is one word after its
parent's, holds how often the run was seen and the CRC-32 of the run so far, so
that a longer run's checksum goes on from its parent's. What leaves a task are
sums by bucket. A bucket's gain compares its share in the target texts with that
in the raw ones; it is attached to the trie's nodes in the second reading, where a
document's weight is the mean of the gains met on its paths. Gumbel noise from the
document's id turns weights into a draw without replacement.

The only state beside the rows are bucket sums (``buckets`` of them) and a histogram
of integer scores, both of a size that does not follow the corpus.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Hash buckets of features, and the longest run of words that is a feature.
BUCKETS = 10_000
MOST = 1
#: Documents of fewer words are weighed but never drawn.
LEAST_WORDS = 20
#: Documents drawn, of 100 that are long enough.
PERCENT = 10
SEED = 2024
#: A trie starts anew at so many nodes, or bytes of their words.
NODES = 200_000
NODE_BYTES = 32 << 20
#: Texts are split into words in pieces of about so many bytes, cut between words.
PIECE = 4 << 20

#: Digits, a-z and all bytes beyond ASCII make words; A-Z count as a-z.
_FOLD = bytes(c if c >= 128 or chr(c).isdigit() or chr(c).islower() else c + 32 if chr(c).isupper() else 32 for c in range(256))


def pieces_of(text: bytes, size: int | None = None) -> Iterator[list[bytes]]:
    """The words of a UTF-8 text in order, in lists that bound what is held at once."""
    size = size or PIECE
    at = 0
    folded = text.translate(_FOLD)
    while at < len(folded):
        end = folded.find(b" ", at + size)
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end


class Trie:
    """Runs of words as paths; a node is ``[children, seen, crc, gain]``."""

    def __init__(self, buckets: int, most: int, gains: list[int] | None = None):
        self.buckets, self.most, self.gains = buckets, most, gains
        self.totals = [0] * buckets
        self._clear()

    def _clear(self) -> None:
        self.root: list = [{}, 0, 0, 0]
        self.nodes = self.bytes = 0

    def below(self, node: list, word: bytes) -> list:
        """The child of a node by a word, made where it is missing."""
        crc = zlib.crc32(word if node is self.root else b" " + word, node[2])
        child = node[0][word] = [{}, 0, crc, self.gains[crc % self.buckets] if self.gains else 0]
        self.nodes += 1
        self.bytes += len(word)
        return child

    def room(self) -> None:
        """Empties a trie that has grown to its bound, between texts' pieces."""
        if self.nodes >= NODES or self.bytes >= NODE_BYTES:
            self.settle()

    def settle(self) -> None:
        """Adds the counts at the nodes to their buckets and forgets the nodes."""
        stack = [self.root]
        while stack:
            node = stack.pop()
            if node[1]:
                self.totals[node[2] % self.buckets] += node[1]
            stack.extend(node[0].values())
        self._clear()

    def walk(self, text: bytes) -> tuple[int, int, int]:
        """(words, features, sum of gains) of a text, its runs counted at their nodes."""
        n_words = n_features = total = 0
        last: list[bytes] = []  # words before this piece that runs may begin with
        for words in pieces_of(text):
            n_words += len(words)
            joined, own = (last + words, len(last)) if last else (words, 0)
            n, root = len(joined), self.root
            tops = root[0]
            for i in range(n) if self.most > 1 else ():
                node = root
                for j in range(i, min(i + self.most, n)):
                    node = node[0].get(joined[j]) or self.below(node, joined[j])
                    if j >= own:  # a run that ends before this piece was counted there
                        node[1] += 1
                        total += node[3]
                        n_features += 1
            if self.most == 1:
                for w in words:
                    node = tops.get(w) or self.below(root, w)
                    node[1] += 1
                    total += node[3]
                n_features += len(words)
            last = joined[-(self.most - 1):] if self.most > 1 else []
            self.room()
        return n_words, n_features, total


def _bytes(column) -> Iterator[bytes]:
    for value in column.cast(pa.binary()):
        yield value.as_py() or b""


def bucket_sums(df: DataFrame, text_col: str = "text", buckets: int = BUCKETS, most: int = MOST) -> list[int]:
    """Features of all texts by bucket. Null text has none."""

    def count(batches):
        trie = Trie(buckets, most)
        for b in batches:
            for text in _bytes(b.column(0)):
                trie.walk(text)
        trie.settle()
        found = [i for i, n in enumerate(trie.totals) if n]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array([trie.totals[i] for i in found], pa.int64())], names=["bucket", "n"])

    parts = df.select(F.col(text_col).cast("string").alias("t")).mapInArrow(count, "bucket int, n long")
    sums = [0] * buckets
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most `buckets` rows
        sums[r["bucket"]] = r["n"]
    return sums


def bucket_gains(raw: list[int], target: list[int]) -> list[int]:
    """By bucket: thousandths of the logarithm of its smoothed share in the target over that in the raw texts."""
    all_raw, all_target, buckets = float(sum(raw)), float(sum(target)), len(raw)
    return [math.floor(1000 * math.log(((t + 1.0) * (all_raw + buckets)) / ((s + 1.0) * (all_target + buckets)))) for s, t in zip(raw, target)]


def weighed(df: DataFrame, gains: list[int], text_col: str = "text", most: int = MOST) -> DataFrame:
    """All columns and ``n_words, n_features, weight``: the floored mean gain of a text's features (0 without any).

    Columns that have these names already are replaced.
    """
    kept = df.drop("n_words", "n_features", "weight")
    shared = df.sparkSession.sparkContext.broadcast(gains)  # one number a bucket, whatever the corpus

    def weigh(batches):
        trie = Trie(len(shared.value), most, shared.value)
        for b in batches:
            found = [trie.walk(t) for t in _bytes(b.column(text_col).cast(pa.string()))]
            added = [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64()), pa.array([f[2] // f[1] if f[1] else 0 for f in found], pa.int64())]
            yield pa.RecordBatch.from_arrays([*b.columns, *added], names=[*b.schema.names, "n_words", "n_features", "weight"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInArrow(weigh, f"{fields}, n_words long, n_features long, weight long")


def noise(id_col: str = "doc_id", seed: int = SEED):
    """Standard Gumbel noise of an id in thousandths; a null id counts as empty text."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def drawn(scored: DataFrame, id_col: str = "doc_id", percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """Adds ``rank`` (1, 2, ... by score downwards, ties to the smaller id, null ids last) of the rows drawn; others have null.

    Scores are integers within a range given by logarithms, so a histogram of them is
    small: it gives the score where the draw ends and how many rows lie above each
    score. Rows are then numbered within their score only. ``scored`` must be a
    written table, as it is read twice.
    """
    enough = F.col("n_words") >= least_words
    counts = sorted(((r["score"], r["count"]) for r in scored.where(enough).groupBy("score").count().collect()), reverse=True)  # a row a score
    quota, above, seen = sum(c for _, c in counts) * percent // 100, [], 0
    for score, n in counts:
        if seen >= quota:
            break
        above.append((score, seen))
        seen += n
    spark = scored.sparkSession
    if not above:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    starts = F.broadcast(spark.createDataFrame(above, "score long, __above long"))
    within = Window.partitionBy("score").orderBy(F.col(id_col).asc_nulls_last())
    reach = enough & (F.col("score") >= above[-1][0])
    place = F.col("__above") + F.row_number().over(within)
    top = scored.where(reach).join(starts, "score").withColumn("rank", F.when(place <= quota, place)).select(*scored.columns, "rank")
    return top.unionByName(scored.where(~reach).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS, most: int = MOST, seed: int = SEED) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every document; rank is null where it isn't drawn.

    Null and empty texts have no features and weight 0. Repeated rows are rows of
    their own and have places of their own. An empty target or an empty table of
    documents is smoothed like any other. Extra columns are not read.
    """
    gains = bucket_gains(bucket_sums(docs, "text", buckets, most), bucket_sums(target, "text", buckets, most))
    rows = weighed(docs.select("doc_id", F.col("text").cast("string").alias("text")), gains, "text", most).drop("text")
    scored = written(rows.withColumn("score", F.col("weight") + noise("doc_id", seed)), "scored")
    return drawn(scored, "doc_id", percent, least_words).select("doc_id", "n_features", "weight", "score", "rank")


def oracle(percent: int = PERCENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS, seed: int = SEED) -> str:
    """DuckDB SQL of :func:`resample` for single words: checksums bit by bit over distinct words."""
    # one bit a round: eight rounds of the reflected polynomial for each byte
    bit = "xor(acc >> 1, CASE WHEN (acc & 1) = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END)"
    byte = "list_reduce(range(0, 8), lambda acc, k: " + bit + ", xor(r, ('0x' || substr(x, 2 * i - 1, 2))::BIGINT))"
    crc = f"xor(4294967295::BIGINT, list_reduce(range(1, length(x) // 2 + 1), lambda r, i: {byte}, 4294967295::BIGINT))"
    words = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+')"
    return f"""WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce({words}, []) AS w FROM documents),
u AS (SELECT row, unnest(w) AS word FROM d), g AS (SELECT unnest({words}) AS word FROM benchmark),
k AS (SELECT word, ({crc}) % {buckets} AS bucket FROM (SELECT word, hex(encode(word)) AS x FROM (SELECT word FROM u UNION SELECT word FROM g))),
s AS (SELECT bucket, count(*)::DOUBLE AS n FROM u JOIN k USING (word) GROUP BY 1), t AS (SELECT bucket, count(*)::DOUBLE AS n FROM g JOIN k USING (word) GROUP BY 1),
z AS (SELECT k.word, floor(1000 * ln(((coalesce(t.n, 0) + 1) * ((SELECT count(*)::DOUBLE FROM u) + {buckets})) / ((coalesce(s.n, 0) + 1) * ((SELECT count(*)::DOUBLE FROM g) + {buckets}))))::BIGINT AS gain
 FROM k LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)),
m AS (SELECT row, floor(sum(gain) / count(*)::DOUBLE)::BIGINT AS weight FROM u JOIN z USING (word) GROUP BY row),
p AS (SELECT doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
 + floor(-1000 * ln(-ln((('0x' || substr(sha256('{seed}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM d LEFT JOIN m USING (row)),
r AS (SELECT *, row_number() OVER (PARTITION BY n_features >= {least_words} ORDER BY score DESC, doc_id NULLS LAST) AS place, count(*) FILTER (n_features >= {least_words}) OVER () * {percent} // 100 AS quota FROM p)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= {least_words} AND place <= quota THEN place END AS rank FROM r"""
