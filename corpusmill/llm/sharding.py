"""Sharding by extendible hashing, in DataFrame operations only.

The directory is indexed by leading bits of a row's hash. A bucket over the byte
limit splits on its next bit, and only such buckets do, until each fits (or is
one row, which nothing can split). Sizes come from sums over hash prefixes, so
a round looks at several bits at once and later rounds only at rows whose bucket
is still too large: those of hot keys. Once a key's own 60 bits are used up, the
bits of a hash of the row number follow, so one key with any number of rows is
spread over as many shards as its bytes need.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import beside, written

#: Bits that a key's hash gives, and as many that the row number's hash gives.
KEY_BITS = 60
#: Bits looked at in a round after the first.
ROUND_BITS = 20


def hash_bits(col: Column) -> Column:
    """The first 60 bits of the MD5 of the text, as a long."""
    return F.conv(F.substring(F.md5(F.coalesce(col.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def _chunks(first: int) -> list[tuple[str, int, int]]:
    """(hash column, bits before, bits) of each round."""
    out = [("key_hash", 0, first)]
    for col in ("key_hash", "row_hash"):
        at = first if col == "key_hash" else 0
        while at < KEY_BITS:
            bits = min(ROUND_BITS, KEY_BITS - at)
            out.append((col, at, bits))
            at += bits
    return out


def _leaves(cells: DataFrame, bits: int, limit: int) -> DataFrame:
    """For each cell that ends in this round its shard: ``bucket, cell, depth, prefix, bytes, rows``.

    ``cells`` has ``bucket`` (the label before this round), ``cell`` (the round's
    bits), ``bytes`` and ``rows``. Depth 0 of a round is what the round before
    found too large, except in the first.
    """
    depths = F.explode(F.sequence(F.lit(0), F.lit(bits))).alias("depth")
    paths = cells.select("bucket", "cell", "bytes", "rows", depths).withColumn(
        "prefix", F.expr(f"shiftright(cell, {bits} - depth)")
    )
    nodes = paths.groupBy("bucket", "depth", "prefix").agg(F.sum("bytes").alias("node_bytes"), F.sum("rows").alias("node_rows"))
    fits = nodes.where((F.col("node_bytes") <= limit) | (F.col("node_rows") == 1))
    found = paths.drop("bytes", "rows").join(fits, ["bucket", "depth", "prefix"])
    first = F.min(F.struct("depth", "prefix", "node_bytes", "node_rows")).alias("leaf")
    return found.groupBy("bucket", "cell").agg(first).select("bucket", "cell", "leaf.*")


def extendible_shards(df: DataFrame, key: str, size: Column, limit: int, row: str | None = None) -> DataFrame:
    """``key, shard, depth, bytes, shard_bytes, shard_rows`` of every row.

    ``shard`` is the bit string of its directory entry (empty for the only
    shard), ``depth`` its length. A shard holds at most ``limit`` bytes or a
    single row. Null sizes count as 0; rows with a null key hash alike and are
    spread by row number like any hot key. An empty table gives no rows. ``row``
    names a column of stored row numbers, which the result then has too.
    """
    own = [] if row is None else ["row"]
    rows = written(
        df.select(
            F.col(key).alias("key"),
            *[F.col(row).alias(c) for c in own],
            hash_bits(F.col(key)).alias("key_hash"),
            hash_bits(F.monotonically_increasing_id() if row is None else F.col(row)).alias("row_hash"),
            F.coalesce(size, F.lit(0)).cast("long").alias("bytes"),
        ),
        "sizes",
    )
    total = rows.agg(F.sum("bytes").alias("b")).first()["b"] or 0
    first = min(30, max(1, math.ceil(math.log2(max(1, total / limit))) + 4))
    done, rest = [], rows.withColumn("bucket", F.lit(""))
    for step, (col, before, bits) in enumerate(_chunks(first)):
        rest = rest.withColumn("cell", F.shiftright(F.col(col), KEY_BITS - before - bits).bitwiseAND((1 << bits) - 1))
        cells = written(rest.groupBy("bucket", "cell").agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("rows")), "cells")
        leaves = written(_leaves(cells, bits, limit), "leaves")
        label = F.concat("bucket", F.substring(F.lpad(F.bin("prefix"), 64, "0"), 65 - F.col("depth"), F.col("depth")))
        done.append(
            rest.join(beside(leaves), ["bucket", "cell"]).select(
                "key", *own, label.alias("shard"), "bytes", F.col("node_bytes").alias("shard_bytes"), F.col("node_rows").alias("shard_rows")
            )
        )
        open_cells = written(cells.join(beside(leaves.select("bucket", "cell")), ["bucket", "cell"], "left_anti").select("bucket", "cell"), "open_cells")
        if open_cells.isEmpty():
            break
        longer = F.concat("bucket", F.lpad(F.bin("cell"), bits, "0"))
        rest = written(rest.join(beside(open_cells), ["bucket", "cell"]).withColumn("bucket", longer).drop("cell"), "open")
    else:
        raise RuntimeError("rows of equal number: the hash of row numbers has collided")
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.select(
        F.col("key").alias(key), *[F.col(c).alias(row) for c in own], "shard", F.length("shard").alias("depth"), "bytes", "shard_bytes", "shard_rows"
    )


def write_shards(df: DataFrame, key: str, size: Column, limit: int, path: str) -> DataFrame:
    """Writes all rows, one folder ``shard=...`` a shard, and returns the assignment.

    Rows find their shard by a stored row number, so keys may repeat and a hot key's
    rows go to the several shards that hold it. ``df`` has no column ``shard``; a
    column ``__row`` is kept.
    """
    row = "__row"
    while row in df.columns:
        row += "_"
    rows = written(df.withColumn(row, F.monotonically_increasing_id()), "rows")
    assigned = written(extendible_shards(rows, key, size, limit, row), "assigned")
    # a name beside "shard": the empty shard would be read back as null
    named = rows.join(assigned.select(row, F.concat(F.lit("b"), "shard").alias("shard")), row).drop(row)
    named.repartition("shard").write.partitionBy("shard").parquet(path)
    return assigned


def oracle(limit: int) -> str:
    """DuckDB SQL of :func:`extendible_shards` on ``documents`` by ``doc_id``, where keys are unique."""
    return f"""
WITH d AS (
  SELECT doc_id, COALESCE(octet_length(encode(text)), 0)::BIGINT AS bytes,
         lpad(bin(('0x' || substr(md5(COALESCE(doc_id::VARCHAR, '')), 1, 15))::BIGINT), 60, '0') AS bits
  FROM documents),
p AS (SELECT doc_id, bytes, bits, depth FROM d, range(0, 61) AS r(depth)),
n AS (SELECT depth, substr(bits, 1, depth) AS shard, sum(bytes)::BIGINT AS shard_bytes, count(*) AS shard_rows
      FROM p GROUP BY ALL),
f AS (SELECT d.doc_id, d.bytes, n.depth, n.shard, n.shard_bytes, n.shard_rows,
             row_number() OVER (PARTITION BY d.doc_id ORDER BY n.depth) AS k
      FROM d JOIN n ON n.shard = substr(d.bits, 1, n.depth)
      WHERE n.shard_bytes <= {limit} OR n.shard_rows = 1)
SELECT doc_id, shard, depth::INTEGER AS depth, bytes, shard_bytes, shard_rows FROM f WHERE k = 1"""
