"""The registered queries of this subpackage: thin digests of the operators.

Every query reads its whole table and every whole text. ``QUERIES`` maps names
to functions of (spark, sf_dir); ``SQL`` has DuckDB SQL where SQL can say it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann_tree, conversations, fingerprints, langid, line_rules, packing, resampling, secret_scan, sentencepiece_fst, sharding, simhash, warc, wavelet
from .common import ship
from .tokens import public_path

#: Bytes of text a shard holds at most.
SHARD_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, public_path("byte_bpe_50k.json"), capacity=2048, end_id=0)


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_fst.encode_documents(table(spark, sf_dir, "documents"), public_path("piece_bpe_32k.model"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), width=3).withColumnRenamed("id", "doc_id")


def op4_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return wavelet.shard_digests(wavelet.write_shards(docs, public_path("word_bpe_49k.json"), end_id=1))


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict_documents(table(spark, sf_dir, "documents"))


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_tree.nearest(table(spark, sf_dir, "embeddings"), every=100, k=10)


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_documents(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write_bundles(table(spark, sf_dir, "pages"), min_bytes=0)
    return warc.read_bundles(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.extendible_shards(table(spark, sf_dir, "documents"), "doc_id", F.octet_length("text"), SHARD_BYTES)


def op11_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.judge_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_conversations(table(spark, sf_dir, "conversations"))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_packing": op1_packing,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_simhash": op3_simhash,
    "op4_wavelet": op4_wavelet,
    "op5_langid": op5_langid,
    "op6_ann": op6_ann,
    "op7_secrets": op7_secrets,
    "op8_warc": op8_warc,
    "op9_fingerprints": op9_fingerprints,
    "op10_sharding": op10_sharding,
    "op11_line_rules": op11_line_rules,
    "op12_conversations": op12_conversations,
    "op13_resampling": op13_resampling,
}

_FIVE = " + ".join(f"{16 >> k} * CAST(substr(bits, CAST(5 * i + {k + 1} AS BIGINT), 1) AS INTEGER)" for k in range(5))

SQL: dict[str, str] = {
    "op8_warc": f"""
WITH p AS (SELECT page_id, COALESCE(html, '') AS html FROM pages),
q AS (SELECT page_id, octet_length(encode(html)) AS n, sha1(html) AS x, min(page_id) OVER (PARTITION BY html) AS f FROM p),
b AS (SELECT *, array_to_string(list_transform(string_split(x, ''), lambda c: lpad(bin(strpos('0123456789abcdef', c) - 1), 4, '0')), '') AS bits FROM q)
SELECT page_id, n::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + {_FIVE}, 1)), '') AS payload_digest,
       CASE WHEN page_id = f THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> f THEN f END AS refers_to
FROM b""",
    "op10_sharding": sharding.oracle(SHARD_BYTES),
    "op12_conversations": conversations.oracle(),
    "op13_resampling": resampling.oracle(),
}
