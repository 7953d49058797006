"""The corpus pipeline against a plain version, and each stage on awkward tables."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from corpusmill.llm import simhash
from corpusmill.llm.tokens import public_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _rows():
    rng = random.Random(8)
    words = "the of and to in that it was for on with as people read ordinary words about gardens and rivers while children walk home".split()
    rows = []
    for i in range(40):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(30, 90)))
        rows.append((2 * i, text + (" token=abcdef12 end" if i % 5 == 0 else ""), "en", "s", len(text)))
        if i % 4 == 0:
            rows.append((2 * i + 1, rows[-1][1], None, "copy", None))
        elif i % 4 == 1:
            rows.append((2 * i + 1, text + " more", "en", "near", None))
    return rows + [(900, None, "en", "s", None), (901, "", None, None, 0), (902, "12 34 !!", "en", "s", 8), (903, "short", None, None, 5), (903, "short", None, None, 5)]


def _plain(rows):
    """doc_id and final text of the documents that stay."""
    rows = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    sets = [set(simhash.shingles(r[1], 5)) for r in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] == sets[j] or len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) > 0:
                a, b = root[i], root[j]
                root = [min(a, b) if x in (a, b) else x for x in root]
    least = {}
    for r, x in zip(rows, root):
        if x not in least or r[0] < least[x][0]:
            least[x] = r
    return {r[0]: r[1].replace("token=abcdef12", "[secret]") for r in least.values()}


def test_pipeline_equals_a_plain_version(spark, tmp_path):
    rows = _rows()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    want, fresh = {}, Tokenizer.from_file(public_path("byte_bpe_50k.json"))
    for doc, text in _plain(rows).items():
        ids = np.append(fresh.encode(text, add_special_tokens=False).ids, 0).astype("<u4")
        want[doc] = (0, 0, len(ids), zlib.crc32(ids))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id: (r.piece, r.start, r.length, r.ids_crc32) for r in got} == want
    assert len(got) == len(want) < len(rows) - 10


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_empty_tables_and_nulls(spark, tmp_path, name, stage):
    rows = [(None, None, None, None, None), (1, "a word here", None, None, None), (1, "a word here", None, None, None), (2, "", "en", None, 3)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("__row", F.lit("clash"))
    out = stage(spark, docs, str(tmp_path))
    kept = {"language_id": 0, "near_dedup": 2, "secret_scan": 4, "packing": 4}[name]
    if name != "language_id":
        assert out.count() == kept
    if name != "packing":
        assert out.columns == corpus_pipeline.COLUMNS
    assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
