"""Phrase search against looking for each phrase in each text."""

import random

import numpy as np
import pytest

from corpusmill.operators import phrases

ALPHABET = "aabé日😀 "


def plain(texts, wanted):
    return sorted((d, p, i) for d, t in texts for p, w in wanted if w and t for i in range(len(t) - len(w) + 1) if t[i : i + len(w)] == w)


def drawn(rng, n, longest):
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(longest))) for _ in range(n)]


@pytest.mark.parametrize("lane, limit, batch", [(3, 12, 40), (1024, 128 << 10, 4 << 20), (16, 40, 200)])
def test_all_occurrences(spark, monkeypatch, lane, limit, batch):
    """Overlapping and nested phrases, phrases longer than a lane, several automata, equal phrases of several ids."""
    monkeypatch.setattr(phrases, "LANE", lane)
    monkeypatch.setattr(phrases, "BATCH_BYTES", batch)
    rng = random.Random(lane)
    texts = list(enumerate(drawn(rng, 60, 50))) + [(60, None), (61, ""), (62, "ab" * 500)]
    words = [*drawn(rng, 40, 5), "a", "aa", "aaa", "aa", "ab" * 30, "", None, "日", "é日"]
    wanted = list(enumerate(words))
    docs = spark.createDataFrame([(d, t, "x") for d, t in texts], "doc_id long, text string, start string").repartition(3)
    got = phrases.find(docs, spark.createDataFrame(wanted, "item_id int, text string"), "doc_id", "item_id", limit=limit)
    assert got.columns == ["doc_id", "item_id", "start"]
    rows = sorted(map(tuple, got.collect()))
    assert rows == plain(texts, wanted) and len(rows) > 1000
    held = {(d, p) for d, p, _ in rows}
    assert {tuple(r) for r in phrases.holding(docs, spark.createDataFrame(wanted, "item_id int, text string"), "doc_id", "item_id").collect()} == held


def test_nothing_to_find(spark):
    docs = spark.createDataFrame([(1, "abc")], "doc_id long, text string")
    none = spark.createDataFrame([(1, None), (2, "")], "item_id long, text string")
    assert phrases.find(docs, none, "doc_id", "item_id").count() == 0
    assert phrases.find(docs.limit(0), docs.withColumnRenamed("doc_id", "item_id"), "doc_id", "item_id").count() == 0


def test_plan_joins_nothing(spark):
    """Texts are not joined with phrases, whatever their number."""
    docs = spark.createDataFrame([(1, "abc")], "doc_id long, text string")
    items = spark.createDataFrame([(i, f"w{i}") for i in range(3000)], "item_id long, text string")
    plan = phrases.find(docs, items, "doc_id", "item_id")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("MapInArrow") == 1


def test_states_follow_bytes_not_texts():
    """One transition a byte: the automaton is complete, so its steps don't depend on its phrases."""
    few, many = phrases.build((b"ab",)), phrases.build(tuple(f"{i:05d}".encode() for i in range(3000)))
    assert few.goto.shape[0] == 3 and many.goto.shape[0] < 15_001 and many.goto.shape[1] == 11
    flat = np.frombuffer(b"00012000110001", dtype=np.uint8)
    first, which = phrases.scan(many, flat)
    assert list(zip(first.tolist(), which.tolist())) == [(i, int(b"00012000110001"[i : i + 5])) for i in range(10) if int(b"00012000110001"[i : i + 5]) < 3000]


def test_gaps_in_order(spark):
    told = spark.createDataFrame([("g", 0, "b"), ("g", 1, "a"), ("g", 2, "c"), ("h", 0, "a")], "g string, ord int, p string")
    hits = spark.createDataFrame([(1, "a"), (2, "a")], "doc_id long, p string")
    assert sorted(map(tuple, phrases.gaps(told, hits, "g", "p").collect())) == [("g", 3, 1, 2, "b、c"), ("h", 1, 1, 2, "无")]
