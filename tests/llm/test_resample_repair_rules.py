"""Importance resampling, repair of conversations and line rules against plain versions."""

import hashlib
import heapq
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.llm import conversations, line_rules, resampling
from corpusmill.llm.common import ship

DOCS = "doc_id long, text string, lang string, source string, n_chars long, weight string, n_words string, kept string, rank string"
AWKWARD = [None, "", " \n\t", "a", "The THE the, été ÉTÉ 日本 語", "x1 2y\x1c\x7f!", "w " * 30, "one two three four five six seven eight nine ten " * 4, "long" * 50_000, "tab\tsep\x0bvt\x0cff\r\nend"]


@pytest.fixture(scope="module")
def docs(spark):
    ship(spark)
    rng = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "été", "zwei", "1st", "x"]
    texts = AWKWARD + [" ".join(rng.choice(words) for _ in range(rng.randrange(5, 60))) + rng.choice([".", "!", "\n"]) for _ in range(150)]
    rows = [(i, t, None, "s", None, "old", "old", "old", "old") for i, t in enumerate(texts)]
    rows += [(3, "repeat of an id " * 10, *[None] * 7), (3, "repeat of an id " * 10, *[None] * 7), (None, "no id at all " * 9, *[None] * 7)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


# ---- resampling ----

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain_features(text, most):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return len(words), [" ".join(words[i : i + k]) for k in range(1, most + 1) for i in range(len(words) - k + 1)]


def plain_resample(rows, target, most=1, buckets=100, percent=10, least=20):
    of = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = Counter(of(f) for _, x in rows for f in plain_features(x, most)[1]), Counter(of(f) for x in target for f in plain_features(x, most)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in range(buckets)]
    out = []
    for i, x in rows:
        n, fs = plain_features(x, most)
        weight = sum(gain[of(f)] for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[: len(able) * percent // 100], 1):
        r[4] = k
    return sorted((tuple(r[:5]) for r in out), key=repr)


@pytest.mark.parametrize("most", [1, 3])
@pytest.mark.parametrize("percent", [10, 55, 100, 0])
def test_resample_equals_plain(spark, docs, most, percent, monkeypatch):
    monkeypatch.setattr(resampling, "PIECE", 40)  # many pieces a text
    monkeypatch.setattr(resampling, "NODES", 7)  # tries start anew all the time
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    target = [None, "alpha alpha beta", "zwei été"]
    got = resampling.resample(docs, spark.createDataFrame([(t,) for t in target], "text string"), percent=percent, buckets=100, most=most)
    assert sorted(map(tuple, got.collect()), key=repr) == plain_resample(rows, target, most, percent=percent)


def test_resample_of_nothing(spark, docs):
    empty = docs.limit(0)
    assert resampling.resample(empty, empty).count() == 0
    assert resampling.resample(docs, empty).where("rank is not null").count() > 0
    assert resampling.resample(empty, docs).columns == ["doc_id", "n_features", "weight", "score", "rank"]


def test_trie_shares_checksum_states():
    trie = resampling.Trie(1000, 2)
    trie.walk(b"ab cd ab cd")
    node = trie.root[0][b"ab"][0][b"cd"]
    assert node[1] == 2 and node[2] == zlib.crc32(b"ab cd")


# ---- conversations ----

SPACE = " \t\n\x0b\x0c\r"


def plain_damage(rows):
    out = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(c, t, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def plain_repair(rows):
    """One conversation, by least cost first over (rows used, grammar state), all edits one at a time."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
    seen, faults = set(), []
    for _, _, role, text in rows:
        core = text.rstrip(SPACE)
        faults.append("blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else "")
        seen.add((role, text))
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    heap = [(0, "", 0, "", ())]
    best = None
    while heap:
        cost, audit, i, state, made = heapq.heappop(heap)
        if best and cost > best[0]:
            break
        if i == len(rows) and state in ("", "a") and (best is None or (cost, audit) < best[:2]):
            best = (cost, audit, made)
        turn = "assistant" if state == "u" else "user"
        if not audit.endswith("II"):
            heapq.heappush(heap, (cost + 3, audit + "I", i, turn[0], made + (turn + ":",)))
        if i < len(rows):
            _, _, role, text = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, state, made))
            if faults[i] in ("", "truncated"):
                more = 3 if faults[i] else 0
                if (state, role[:1]) in step:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, role[:1], made + (f"{role}:{text}",)))
                heapq.heappush(heap, (cost + more + 3, audit + "R", i + 1, turn[0], made + (f"{turn}:{text}",)))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (gaps, *[faults.count(k) for k in ("blank", "duplicate", "truncated")], illegal, best[0], best[1], hashlib.sha256("\n".join(best[2]).encode()).hexdigest())


def talk(n, longest, rng):
    rows = []
    for c in range(n):
        for k in range(rng.randrange(1, longest)):
            turn = rng.choice([k, k, k, k + rng.randrange(3), None])
            rows.append((c if c else None, turn, rng.choice(["user", "assistant", "user", "assistant", "system", "", "tool", None]), rng.choice(["Hi.", "Yes!", "no", "", None, " \n", "Well? ", "ß.", "cut off"])))
    return rows


@pytest.mark.parametrize("batch", [1, 3, 5, 20_000])
def test_repair_equals_plain(spark, batch):
    ship(spark)
    rows = talk(40, 7, random.Random(batch))
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, audit string").repartition(3)
    got = {r[0]: tuple(r)[1:] for r in conversations.repair_conversations(df, batch).collect()}
    after = plain_damage(rows)
    want = {c: plain_repair([r for r in after if r[0] == c]) for c in {r[0] for r in rows}}
    assert got == want


def test_long_conversation_goes_in_parts(spark):
    """In parts as in one: 3,000 turns, many of them faulty."""
    rng = random.Random(9)
    rows = [(7, k, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice(["Hi.", "no", "", f"t{k}."])) for k in range(3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    whole, parts = (conversations.repair_conversations(df, n).collect() for n in (20_000, 64))
    assert whole == parts and len(whole) == 1 and len(whole[0].audit) > 2500


def test_repair_of_nothing(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversations.repair_conversations(empty).count() == 0
    gone = next(t for t in range(200) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    row = conversations.repair_conversations(spark.createDataFrame([(1, gone, "user", "Hi.")], empty.schema)).collect()
    assert [tuple(r) for r in row] == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


# ---- line rules ----


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0d]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    marked = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    failed = len(words) < 20 or 100 * len(marked) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(marked), failed


@pytest.mark.parametrize("unit", [64, 2 << 20])
def test_counts_equal_plain(spark, docs, unit, monkeypatch):
    monkeypatch.setattr(line_rules, "UNIT", unit)
    extra = [f"{'menu | home' if i % 2 else 'a b c d e f g h'}\n" * (i % 7) + "# * $ % & | < > words of a line\n" * (i % 3) for i in range(40)]
    rows = docs.unionByName(spark.createDataFrame([(1000 + i, t, *[None] * 7) for i, t in enumerate(extra)], DOCS))
    got = line_rules.judged(rows, None)
    assert set(got.columns) == {*DOCS.replace(" long", "").replace(" string", "").split(", "), *line_rules.ADDED}
    for r in got.collect():
        want = plain_counts(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want, r.text
        assert r.kept == (not want[-1])  # without a model every line is content


def plain_viterbi(scores, pairs, start):
    best = None
    for code in range(2 ** len(scores)):
        labels = [code >> i & 1 for i in range(len(scores))]
        s = start[labels[0]] + sum(x for x, k in zip(scores, labels) if k) + sum(pairs[a][b] for a, b in zip(labels, labels[1:]))
        best = max(best or (s, labels), (s, labels))
    return best[1]


def test_decoding_is_the_likeliest_of_all():
    rng = np.random.default_rng(3)
    for n in (1, 2, 5, 9):
        model = line_rules.Field(rng.normal(size=len(line_rules.FEATURES)), rng.normal(size=(2, 2)), rng.normal(size=2))
        rows = rng.normal(size=(n, len(line_rules.FEATURES)))
        assert model.decode(rows).tolist() == [bool(x) for x in plain_viterbi((rows @ model.weights).tolist(), model.pairs.tolist(), model.start.tolist())]


def test_gradient_is_that_of_the_likelihood():
    rng = np.random.default_rng(4)
    d = len(line_rules.FEATURES)
    rows, labels = rng.normal(size=(3, 5, d)), rng.integers(0, 2, size=(3, 5)).astype(float)
    mask = np.arange(5)[None, :] < np.array([[5], [2], [1]])
    rows, labels = rows * mask[:, :, None], labels * mask
    model = rng.normal(size=d + 6)
    score, gradient = line_rules._likelihood(model, rows, labels, mask)
    for k in range(d + 6):
        step = np.zeros(d + 6)
        step[k] = 1e-5
        up, down = (line_rules._likelihood(model + s * step, rows, labels, mask)[0] for s in (1, -1))
        assert abs((up - down) / 2e-5 - gradient[k]) < 1e-4


def test_held_out_documents(spark):
    """Trained on half of the labelled documents of sf0.01, right on the other half."""
    base = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{base}/labels.parquet").where("toxic = 0")
    docs = spark.read.parquet(f"{base}/documents.parquet")
    learnt = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    model = line_rules.fit(docs, labels.where(learnt))
    found = line_rules.judged(docs.select("doc_id", "text"), model).join(labels.where(~learnt), "doc_id").where("not base_failed").groupBy("quality").agg(F.count("*"), F.avg(F.col("kept").cast("double"))).collect()
    kept = {r[0]: r[2] for r in found}
    assert kept[1] >= 0.99 and kept[0] <= 0.25


def test_rules_without_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert line_rules.fit(docs, none) is None
    assert line_rules.judge_documents(docs.limit(0), none).count() == 0
    assert line_rules.judge_documents(docs, none).count() == docs.count()
