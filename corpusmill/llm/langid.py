"""Language identification in two steps: family, then language within the family.

Texts become counts of hashed character n-grams (letters only, case folded,
words padded by a blank). A linear support vector machine per family, one
against the rest, names the family; inside it a linear machine for each pair of
languages votes. All are trained by averaged stochastic subgradient steps
(Pegasos) on a bounded sample of labelled rows; only weights travel to executors.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .common import text_or_empty

#: Hashed n-gram features.
DIM = 1 << 13
NGRAMS = (1, 2, 3)
#: Labelled rows to train on, over all languages; each has an equal share at most.
TRAIN_ROWS = 4000
EPOCHS = 12
LAMBDA = 1e-4
#: Code points hashed as one array; texts are handled whole, in such pieces.
PIECE = 1 << 20

#: Well-known families by language code; a language not listed is a family itself.
FAMILIES = {
    "germanic": ["af", "da", "de", "en", "fo", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"],
    "romance": ["ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro", "rm", "sc"],
    "slavic": ["be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"],
    "uralic": ["et", "fi", "hu", "se"],
    "celtic": ["br", "cy", "ga", "gd"],
    "baltic": ["lt", "lv"],
    "turkic": ["az", "kk", "ky", "tk", "tr", "tt", "uz"],
    "indic": ["bn", "gu", "hi", "mr", "ne", "pa", "si", "ur"],
}


def family_of(lang: str, families: dict[str, list[str]] = FAMILIES) -> str:
    code = lang.lower().split("-")[0]
    return next((f for f, codes in families.items() if code in codes), lang)


_LETTER: np.ndarray | None = None


def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
    return _LETTER


def features(text: str) -> tuple[np.ndarray, int]:
    """(unit vector of square-rooted n-gram counts, letters in the text).

    Long texts are hashed piece by piece; the last code points of a piece are carried
    over, so that counts are those of the whole text whatever :data:`PIECE` is.
    """
    counts = np.zeros(DIM)
    n_letters = 0
    lowered = text.lower()
    if not lowered:
        return counts, 0
    tail, ends_blank = np.zeros(0, dtype=np.uint32), False
    border = np.array([32], dtype=np.uint32)  # texts begin and end with a blank
    for at in range(0, len(lowered), PIECE):
        points = np.frombuffer(lowered[at : at + PIECE].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        letter = _letters()[points]
        n_letters += int(letter.sum())
        blank = ~letter
        keep = np.ones(len(points), dtype=bool)
        keep[1:] = ~(blank[1:] & blank[:-1])  # a gap between words is one blank
        keep[0] = not (blank[0] and ends_blank)
        ends_blank = bool(blank[-1])
        word = np.where(letter, points, 32).astype(np.uint32)[keep]
        new = np.concatenate([border[: at == 0], word, border[: at + PIECE >= len(lowered)]])
        joined = np.concatenate([tail, new])
        for n in NGRAMS:
            x = joined[max(0, len(tail) - n + 1) :]
            h = x[: max(0, len(x) - n + 1)]
            for k in range(1, n):
                h = h * np.uint32(0x01000193) + x[k : len(h) + k]
            mixed = (h ^ np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
            counts += np.bincount((mixed >> np.uint32(32 - 13)).astype(np.int64), minlength=DIM)
        tail = joined[-(max(NGRAMS) - 1) :]
    vector = np.sqrt(counts)
    norm = np.sqrt((vector * vector).sum())
    return (vector / norm if norm else vector), n_letters


def _svm(x: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, seed: int) -> np.ndarray:
    """Averaged Pegasos weights; x holds sparse (indices, values)."""
    rng = np.random.default_rng(seed)
    share = len(y) / (2 * np.array([max(1, (y < 0).sum()), max(1, (y > 0).sum())]))  # classes weigh alike
    w, scale, mean, t = np.zeros(DIM), 1.0, np.zeros(DIM), 1
    for epoch in range(EPOCHS):
        for i in rng.permutation(len(y)):
            t += 1
            step = 1 / (LAMBDA * (t + 1 / LAMBDA))
            idx, val = x[i]
            margin = y[i] * scale * (w[idx] * val).sum()
            scale *= 1 - step * LAMBDA
            if margin < 1:
                w[idx] += step * y[i] * share[int(y[i] > 0)] * val / scale
        mean += w * scale
    return mean / EPOCHS


@dataclass
class Model:
    """Weights by family, and by pair of languages in a family."""

    families: list[str]
    family_weights: np.ndarray
    members: dict[str, list[str]]
    pair_weights: dict[tuple[str, str], np.ndarray]

    def predict(self, text: str) -> tuple[str, float]:
        """(language, score 0..1); ``und`` with score 0 for a text without letters."""
        vector, letters = features(text)
        if not letters or not self.families:
            return "und", 0.0
        margins = (self.family_weights * vector[None, :]).sum(axis=1)
        best = int(margins.argmax())
        rest = np.delete(margins, best)
        score = _squash(margins[best] - rest.max()) if len(rest) else 1.0
        langs = self.members[self.families[best]]
        votes = dict.fromkeys(langs, 0)
        sums = dict.fromkeys(langs, 0.0)
        for a, b in combinations(langs, 2):
            m = float((self.pair_weights[a, b] * vector).sum())
            votes[a if m > 0 else b] += 1
            sums[a] += m
            sums[b] -= m
        lang = max(langs, key=lambda v: (votes[v], sums[v], v))
        if len(langs) > 1:
            own = [self.pair_weights[a, b] if a == lang else -self.pair_weights[a, b] for a, b in combinations(langs, 2) if lang in (a, b)]
            score *= _squash(min(float((w * vector).sum()) for w in own))
        return lang, float(score)


def _squash(margin: float) -> float:
    return 1 / (1 + float(np.exp(-4 * np.clip(margin, -50, 50))))


def train(samples: list[tuple[str, np.ndarray, np.ndarray]], families: dict[str, list[str]] = FAMILIES) -> Model:
    """From (language, feature indices, feature values)."""
    langs = sorted({s[0] for s in samples})
    members: dict[str, list[str]] = {}
    for lang in langs:
        members.setdefault(family_of(lang, families), []).append(lang)
    x = [(idx, val) for _, idx, val in samples]
    lang_of = np.array([s[0] for s in samples])
    in_family = np.array([family_of(v, families) for v in lang_of])
    names = sorted(members)
    weights = np.zeros((len(names), DIM))
    for i, name in enumerate(names if len(names) > 1 else []):
        weights[i] = _svm(x, np.where(in_family == name, 1, -1), 17)
    pairs = {}
    for name in names:
        for a, b in combinations(members[name], 2):
            rows = np.flatnonzero((lang_of == a) | (lang_of == b))
            pairs[a, b] = _svm([x[i] for i in rows], np.where(lang_of[rows] == a, 1, -1), 17)
    return Model(names, weights, members, pairs)


def labelled_sample(docs: DataFrame, may_learn, rows: int = TRAIN_ROWS) -> DataFrame:
    """(lang, text): at most ``rows`` in all and ``rows / languages`` of each,
    those first by hash of doc_id. The limit within a language is applied before
    its rows are brought together."""
    known = docs.where(may_learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}  # a row a language
    if not counts:
        return known.select("lang", "text")
    share = max(1, rows // len(counts))
    # about twice the share of each language by hash, so that ranking sees no more of a frequent one
    kept = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, int(min(1.0, 2 * share / n + 1e-3) * (1 << 30)))])
    ids = known.select("doc_id", "lang", F.xxhash64("doc_id", "lang").alias("h")).where(F.pmod("h", F.lit(1 << 30)) < kept[F.col("lang")])
    order = Window.partitionBy("lang").orderBy("h", "doc_id")
    chosen = ids.withColumn("k", F.row_number().over(order)).where(F.col("k") <= share).select("doc_id", "lang").distinct()
    return known.select("doc_id", "lang", "text").join(F.broadcast(chosen), ["doc_id", "lang"]).select("lang", "text").limit(rows)  # at most `rows` ids


def fit(docs: DataFrame, may_learn, families: dict[str, list[str]] = FAMILIES, rows: int = TRAIN_ROWS) -> Model:
    """Trains on the bounded sample in a task; the driver receives the weights only."""

    def sparse(batches):
        for b in batches:
            langs, idx, val = [], [], []
            for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
                v, letters = features(text.as_py())
                if letters:
                    at = np.flatnonzero(v)
                    langs.append(lang)
                    idx.append(at.astype("<u2").tobytes())
                    val.append(v[at].astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(idx, pa.binary()), pa.array(val, pa.binary())], names=["lang", "idx", "val"])

    def learn(batches):
        samples = []
        for b in batches:
            for lang, idx, val in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                samples.append((lang, np.frombuffer(idx, "<u2").astype(np.int64), np.frombuffer(val, "<f4").astype(float)))
        samples.sort(key=lambda s: (s[0], s[1].tobytes(), s[2].tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(train(samples, families))], pa.binary())], names=["model"])

    sample = labelled_sample(docs, may_learn, rows).mapInArrow(sparse, "lang string, idx binary, val binary")
    got = sample.repartition(1).mapInArrow(learn, "model binary").collect()  # one task trains on at most `rows`
    return pickle.loads(got[0]["model"]) if got else train([], families)


def predict(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All columns and ``lang_pred, score`` of each whole text.

    Null or empty text, or text without a letter, is ``und`` with score 0.
    Columns that have these names already are replaced. Without any training
    row every text is ``und``.
    """
    kept = df.drop("lang_pred", "score")
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(model)  # weights: languages squared x DIM, whatever the corpus

    def guess(batches):
        m = shared.value
        for b in batches:
            found = [m.predict(t.as_py() or "") for t in b.column(text_col)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], names=[*b.schema.names, "lang_pred", "score"])

    schema = StructType([*kept.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return kept.mapInArrow(guess, schema)


def held_out():
    """Rows that nothing is learned from: crc32 of the id as text leaves 1 by 3."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def predict_documents(docs: DataFrame, families: dict[str, list[str]] = FAMILIES) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row. A null id is not held out."""
    model = fit(docs, ~held_out(), families)
    rows = docs.select("doc_id", held_out().alias("held_out"), text_or_empty().alias("text"))
    return predict(rows, model).select("doc_id", "held_out", "lang_pred", "score")
