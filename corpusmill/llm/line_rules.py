"""Quality rules over lines: a linear-chain conditional random field tells content from boilerplate.

Each line with a word is an observation: shares of symbols, bars, capitals, digits
and repeated words, its length and ending, whether it repeats an earlier line. Two
labels with transition weights form the chain; Viterbi decoding labels all lines of
a text together, and a text is kept where most of its words stand in content lines.

The field is trained here, by gradient steps on the likelihood of a bounded sample of
labelled documents: lines of good documents count as content, lines of bad ones as
boilerplate unless a good one has the same line. Only its weights, some dozen
numbers, travel to executors. Counts that need no model (symbols, repeated lines,
repeated windows of words) come from the same pass over a text's bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

#: Labelled documents to train on, half of each quality, and how much of each is read.
TRAIN_DOCS = 2000
TRAIN_CHARS = 8000
#: Lines of one training sequence; longer texts give several.
TRAIN_LINES = 24
STEPS = 150
RATE = 0.2
L2 = 1e-3
#: Share of words in content lines from which a text is kept.
CONTENT_SHARE = 0.5
#: Words below which a text fails, and percentage of repeated words above which it does.
LEAST_WORDS = 20
MOST_REPEATED = 30
#: Consecutive words that count as repeated where they come twice.
WINDOW = 8
#: Bytes of texts that are measured together; a longer text is measured alone.
UNIT = 2 << 20

SYMBOLS = b"#*$%&|<>"
_BLANK = b" \t\n\v\f\r"


def _class(chars: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=np.uint8)
    table[list(chars)] = 1
    return table


_IS = {
    "blank": _class(_BLANK), "symbol": _class(SYMBOLS), "bar": _class(b"|"), "shout": _class(b"!"), "upper": _class(bytes(range(65, 91))), "lower": _class(bytes(range(97, 123))),
    "digit": _class(b"0123456789"), "comma": _class(b",;:"), "mark": _class(b"{}[]()=+_/\\@~^`\"'"), "char": 1 - _class(bytes(range(0x80, 0xC0))),
}
FEATURES = ["bias", "symbols", "bars", "shouts", "upper", "digits", "commas", "marks", "repeated", "stutter", "again", "ended", "short", "long", "wide_words"]


def repeated_words(ids: np.ndarray, owner: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Whether each word lies in a window of words that its text has twice or more.

    Windows are named exactly: pairs of words, then pairs of pairs, then pairs of those
    are numbered by sorting; ``window`` is a power of two.
    """
    marked = np.zeros(len(ids), dtype=bool)
    if len(ids) < window:
        return marked
    name, size = ids.astype(np.int64), 1
    while size < window:
        pair = name[:-size] * (int(name.max()) + 1) + name[size:]
        name = np.unique(pair, return_inverse=True)[1]
        size *= 2
    whole = np.flatnonzero(owner[: len(name)] == owner[window - 1 :])
    if not len(whole):
        return marked
    key = name[whole] * (int(owner.max()) + 1) + owner[whole]
    _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
    begin = whole[counts[inverse] > 1]
    edges = np.zeros(len(ids) + 1, dtype=np.int64)
    np.add.at(edges, begin, 1)
    np.add.at(edges, begin + window, -1)
    return np.cumsum(edges[:-1]) > 0


@dataclass
class Measures:
    """What a pass over some texts gives: counts a text, and a row of features a line with a word."""

    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray
    #: First line of each text in the rows below; one more entry for the end.
    first: np.ndarray
    line_words: np.ndarray
    rows: np.ndarray = field(repr=False)


def measure(texts: list[bytes]) -> Measures:
    """Counts and line features of UTF-8 texts, all of them together."""
    n = len(texts)
    flat = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    starts = ends - [len(t) + 1 for t in texts]
    breaks = np.flatnonzero(flat == 10)
    heads = np.concatenate([[0], breaks[:-1] + 1])  # of every line, blank ones too
    blank = _IS["blank"][flat].astype(bool)
    before = np.ones(len(flat), dtype=bool)
    before[1:] = blank[:-1]
    word_at = np.flatnonzero(~blank & before)
    words_of_line = np.diff(np.searchsorted(word_at, np.append(heads, len(flat))))
    owner = np.searchsorted(ends, word_at, side="right")

    known: dict[bytes, int] = {}
    ids = np.empty(len(word_at), dtype=np.int64)
    at = 0
    for t in texts:
        for lo in range(0, len(t), UNIT):  # long texts: words of one piece at a time, cut between words
            lo, hi = _cut(t, lo), _cut(t, lo + UNIT)
            for w in t[lo:hi].split():
                ids[at] = known.setdefault(w, len(known))
                at += 1
    repeat = repeated_words(ids, owner)
    stutter = np.zeros(len(ids))
    stutter[1:] = (ids[1:] == ids[:-1]) & (owner[1:] == owner[:-1])
    del known, ids

    per_line = {k: np.add.reduceat(v[flat], heads, dtype=np.int64) for k, v in _IS.items()}
    filled = words_of_line > 0
    text_of_line = np.searchsorted(ends, heads, side="right")[filled]
    again = np.zeros(int(filled.sum()), dtype=bool)
    at = 0
    for t in texts:
        seen: set[bytes] = set()
        for line in t.split(b"\n"):
            if line.strip(_BLANK):
                again[at] = line in seen
                seen.add(line)
                at += 1
    by_text = lambda values, of: np.bincount(of, weights=values, minlength=n).astype(np.int64)
    line_of_word = np.searchsorted(heads, word_at, side="right") - 1
    repeated_in_line, stutter_in_line = (np.bincount(line_of_word, weights=x, minlength=len(heads)) for x in (repeat, stutter))

    words = words_of_line[filled].astype(float)
    c = {k: v[filled].astype(float) for k, v in per_line.items()}
    chars = c["char"] - c["blank"]
    letters = c["upper"] + c["lower"]
    last = breaks[filled] - 1
    for _ in range(8):  # the last byte that is no blank, as far as eight blanks back
        last = np.where(blank[np.maximum(last, 0)], last - 1, last)
    ended = np.isin(flat[np.maximum(last, 0)], list(b".!?\"'"))
    few = lambda x: np.minimum(x / words, 1.0)
    rows = np.stack([
        np.ones(len(words)), few(c["symbol"]), few(c["bar"]), few(c["shout"]), np.where(letters > 0, c["upper"] / np.maximum(letters, 1), 0.0), c["digit"] / chars, few(c["comma"]), few(c["mark"]),
        repeated_in_line[filled] / words, stutter_in_line[filled] / words, again.astype(float), ended.astype(float), (words < 4).astype(float), np.minimum(np.log1p(words) / 6, 1.0), np.minimum(chars / words / 20, 1.0),
    ], axis=1)
    size = np.array([len(t) for t in texts])
    whole = {k: np.add.reduceat(_IS[k][flat], starts, dtype=np.int64) for k in ("char", "blank", "symbol")}
    return Measures(
        n_words=np.bincount(owner, minlength=n).astype(np.int64), word_chars=np.where(size > 0, whole["char"] - whole["blank"], 0), n_symbols=whole["symbol"],
        n_dup_lines=by_text(again, text_of_line), n_repeat_words=by_text(repeat, owner), first=np.searchsorted(text_of_line, np.arange(n + 1)), line_words=words.astype(np.int64), rows=rows,
    )


def _cut(text: bytes, at: int) -> int:
    """The next place from ``at`` on where no word is cut."""
    if at <= 0 or at >= len(text):
        return max(0, min(at, len(text)))
    while at < len(text) and text[at] not in _BLANK:
        at += 1
    return at


@dataclass
class Field:
    """Weights: of features for content over boilerplate, of label pairs (0 boilerplate, 1 content), of the first label."""

    weights: np.ndarray
    pairs: np.ndarray
    start: np.ndarray

    def decode(self, rows: np.ndarray) -> np.ndarray:
        """The likeliest labels of one text's lines together (Viterbi); ties go to content."""
        scores = (rows @ self.weights).tolist()
        (bb, bc), (cb, cc) = self.pairs.tolist()
        if not scores:
            return np.zeros(0, dtype=bool)
        b, c = float(self.start[0]), float(self.start[1]) + scores[0]
        back = []
        for s in scores[1:]:
            from_b, to_b = c + cb < b + bb, max(b + bb, c + cb)
            from_c, to_c = c + cc < b + bc, max(b + bc, c + cc)
            back.append((from_b, from_c))
            b, c = to_b, to_c + s
        labels = np.empty(len(scores), dtype=bool)
        label = c >= b
        labels[-1] = label
        for i in range(len(back) - 1, -1, -1):
            label = not back[i][label]
            labels[i] = label
        return labels


def _likelihood(model: np.ndarray, rows: np.ndarray, labels: np.ndarray, mask: np.ndarray) -> tuple[float, np.ndarray]:
    """Mean log-likelihood of padded sequences (sequence, line, feature) and its gradient, by forward and backward sums."""
    n, m, d = rows.shape
    weights, pairs, start = model[:d], model[d : d + 4].reshape(2, 2), model[d + 4 :]
    emit = np.zeros((n, m, 2))
    emit[:, :, 1] = rows @ weights
    ahead = np.empty((n, m, 2))
    ahead[:, 0] = start + emit[:, 0]
    for t in range(1, m):
        step = np.logaddexp(ahead[:, t - 1, :1] + pairs[0], ahead[:, t - 1, 1:] + pairs[1]) + emit[:, t]
        ahead[:, t] = np.where(mask[:, t, None], step, ahead[:, t - 1])
    total = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
    behind = np.zeros((n, m, 2))
    for t in range(m - 2, -1, -1):
        nxt = behind[:, t + 1] + emit[:, t + 1]
        step = np.logaddexp(nxt[:, :1] + pairs[:, 0], nxt[:, 1:] + pairs[:, 1])
        behind[:, t] = np.where(mask[:, t + 1, None], step, behind[:, t])
    single = np.exp(ahead + behind - total[:, None, None]) * mask[:, :, None]
    truth = np.stack([1 - labels, labels], axis=2) * mask[:, :, None]
    both = mask[:, 1:] & mask[:, :-1]
    joint = np.exp(ahead[:, :-1, :, None] + pairs + (emit + behind)[:, 1:, None, :] - total[:, None, None, None]) * both[:, :, None, None]
    seen = truth[:, :-1, :, None] * truth[:, 1:, None, :] * both[:, :, None, None]
    gradient = np.concatenate([np.einsum("nm,nmd->d", truth[:, :, 1] - single[:, :, 1], rows), (seen - joint).sum((0, 1)).ravel(), (truth[:, 0] - single[:, 0]).sum(0)])
    score = (emit * truth).sum() + (seen.sum((0, 1)) * pairs).sum() + (truth[:, 0] * start).sum() - total.sum()
    return score / n, gradient / n


def train(sequences: list[tuple[np.ndarray, np.ndarray]]) -> Field | None:
    """A field from (line features, labels of the lines); none where there is one label only."""
    if len({label for _, labels in sequences for label in labels.tolist()}) < 2:
        return None
    cut = [(rows[i : i + TRAIN_LINES], labels[i : i + TRAIN_LINES]) for rows, labels in sequences for i in range(0, len(rows), TRAIN_LINES)]
    n, m, d = len(cut), max(len(r) for r, _ in cut), len(FEATURES)
    rows, mask, labels = np.zeros((n, m, d)), np.zeros((n, m), dtype=bool), np.zeros((n, m))
    for i, (r, label) in enumerate(cut):
        rows[i, : len(r)], mask[i, : len(r)], labels[i, : len(r)] = r, True, label
    model, slope, square = np.zeros(d + 6), np.zeros(d + 6), np.zeros(d + 6)
    for t in range(1, STEPS + 1):  # Adam
        _, gradient = _likelihood(model, rows, labels, mask)
        gradient -= L2 * model
        slope, square = 0.9 * slope + 0.1 * gradient, 0.99 * square + 0.01 * gradient**2
        model += RATE / (1 + t / 100) * (slope / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.99**t)) + 1e-8)
    return Field(model[:d], model[d : d + 4].reshape(2, 2), model[d + 4 :])


def fit(docs: DataFrame, labels: DataFrame, docs_used: int = TRAIN_DOCS) -> Field | None:
    """Trains on the labelled documents that come first by hash, half of each quality.

    ``labels`` has ``doc_id, quality`` (1 good, 0 bad; others are not used).
    """
    half = docs_used // 2
    known = labels.where("quality in (0, 1) and doc_id is not null").select("doc_id", "quality")
    ids = None
    for quality in (0, 1):
        one = known.where(F.col("quality") == quality).orderBy(F.xxhash64("doc_id"), "doc_id").limit(half)
        ids = one if ids is None else ids.unionByName(one)
    texts = docs.where("text is not null").select("doc_id", F.substring(F.col("text").cast("string"), 1, TRAIN_CHARS).alias("text"))
    rows = texts.join(F.broadcast(ids.distinct()), "doc_id").orderBy(F.xxhash64("doc_id", "text"), "doc_id").limit(docs_used).select("text", "quality").collect()  # at most docs_used ids and rows
    return train(labelled_lines([(r["text"], r["quality"]) for r in rows]))


def labelled_lines(texts: list[tuple[str, int]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Training sequences of (text, quality): a bad text's line is content where a good text has it too."""
    good, out = {line for text, quality in texts if quality == 1 for line in text.split("\n")}, []
    for text, quality in sorted(texts, key=lambda x: (x[1], x[0])):
        lines = [line for line in text.split("\n") if line.strip(_BLANK.decode())]
        if lines:
            out.append((measure([text.encode("utf-8")]).rows, np.array([quality or int(line in good) for line in lines])))
    return out


def _units(column: pa.Array) -> Iterator[list[bytes]]:
    """Texts of a column in order, grouped to about :data:`UNIT` bytes."""
    held: list[bytes] = []
    size = 0
    for value in column.cast(pa.binary()):
        text = value.as_py() or b""
        if held and size + len(text) > UNIT:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text) + 1
    if held:
        yield held


ADDED = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "content_share", "kept"]


def judged(df: DataFrame, model: Field | None, text_col: str = "text", content_share: float = CONTENT_SHARE) -> DataFrame:
    """All columns and :data:`ADDED` of each whole text.

    A null text has no words: all counts 0, ``base_failed`` true, ``content_share`` 0,
    ``kept`` false. Columns that have these names already are replaced. Without a
    model every line is content.
    """
    kept_columns = df.drop(*ADDED)
    shared = df.sparkSession.sparkContext.broadcast(model)  # some dozen numbers

    def judge(batches):
        field_ = shared.value
        for b in batches:
            parts: list[list] = [[] for _ in ADDED]
            for texts in _units(b.column(text_col).cast(pa.string())):
                m = measure(texts)
                failed = (m.n_words < LEAST_WORDS) | (100 * m.n_repeat_words > MOST_REPEATED * m.n_words)
                share = np.zeros(len(texts))
                for k in range(len(texts)):
                    lines = slice(m.first[k], m.first[k + 1])
                    words = m.line_words[lines]
                    if len(words):
                        share[k] = (words[field_.decode(m.rows[lines])].sum() if field_ else words.sum()) / words.sum()
                for part, values in zip(parts, [m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words, failed, share, ~failed & (share >= content_share)]):
                    part.append(values)
            kinds = [np.int64] * 5 + [bool, np.float64, bool]
            yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array(np.concatenate(p).astype(t) if p else np.zeros(0, dtype=t)) for p, t in zip(parts, kinds)]], names=[*b.schema.names, *ADDED])

    types = [LongType()] * 5 + [BooleanType(), DoubleType(), BooleanType()]
    return kept_columns.mapInArrow(judge, StructType([*kept_columns.schema.fields, *[StructField(n, t) for n, t in zip(ADDED, types)]]))


def judge_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, content_share`` of every row."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return judged(rows, fit(docs, labels)).select("doc_id", *[c for c in ADDED if c != "content_share"], "content_share")
