"""Phrases in texts: every occurrence of every phrase, found in one pass over a text.

An Aho-Corasick automaton over UTF-8 bytes holds many phrases at once: ``goto`` is
its complete transition table (failures resolved), ``suffix`` links a state to the next shorter
state that ends a phrase. Phrases are dealt to automata by bytes, so that one
automaton has a bounded size; whole texts stream through each. A batch of texts
is one array of bytes, cut into lanes that advance together, each from as many
bytes before its own as the longest phrase can reach back.

The work on a text does not depend on how many phrases an automaton holds, and no
text is joined with phrases; an automaton more is one more pass.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import IntegerType, StructField, StructType

from ..work import ship

#: Bytes of phrases in one automaton: at most as many states, each a row of a transition table.
AUTOMATON_BYTES = 128 << 10
#: Bytes of texts that are scanned together.
BATCH_BYTES = 4 << 20
#: Bytes of a lane, if no phrase is longer.
LANE = 1024
#: Stands between texts; no UTF-8 text has it.
GAP = 0xFF


@dataclass
class Automaton:
    classes: np.ndarray  # of each byte; 0 for bytes in no phrase
    goto: np.ndarray  # next state by state and class
    ends: np.ndarray  # the phrase that a state ends, or -1
    suffix: np.ndarray  # next shorter state that ends a phrase, 0 if none
    sizes: np.ndarray  # bytes of each phrase

    def __post_init__(self):
        self.tells = (self.ends >= 0) | (self.suffix > 0)


def build(phrases: tuple[bytes, ...]) -> Automaton:
    """The automaton of distinct phrases, none of them empty."""
    used = sorted({b for p in phrases for b in p})
    classes = np.zeros(256, dtype=np.uint8)
    classes[used] = np.arange(1, len(used) + 1)
    below: list[dict[int, int]] = [{}]
    ends = [-1]
    for k, phrase in enumerate(phrases):
        state = 0
        for byte in phrase:
            to = below[state].get(byte)
            if to is None:
                to = below[state][byte] = len(below)
                below.append({})
                ends.append(-1)
            state = to
        ends[state] = k
    goto = np.zeros((len(below), len(used) + 1), dtype=np.int32)
    failure, suffix = [0] * len(below), [0] * len(below)
    for byte, to in below[0].items():
        goto[0, classes[byte]] = to
    level = list(below[0].values())
    while level:  # by depth: what a state fails to is finished
        following = []
        for state in level:
            back = failure[state]
            suffix[state] = back if ends[back] >= 0 else suffix[back]
            goto[state] = goto[back]
            for byte, to in below[state].items():
                failure[to] = int(goto[back, classes[byte]])
                goto[state, classes[byte]] = to
                following.append(to)
        level = following
    return Automaton(classes, goto, np.array(ends), np.array(suffix), np.array([len(p) for p in phrases]))


@lru_cache(maxsize=2)
def _built(phrases: tuple[bytes, ...]) -> Automaton:
    """:func:`build`, once for the tasks that a Python worker runs."""
    return build(phrases)


def scan(automaton: Automaton, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first bytes, phrases) of all occurrences in an array of bytes, by first byte."""
    reach = int(automaton.sizes.max()) - 1
    lane = max(LANE, reach)
    lanes = -(-len(flat) // lane)
    codes = np.zeros(lanes * lane, dtype=np.int32)
    codes[: len(flat)] = automaton.classes[flat]
    steps = np.ascontiguousarray(codes.reshape(lanes, lane).T)
    table, width = automaton.goto.ravel(), automaton.goto.shape[1]
    state = np.zeros(lanes, dtype=np.int32)
    for j in range(lane - reach, lane):  # the end of the lane before; the first has none
        state[1:] = table[state[1:] * width + steps[j, :-1]]
    at, found = [], []
    for j in range(lane):
        state = table[state * width + steps[j]]
        hit = np.flatnonzero(automaton.tells[state])
        if len(hit):
            at.append(hit * lane + j)
            found.append(state[hit])
    if not at:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    last, states = np.concatenate(at), np.concatenate(found)
    firsts, phrases = [], []
    while len(states):  # a state may end several phrases, each a suffix of the one before
        ended = automaton.ends[states] >= 0
        phrase = automaton.ends[states[ended]]
        firsts.append(last[ended] - automaton.sizes[phrase] + 1)
        phrases.append(phrase)
        states = automaton.suffix[states]
        last, states = last[states > 0], states[states > 0]
    first, phrase = np.concatenate(firsts), np.concatenate(phrases)
    order = np.lexsort((phrase, first))
    return first[order], phrase[order]


def _batches(column: pa.Array):
    """(first row, texts as bytes): rows in order, about :data:`BATCH_BYTES` at a time; a longer text is alone."""
    begin, held, size = 0, [], 0
    for k, value in enumerate(column.cast(pa.binary())):
        text = value.as_py() or b""
        if held and size + len(text) > BATCH_BYTES:
            yield begin, held
            begin, held, size = k, [], 0
        held.append(text)
        size += len(text) + 1
    if held:
        yield begin, held


def occurrences(automaton: Automaton, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, phrase, start in code points) of all occurrences in some texts."""
    flat = np.frombuffer(bytes([GAP]).join(texts) + bytes([GAP]), dtype=np.uint8)
    first, phrase = scan(automaton, flat)
    starts = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
    of = np.searchsorted(starts, first, side="right") - 1
    if not len(first):
        return of, phrase, first
    points = np.concatenate([[0], np.cumsum((flat & 0xC0) != 0x80)])  # code points that begin before a byte
    return of, phrase, points[first] - points[starts[of]]


def shards(phrases: DataFrame, limit: int = AUTOMATON_BYTES) -> list[list[tuple]]:
    """(id, text) of distinct phrases, dealt in order to lists of at most ``limit`` bytes (a
    longer phrase is alone). Phrases are the operator's query: they become part of its plan."""
    dealt, size = [], limit + 1
    for r in phrases.orderBy("phrase").toLocalIterator():
        n = len(r["phrase"].encode("utf-8"))
        if size + n > limit:
            dealt.append([])
            size = 0
        dealt[-1].append((r["id"], r["phrase"]))
        size += n
    return dealt


def find(docs: DataFrame, phrases: DataFrame, doc_id: str, phrase_id: str, text: str = "text", phrase: str = "text", limit: int = AUTOMATON_BYTES) -> DataFrame:
    """``doc_id, phrase_id, start``: every occurrence of every phrase in every whole text, overlapping ones too.

    ``start`` is the code point where it begins, from 0. Matching is exact and case
    matters. Null or empty phrases occur nowhere, null texts hold nothing; equal
    phrases of several ids are found once and given each id. Columns are named
    after the two id columns.
    """
    spark = docs.sparkSession
    ship(spark)
    named = phrases.select(F.col(phrase_id).alias("id"), F.col(phrase).cast("string").alias("phrase")).where("phrase <> ''").distinct()
    entries = named.groupBy("phrase").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"))
    kind = named.schema["id"].dataType
    source = docs.select(F.col(doc_id).alias("d"), F.col(text).cast("string").alias("t"))
    schema = StructType([StructField("d", source.schema["d"].dataType), StructField("id", kind), StructField("start", IntegerType())])
    arrow = to_arrow_type(kind)
    out = None
    for part in shards(entries, limit):
        texts, ids = tuple(p.encode("utf-8") for _, p in part), [i for i, _ in part]

        def look(batches, texts=texts, ids=ids):
            automaton, names = _built(texts), pa.array(ids, arrow)
            for b in batches:
                for begin, held in _batches(b.column(1)):
                    of, which, start = occurrences(automaton, held)
                    if len(of):
                        yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(of + begin)), names.take(pa.array(which)), pa.array(start, pa.int32())], names=["d", "id", "start"])

        one = source.mapInArrow(look, schema)
        out = one if out is None else out.unionByName(one)
    if out is None:
        out = spark.createDataFrame([], schema)
    repeated = entries.where("n > 1").select("id", "phrase")
    if repeated.limit(1).count():  # equal phrases of several ids
        same = named.join(repeated.withColumnRenamed("id", "kept"), "phrase").select("kept", "id")
        out = out.join(same.withColumnRenamed("id", "other"), F.col("id") == F.col("kept"), "left").withColumn("id", F.coalesce("other", "id"))
    return out.select(F.col("d").alias(doc_id), F.col("id").alias(phrase_id), F.col("start").cast("long").alias("start"))


def holding(docs: DataFrame, phrases: DataFrame, doc_id: str, phrase_id: str, text: str = "text", phrase: str = "text") -> DataFrame:
    """``doc_id, phrase_id``: which texts hold which phrases, each pair once."""
    return find(docs, phrases, doc_id, phrase_id, text, phrase).select(doc_id, phrase_id).distinct()


def gaps(phrases: DataFrame, hits: DataFrame, group: str, phrase_id: str) -> DataFrame:
    """``group, n_phrases, n_covered, n_hits, gap``: how far each group's phrases are covered.

    ``phrases`` has ``group, ord, phrase_id``, ``hits`` a row an occurrence of a phrase.
    ``gap`` lists the phrases without one in their order, or 无; a group has few phrases.
    """
    n = hits.groupBy(phrase_id).agg(F.count(F.lit(1)).alias("n"))
    found = phrases.join(n, phrase_id, "left").withColumn("n", F.coalesce("n", F.lit(0)))
    open_ = F.array_sort(F.collect_list(F.when(F.col("n") == 0, F.struct("ord", F.col(phrase_id).alias("p")))))
    listed = F.array_join(F.transform(open_, lambda x: x["p"]), "、")
    return found.groupBy(group).agg(
        F.count(F.lit(1)).alias("n_phrases"), F.count_if(F.col("n") > 0).alias("n_covered"), F.sum("n").alias("n_hits"), F.when(listed == "", "无").otherwise(listed).alias("gap")
    )
