"""Repair of conversation structure by cheapest edits towards a grammar of roles.

Rows are hash-partitioned by conversation and sorted by turn; flags that need only
the rows before are window columns. Inside a partition, batches of whole
conversations go to DuckDB: a recursive query advances all of them by one row a
step and keeps, for each grammar state, the least cost and with it the least audit
string. Conversations longer than a batch go through in parts: the states reached
are carried to the next part, so memory does not follow a conversation's length
(its audit string, one value of the result, does).

The grammar of role initials is ``(s?(ua)+)?``. States: 0 nothing yet, 1 after
``s``, 2 after ``u``, 3 after ``a``; 0 and 3 may end.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import duckdb
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows that go to one recursive query; a longer conversation goes in parts.
BATCH_ROWS = 20_000
#: Bytes of text from which a batch is closed earlier.
BATCH_BYTES = 16 << 20
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
SPACE = r"[\x20\x09-\x0D]"

#: The state that an initial leads to.
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


def _moves() -> list[tuple]:
    """(state, initial needed or null, letters, next state, cost, keeps the row) of up to two inserts and one edit."""
    made = []
    for state in range(4):
        at = state
        for inserts in range(3):  # a third one leads back to a state that two fewer reach
            letters, cost = "I" * inserts, INSERT * inserts
            made.append((state, None, letters + "D", at, cost + DELETE, False))
            made += [(state, initial, letters + "K", to, cost, True) for (s, initial), to in STEP.items() if s == at]
            made.append((state, None, letters + "R", _forward(at), cost + REROLE, True))
            at = _forward(at)
    return made


def _forward(state: int) -> int:
    """Where a user or assistant turn leads: only one of the two is legal in a state."""
    return STEP[state, "a"] if state == 2 else STEP[state, "u"]


_ENDS = [(0, "", 0), (1, "II", 2 * INSERT), (2, "I", INSERT), (3, "", 0)]


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, live`` of conversation rows after drawn damage.

    By the CRC-32 of ``conv_id:turn`` modulo 20: 0 drops the row, 1 empties its text,
    2 removes ``.!?``, 3 repeats it, 4 sets its role to user. A null anywhere counts
    as one space, but for ordering and gaps. Dropped rows stay with ``live`` false, so
    that their conversation is reported.
    """
    named = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(named) % 20
    text, role = F.coalesce(F.col("text").cast("string"), F.lit(" ")), F.coalesce(F.col("role").cast("string"), F.lit(" "))
    out = rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (kind != 0).alias("live"), F.when(kind == 3, 2).otherwise(1).alias("times"),
    )
    return out.withColumn("time", F.explode(F.sequence(F.lit(1), "times"))).drop("times", "time")


def flagged(rows: DataFrame) -> DataFrame:
    """Rows by conversation in order, with what repair needs to know of each.

    Order is by turn (nulls first), ties by role and text; rows that are not ``live``
    come last. ``fault`` is the first of blank, duplicate and truncated that holds.
    """
    order = [F.col("turn").asc_nulls_first(), "role", "text"]
    own = Window.partitionBy("conv_id", "live").orderBy(*order)
    same = Window.partitionBy("conv_id", "live", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    core = F.regexp_replace("text", f"{SPACE}+$", "")
    seen = rows.repartition("conv_id").withColumn("again", F.row_number().over(same) > 1)
    fault = F.when(core == "", "blank").when(F.col("again"), "duplicate").when(~F.substring(core, -1, 1).isin(*".!?"), "truncated")
    first = F.substring("role", 1, 1)
    before = F.lag(first).over(own)
    return seen.withColumns({
        "fault": fault, "initial": first, "new_turn": F.col("turn").isNotNull() & ~F.lag("turn").over(own).eqNullSafe(F.col("turn")),
        "illegal": before.isNotNull() & ~F.concat(before, first).isin("su", "ua", "au"),
    }).select("conv_id", "turn", "role", "text", "live", "fault", "initial", "illegal", "new_turn").sortWithinPartitions("conv_id", F.desc("live"), *order)


_WALK = """
WITH RECURSIVE walk(g, i, entry, state, cost, audit) AS (
  SELECT g, 0::BIGINT, state, state, cost, audit FROM starts
  UNION ALL
  SELECT g, i, best.e, state, best.c, best.a FROM (
    SELECT w.g, w.i + 1 AS i, m.next AS state,
           min(struct_pack(c := w.cost + m.cost + CASE WHEN m.keeps AND r.fault = 'truncated' THEN $truncated ELSE 0 END, a := w.audit || m.letters, e := w.entry)) AS best
    FROM walk w JOIN turns r ON r.g = w.g AND r.i = w.i JOIN moves m ON m.state = w.state
    WHERE CASE WHEN m.keeps THEN coalesce(r.fault, '') NOT IN ('blank', 'duplicate') AND (m.initial IS NULL OR m.initial = r.initial) ELSE true END
    GROUP BY w.g, w.i, m.next))
SELECT g, entry, state, cost, audit FROM walk JOIN (SELECT g, count(*) AS n FROM turns GROUP BY g) USING (g) WHERE i = n
"""

#: Edits spelt out against rows: what the letters of a path make of its rows.
_REPAIRED = r"""
WITH letters AS (SELECT p, g, entry, unnest(string_split(letters, '')) AS e, generate_subscripts(string_split(letters, ''), 1) AS k FROM paths WHERE letters <> ''),
placed AS (SELECT *, sum((e <> 'I')::BIGINT) OVER w - 1 AS i FROM letters WINDOW w AS (PARTITION BY p ORDER BY k)),
kept AS (SELECT l.*, r.role, r.text, e = 'K' AND r.initial = 's' AS leads FROM placed l LEFT JOIN turns r ON l.e <> 'I' AND r.g = l.g AND r.i = l.i WHERE e <> 'D'),
named AS (SELECT *, sum((NOT leads)::BIGINT) OVER w - 1 + (entry = 2)::BIGINT AS nth FROM kept WINDOW w AS (PARTITION BY p ORDER BY k))
SELECT p, string_agg(CASE WHEN e = 'K' THEN role WHEN nth % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN e = 'I' THEN '' ELSE text END, chr(10) ORDER BY k) AS piece
FROM named GROUP BY p
"""


class _Path:
    """The best way to a state so far: cost, audit not yet shared by all states, hash of the rows made."""

    def __init__(self, cost: int = 0, audit: str = "", made=None, some: bool = False):
        self.cost, self.audit, self.made, self.some = cost, audit, made or hashlib.sha256(), some

    def after(self, cost: int, audit: str, piece: str | None) -> _Path:
        made = self.made.copy()
        if piece is not None:
            made.update((("\n" if self.some else "") + piece).encode("utf-8"))
        return _Path(cost, audit, made, self.some or piece is not None)


class _Repair:
    """Conversations of one partition, in order, through DuckDB."""

    def __init__(self) -> None:
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "600MB", "temp_directory": ""})
        moves = list(zip(*_moves()))
        self.con.register("m", pa.table({"state": pa.array(moves[0], pa.int32()), "initial": pa.array(moves[1], pa.string()), "letters": moves[2], "next": pa.array(moves[3], pa.int32()), "cost": pa.array(moves[4], pa.int64()), "keeps": moves[5]}))
        self.con.execute("CREATE TABLE moves AS SELECT * FROM m")
        self.carried: dict[int, _Path] | None = None  # of a conversation that goes in parts
        self.shared: list[str] = []  # its audit as far as all states agree
        self.tally: list[int] = [0] * 8

    def run(self, rows: pa.Table, groups: list[int], open_end: bool) -> list[tuple]:
        """Result rows of the conversations in ``rows`` (``groups`` has where each begins).

        With ``open_end`` the rows are one part of a single conversation that goes on.
        """
        n, edges = len(groups), [*groups, rows.num_rows]
        g = pa.array([k for k in range(n) for _ in range(edges[k + 1] - edges[k])], pa.int64())
        i = pa.array([x for k in range(n) for x in range(edges[k + 1] - edges[k])], pa.int64())
        self.con.register("batch", rows.append_column("g", g).append_column("i", i))
        self.con.execute("CREATE OR REPLACE TEMP TABLE turns AS SELECT g, i, role, text, fault, initial FROM batch WHERE live")
        counts = {r[0]: r[1:] for r in self.con.execute(
            "SELECT g, count(*) FILTER (live), count(*) FILTER (live AND fault = 'blank'), count(*) FILTER (live AND fault = 'duplicate'), count(*) FILTER (live AND fault = 'truncated'),"
            " count(*) FILTER (live AND illegal), count(*) FILTER (live AND new_turn), min(turn) FILTER (live), max(turn) FILTER (live) FROM batch GROUP BY g").fetchall()}
        begin = [self.carried or {0: _Path()}] + [{0: _Path()}] * (n - 1)
        flat = [(k, s, p.cost, p.audit) for k in range(n) for s, p in begin[k].items()]
        self.con.register("starts", pa.table({"g": pa.array([f[0] for f in flat], pa.int64()), "state": pa.array([f[1] for f in flat], pa.int32()), "cost": pa.array([f[2] for f in flat], pa.int64()), "audit": pa.array([f[3] for f in flat], pa.string())}))
        reached = self.con.execute(_WALK, {"truncated": TRUNCATED}).fetchall()
        if not open_end:  # only the way that ends best is followed further
            ended: dict[int, tuple] = {}
            for k, entry, state, cost, audit in reached:
                _, letters, more = _ENDS[state]
                found = (cost + more, audit + letters, entry, state)
                if k not in ended or found[:2] < ended[k][:2]:
                    ended[k] = found
            reached = [(k, entry, state, cost, audit) for k, (cost, audit, entry, state) in sorted(ended.items())]
        made = [(p, k, entry, audit[len(begin[k][entry].audit):]) for p, (k, entry, _, _, audit) in enumerate(reached)]
        self.con.register("paths", pa.table({"p": pa.array([m[0] for m in made], pa.int64()), "g": pa.array([m[1] for m in made], pa.int64()), "entry": pa.array([m[2] for m in made], pa.int32()), "letters": pa.array([m[3] for m in made], pa.string())}))
        pieces = dict(self.con.execute(_REPAIRED).fetchall())
        after = {(k, state): begin[k][entry].after(cost, audit, pieces.get(p)) for p, (k, entry, state, cost, audit) in enumerate(reached)}
        if open_end:
            self._carry({s: x for (_, s), x in after.items()} or begin[0], counts[0])
            return []
        by_group = {k: x for (k, _), x in after.items()}
        out = []
        for k in range(n):
            one = self._added(counts[k]) if k == 0 else list(counts[k])
            path = by_group.get(k)
            if path is None and k == 0 and self.carried:  # the rest of it has no live rows
                state, path = min(self.carried.items(), key=lambda x: (x[1].cost + _ENDS[x[0]][2], x[1].audit + _ENDS[x[0]][1]))
                ending = "\n".join(["user:", "assistant:"][2 - len(_ENDS[state][1]):]) if _ENDS[state][1] else None
                path = path.after(path.cost + _ENDS[state][2], path.audit + _ENDS[state][1], ending)
            path = path or _Path()
            gaps = one[7] - one[6] + 1 - one[5] if one[6] is not None else 0
            audit = "".join([*(self.shared if k == 0 else []), path.audit])
            out.append((rows.column("conv_id")[edges[k]].as_py(), gaps, one[1], one[2], one[3], one[4], path.cost, audit, path.made.hexdigest()))
        self.carried, self.shared, self.tally = None, [], [0] * 8
        return out

    def _added(self, counts) -> list:
        was = self.tally if self.carried else [0] * 6 + [None, None]
        ends = [[x for x in pair if x is not None] for pair in ((was[6], counts[6]), (was[7], counts[7]))]
        return [a + b for a, b in zip(was[:6], counts[:6])] + [min(ends[0], default=None), max(ends[1], default=None)]

    def _carry(self, states: dict[int, _Path], counts) -> None:
        self.tally = self._added(counts)
        common = os.path.commonprefix([p.audit for p in states.values()])
        self.shared.append(common)
        for p in states.values():
            p.audit = p.audit[len(common):]
        self.carried = states


_OUT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_NAMES = [f.split()[0] for f in _OUT.split(", ")]


def _starts(ids: pa.ChunkedArray) -> list[int]:
    """Where each conversation begins in rows sorted by conversation (null is one)."""
    values = ids.to_pylist()
    return [i for i, v in enumerate(values) if i == 0 or v != values[i - 1]]


def repaired(rows: DataFrame, batch_rows: int = BATCH_ROWS, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """A row for each conversation of :func:`flagged` rows; ids are whole numbers or null."""

    def part(batches) -> Iterator[pa.RecordBatch]:
        repair, held = _Repair(), None
        kind = pa.schema([pa.field(f.split()[0], pa.string() if f.endswith("string") else pa.int64()) for f in _OUT.split(", ")])

        def emit(found):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), kind.types)], names=_NAMES)

        for b in batches:
            for at in range(0, b.num_rows, max(1, batch_rows // 4)):
                t = pa.Table.from_batches([b.slice(at, max(1, batch_rows // 4))])
                held = t if held is None else pa.concat_tables([held, t]).combine_chunks()
                if held.num_rows < batch_rows and held.column("text").nbytes < batch_bytes:
                    continue
                groups = _starts(held.column("conv_id"))
                if len(groups) > 1:  # all but the last conversation are whole
                    found = repair.run(held.slice(0, groups[-1]), groups[:-1], False)
                    held = held.slice(groups[-1]).combine_chunks()
                    yield emit(found)
                else:
                    # the last row waits, so that the conversation is known to go on
                    repair.run(held.slice(0, held.num_rows - 1), [0], True) if held.num_rows > 1 else None
                    held = held.slice(max(0, held.num_rows - 1)).combine_chunks()
        if held is not None and held.num_rows:
            yield emit(repair.run(held, _starts(held.column("conv_id")), False))

    return rows.withColumn("conv_id", F.col("conv_id").cast("long")).mapInArrow(part, _OUT)


def repair_conversations(rows: DataFrame, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """Damages, flags and repairs: one row for every ``conv_id``, null included.

    ``gaps`` are turns missing between the first and the last; ``blank, duplicate,
    truncated`` count first faults; ``illegal`` counts neighbours whose initials are
    not su, ua or au. ``audit`` spells the cheapest edits (Delete, Insert, Keep, Rerole)
    that give a legal order, the ASCII-least of equally cheap ones, and
    ``repaired_sha256`` hashes what they make. A conversation whose rows are all
    dropped has zeros, an empty audit and the hash of nothing. Extra columns are not
    read; an empty table gives no rows.
    """
    return repaired(flagged(damaged(rows)), batch_rows)


def oracle() -> str:
    """DuckDB SQL of :func:`repair_conversations`, one edit a step: the recursion takes a
    single letter at a time and knows the state as what may come next."""
    bit = "xor(acc >> 1, CASE WHEN (acc & 1) = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END)"
    byte = "list_reduce(range(0, 8), lambda acc, k: " + bit + ", xor(r, ('0x' || substr(x, 2 * i - 1, 2))::BIGINT))"
    crc = f"xor(4294967295::BIGINT, list_reduce(range(1, length(x) // 2 + 1), lambda r, i: {byte}, 4294967295::BIGINT))"
    core = r"regexp_replace(text, '[\x20\x09-\x0D]+$', '')"
    return rf"""WITH RECURSIVE src AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, hex(encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))) AS x FROM conversations),
hit AS (SELECT *, ({crc}) % 20 AS kind FROM src),
dam AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
 unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy FROM hit WHERE kind <> 0),
ord AS (SELECT *, row_number() OVER w AS i, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again, lag(left(role, 1)) OVER w || left(role, 1) AS pair
 FROM dam WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
r AS (SELECT *, left(role, 1) AS c, CASE WHEN {core} = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN right({core}, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM ord),
conv AS (SELECT c.conv_id, coalesce(n, 0) AS n, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal
 FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN (SELECT conv_id, count(*) AS n, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
 count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id) a ON c.conv_id IS NOT DISTINCT FROM a.conv_id),
w(conv_id, n, i, s, q, cost, audit, made) AS (
 SELECT conv_id, n, 0::BIGINT, '', 0, 0::BIGINT, '', []::VARCHAR[] FROM conv
 UNION ALL
 SELECT conv_id, n, i, s, q, b.cost, b.audit, b.made FROM (
  SELECT conv_id, n, i, s, q, min({{'cost': cost, 'audit': audit, 'made': made}}) AS b FROM (
   SELECT w.conv_id, w.n, w.i + (e <> 'I')::BIGINT AS i, CASE WHEN e = 'D' THEN w.s WHEN e = 'K' THEN r.c WHEN w.s = 'u' THEN 'a' ELSE 'u' END AS s, CASE WHEN e = 'I' THEN w.q + 1 ELSE 0 END AS q,
    w.cost + CASE e WHEN 'D' THEN 4 WHEN 'I' THEN 3 WHEN 'R' THEN 3 ELSE 0 END + CASE WHEN e IN ('K', 'R') AND r.fault = 'truncated' THEN 3 ELSE 0 END AS cost, w.audit || e AS audit,
    CASE e WHEN 'D' THEN w.made WHEN 'K' THEN list_append(w.made, r.role || ':' || r.text)
     ELSE list_append(w.made, CASE WHEN w.s = 'u' THEN 'assistant:' ELSE 'user:' END || CASE WHEN e = 'R' THEN r.text ELSE '' END) END AS made
   FROM w CROSS JOIN (VALUES ('D'), ('I'), ('K'), ('R')) AS o(e) LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1
   WHERE CASE e WHEN 'I' THEN w.q < 2 WHEN 'D' THEN r.i IS NOT NULL
    WHEN 'K' THEN r.fault IN ('', 'truncated') AND (w.s || r.c) IN ('s', 'u', 'su', 'ua', 'au') ELSE r.fault IN ('', 'truncated') END)
  GROUP BY conv_id, n, i, s, q)),
f AS (SELECT conv_id, min({{'cost': cost, 'audit': audit, 'made': made}}) AS b FROM w WHERE i = n AND s IN ('', 'a') GROUP BY conv_id)
SELECT c.conv_id, gaps, blank, duplicate, truncated, illegal, b.cost AS cost, b.audit AS audit, sha256(array_to_string(b.made, chr(10))) AS repaired_sha256
FROM conv c JOIN f ON c.conv_id IS NOT DISTINCT FROM f.conv_id"""
