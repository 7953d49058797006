"""Rounds of search as a stream: coverage first, back-fill rounds, waived cells, saturation.

A round is a day of finds of a topic. When event time passes its end, a timer closes
it. Coverage is judged before saturation: while a cell of the grid that isn't exempt has
nothing, the next round is a back-fill. Back-fills don't count towards saturation,
and a cell that stays empty in two of them in a row is waived. A topic is
saturated when nothing is missing and its last three rounds that count found few new.

State of a topic: which items it has seen and what the open rounds found (maps), what
its cells hold (a map), the rounds closed (a list), and its totals. Items may arrive
in any order within the watermark.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from .. import packs
from ..work import ship, work_folder

DAY = 86_400_000
#: Share of new items under which a round counts as low, low rounds that saturate, empty back-fills that waive.
THRESHOLD, CONSECUTIVE, EMPTY = 0.5, 3, 2
COLUMNS = "topic long, round long, backfill boolean, new_count long, prev_total long, streak int, n_missing int, n_waived int, saturated boolean"


class Rounds(StatefulProcessor):
    """Closes rounds of one topic; see the module."""

    def __init__(self, cells: int = len(packs.CELLS), exempt: tuple[int, ...] = ()):
        self.grid = [c for c in range(cells) if c not in exempt]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getMapState("seen", "item long", "at long, cell int")
        self.open = handle.getMapState("open", "round long, cell int", "n long")
        self.cells = handle.getMapState("cells", "cell int", "found long, empty int")
        self.closed = handle.getListState("closed", "round long, new_count long")
        self.totals = handle.getValueState("totals", "total long, streak int, backfill boolean, last long")

    def _totals(self) -> tuple:
        return self.totals.get() if self.totals.exists() else (0, 0, False, -1)

    def _add(self, round_: int, cell: int, n: int) -> None:
        key = (round_, cell)
        had = self.open.getValue(key)[0] if self.open.containsKey(key) else 0
        self.open.updateValue(key, (had + n,))

    def handleInputRows(self, key, rows, timerValues):
        last = self._totals()[3]
        opened = set()
        for frame in rows:
            frame = frame[frame["at"] // (DAY * 1000) > last]  # of rounds still open
            for round_ in (frame["at"] // (DAY * 1000)).unique().tolist():
                if round_ not in opened:
                    opened.add(round_)
                    self._add(round_, -1, 0)  # a round counts even if it finds nothing new
                    self.handle.registerTimer((round_ + 1) * DAY)
            firsts = frame.sort_values(["at", "cell"]).drop_duplicates("item")
            for item, cell, at in zip(firsts["item"].tolist(), firsts["cell"].tolist(), firsts["at"].tolist()):
                round_ = at // (DAY * 1000)
                if self.seen.containsKey((item,)):
                    was_at, was_cell = self.seen.getValue((item,))
                    if (was_at, was_cell) <= (at, cell):
                        continue
                    self._add(was_at // (DAY * 1000), was_cell, -1)  # an earlier find came later
                self.seen.updateValue((item,), (at, cell))
                self._add(round_, cell, 1)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        until = expiredTimerInfo.getExpiryTimeInMs() // DAY
        total, streak, backfill, last = self._totals()
        found: dict[int, dict[int, int]] = {}
        for (round_, cell), (n,) in self.open.iterator():
            if round_ < until:
                found.setdefault(round_, {})[cell] = n
        out = []
        for round_ in sorted(found):
            new = found[round_]
            count = sum(n for cell, n in new.items() if cell >= 0)
            held = {c: self.cells.getValue((c,)) if self.cells.containsKey((c,)) else (0, 0) for c in self.grid}
            for c, (n, empty) in held.items():
                more = new.get(c, 0)
                if backfill and n == 0 and empty < EMPTY:
                    empty = 0 if more else empty + 1
                held[c] = (n + more, empty)
                self.cells.updateValue((c,), held[c])
            if not backfill:
                low = count < THRESHOLD * total if total else count == 0
                streak = streak + 1 if low else 0
            waived = sum(n == 0 and empty >= EMPTY for n, empty in held.values())
            missing = sum(n == 0 and empty < EMPTY for n, empty in held.values())
            out.append((int(key[0]), round_, bool(backfill), count, total, streak, missing, waived, missing == 0 and streak >= CONSECUTIVE))
            self.closed.appendValue((round_, count))
            total, backfill, last = total + count, missing > 0, round_
            for cell in new:
                self.open.removeKey((round_, cell))
        if out:
            self.totals.update((total, streak, backfill, last))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in COLUMNS.split(", ")])

    def close(self) -> None:
        pass


def rounds_of(finds: DataFrame, delay: str = "0 seconds", exempt: tuple[int, ...] = ()) -> DataFrame:
    """Closed rounds (:data:`COLUMNS`) of streamed finds: ``topic long, item long, cell int, ts timestamp``."""
    timed = finds.withWatermark("ts", delay).withColumn("at", F.unix_micros("ts"))
    return timed.groupBy("topic").transformWithStateInPandas(statefulProcessor=Rounds(exempt=exempt), outputStructType=COLUMNS, outputMode="Append", timeMode="EventTime")


_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def replay(finds: DataFrame, slices: int = 3, delay: str = "0 seconds", exempt: tuple[int, ...] = ()) -> DataFrame:
    """Closed rounds of a finite table of finds, replayed in time order.

    Each slice of time is written to a folder that the stream watches; the stream is started,
    takes what is new, and stops; the next start goes on from its checkpoint. The day of
    the last find stays open.
    """
    spark = finds.sparkSession
    ship(spark)
    base = work_folder(spark, "replay")
    source, sink, state = f"{base}/finds", f"{base}/rounds", f"{base}/state"
    ends = finds.agg(F.min(F.unix_micros("ts")), F.max(F.unix_micros("ts"))).first()
    if ends[0] is None:
        return spark.createDataFrame([], COLUMNS)
    step = (ends[1] - ends[0]) // slices + 1
    at = F.unix_micros("ts")
    for k in range(slices):
        finds.where((at >= ends[0] + k * step) & (at < ends[0] + (k + 1) * step)).write.mode("append").parquet(source)
        run(spark, source, finds.schema, sink, state, delay, exempt)
    return spark.read.schema(COLUMNS).parquet(sink)


def run(spark: SparkSession, source: str, schema, sink: str, state: str, delay: str = "0 seconds", exempt: tuple[int, ...] = ()) -> None:
    """Takes what is new in the source folder and stops; state and progress are in ``state``."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, _ROCKS)  # maps, lists and timers need it
    try:
        stream = rounds_of(spark.readStream.schema(schema).parquet(source), delay, exempt)
        stream.writeStream.format("parquet").option("path", sink).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)
