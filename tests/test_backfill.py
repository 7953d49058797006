"""Streamed rounds against a plain loop over days."""

import datetime
import random

import pytest

from corpusmill.streaming import backfill

START = datetime.datetime(2024, 3, 1)
SCHEMA = "topic long, item long, cell int, ts timestamp"


def plain(rows, cells=16, exempt=()):
    out, last = [], max(r[3] for r in rows).date()
    epoch = datetime.date(1970, 1, 1)
    for topic in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == topic]
        first = {}
        for _, item, cell, ts in own:
            first[item] = min(first.get(item, (ts, cell)), (ts, cell))
        held = {c: [0, 0] for c in range(cells) if c not in exempt}
        total = streak = 0
        back = False
        for day in sorted({r[3].date() for r in own}):
            if day >= last:
                break
            new = [cell for ts, cell in first.values() if ts.date() == day]
            for c, h in held.items():
                if back and h[0] == 0 and h[1] < 2:
                    h[1] = 0 if c in new else h[1] + 1
                h[0] += new.count(c)
            if not back:
                rate = (1.0 if new else 0.0) if total == 0 else len(new) / total
                streak = streak + 1 if rate < 0.5 else 0
            missing = sum(n == 0 and e < 2 for n, e in held.values())
            out.append((topic, (day - epoch).days, back, len(new), total, streak, missing, sum(n == 0 and e >= 2 for n, e in held.values()), missing == 0 and streak >= 3))
            total, back = total + len(new), missing > 0
    return sorted(out)


def finds(seed, n=500, days=14, topics=4):
    rng = random.Random(seed)
    return [(t := rng.randrange(topics), rng.randrange(60 + 40 * t), rng.randrange(17) if t else rng.randrange(5), START + datetime.timedelta(seconds=rng.randrange(days * 86400))) for _ in range(n)]


@pytest.mark.parametrize("slices", [1, 4])
def test_stream_equals_loop_also_after_stops(spark, slices):
    rows = finds(2)
    got = sorted(map(tuple, backfill.replay(spark.createDataFrame(rows, SCHEMA), slices).collect()))
    want = plain(rows)
    assert got == want
    assert any(r[2] for r in want) and any(r[7] for r in want) and any(r[8] for r in want)  # back-fills, waived cells, saturation


def test_late_finds_within_the_watermark(spark, tmp_path):
    """A find that comes after a later one of its item moves the item back; one beyond the watermark is dropped."""
    day = lambda d, h=1: START + datetime.timedelta(days=d, hours=h)
    batches = [
        [(1, 10, 3, day(0)), (1, 11, 4, day(1, 9))],
        [(1, 11, 5, day(0, 12)), (1, 12, 6, day(3))],  # item 11 was found earlier, in another cell
        [(1, 13, 7, day(0)), (1, 14, 8, day(6))],  # item 13 is too late
    ]
    for b in batches:
        spark.createDataFrame(b, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        backfill.run(spark, str(tmp_path / "in"), SCHEMA, str(tmp_path / "out"), str(tmp_path / "state"), delay="36 hours")
    got = sorted((r.round - 19783, r.new_count, r.prev_total) for r in spark.read.schema(backfill.COLUMNS).parquet(str(tmp_path / "out")).collect())
    assert got == [(0, 2, 0), (1, 0, 2), (3, 1, 2)]


def test_exempt_cells_and_empty_input(spark):
    rows = finds(3, n=120, days=6, topics=1)
    got = sorted(map(tuple, backfill.replay(spark.createDataFrame(rows, SCHEMA), 1, exempt=tuple(range(5, 16))).collect()))
    assert got == plain(rows, exempt=tuple(range(5, 16))) and got[-1][6] == 0
    assert backfill.replay(spark.createDataFrame([], SCHEMA)).count() == 0
