"""The arriving-file job against averages over whole slices, what it reads and what it writes."""

import datetime as dt
import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from kestrel.functions.scalars import epoch_seconds
from kestrel.operators import arrivals

ROW = "id long, k string, ts timestamp_ntz, a double, b long, c decimal(9,2), d double, day date"
D0 = dt.date(2024, 1, 1)


def made(seed, days=14, n=500):
    rng, rows = random.Random(seed), []
    for i in range(n):
        day = D0 + dt.timedelta(days=rng.randrange(days))
        ts = dt.datetime.combine(day, dt.time(rng.randrange(24), rng.randrange(2), rng.randrange(3)))
        rows.append((i, rng.choice([None, "x", "x", "y"]), ts, rng.choice([None, rng.randrange(900) / 100]), rng.randrange(9), Decimal(rng.randrange(999)) / 100, None, day))
    return rows


def expected(rows, before=6, after=1, need=7):
    days, out = {r[7] for r in rows}, {}
    for r in rows:
        if sum((r[7] + dt.timedelta(days=o)) in days for o in range(-before, after + 1)) >= need:
            slice_ = [q for q in rows if q[1] == r[1] and r[7] - dt.timedelta(days=before) <= q[7] <= r[7] and q[2] <= r[2]]
            out[r[0]] = tuple((lambda v: float(sum(map(Decimal, map(str, v)))) / len(v) if v else None)([q[c] for q in slice_ if q[c] is not None]) for c in (3, 4, 5, 6))
    return out


class Feed:
    """Files that have come so far, and which days were read."""

    def __init__(self, spark, base):
        self.spark, self.rows, self.asked = spark, [], []
        self.job = arrivals.Job(base, ["k"], ["a", "b", "c", "d"], epoch_seconds("ts"), F.date_trunc("hour", F.col("ts")))

    def come(self, rows):
        self.rows += rows
        self.asked = []
        return arrivals.process(self.spark, sorted({r[7] for r in rows}), self._read, self.job)

    def _read(self, days):
        self.asked.append(list(days))
        return self.spark.createDataFrame([r for r in self.rows if r[7] in days], ROW)

    def check(self):
        out = arrivals.output(self.spark, self.job)
        got = {r["id"]: tuple(r[f"{m}_avg"] for m in "abcd") for r in out.collect()} if out is not None else {}
        want = expected(self.rows)
        assert got.keys() == want.keys()
        for i in want:
            assert got[i] == pytest.approx(want[i]), i


def test_days_one_by_one_with_a_late_file(spark, tmp_path):
    feed, rows = Feed(spark, str(tmp_path)), made(1)
    day = lambda i: D0 + dt.timedelta(days=i)
    of = lambda *days: [r for r in rows if r[7] in map(day, days)]
    assert feed.come(of(*range(0, 4))) == []  # no gate is open
    feed.check()
    assert not os.path.exists(tmp_path / "output")
    feed.come(of(5, 6, 7, 8))
    feed.check()
    written = feed.come(of(4))  # late: opens what waited for it
    feed.check()
    assert written and all(day(3) <= d <= day(10) for d in written)
    # earlier days are not read, their totals are
    assert feed.asked == [[day(4)], written]
    before = {d: os.stat(tmp_path / "output" / d).st_mtime_ns for d in os.listdir(tmp_path / "output") if d.startswith("day=")}
    written = feed.come(of(9, 10, 11, 12, 13))
    feed.check()
    untouched = [d for d in before if dt.date.fromisoformat(d[4:]) not in written]
    assert untouched and all(os.stat(tmp_path / "output" / d).st_mtime_ns == before[d] for d in untouched)
    # more rows of a day that is there: only days that look at it are written again
    more = [(9000 + i, "x", dt.datetime.combine(day(9), dt.time(3)), 5.0, 1, Decimal("1.00"), 2.0, day(9)) for i in range(3)]
    written = feed.come(more)
    feed.check()
    assert written == [d for d in map(day, range(8, 14)) if d in written] and day(9) in written
    # the same batch again changes nothing
    assert feed.come([]) == []
    arrivals.process(spark, [day(9)], feed._read, feed.job)
    feed.check()


@pytest.mark.parametrize("seed", [2, 3])
def test_any_order_of_arrival(spark, tmp_path, seed):
    feed, rows = Feed(spark, str(tmp_path)), made(seed, 10, 250)
    order = list(range(10))
    random.Random(seed).shuffle(order)
    for part in (order[:4], order[4:7], order[7:]):
        feed.come([r for r in rows if (r[7] - D0).days in part])
    feed.check()
