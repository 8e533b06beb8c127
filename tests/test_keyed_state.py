"""Keyed state with timers: the ledger and the difference counts on a stream, with restarts and rows out of order."""

import datetime as dt
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.test_ledger import IN, OUT, row_by_row

T0 = dt.datetime(2024, 5, 1)
MOVE = "who string, ts timestamp, id long, kind string, amount double"


def feed(spark, folder, rows, schema):
    """One file more; a stream takes files by the time they were written."""
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def drained(spark, make, tmp_path, steps, schema):
    """What a stream has written after each step, stopped and started anew in between."""
    from kestrel.streaming import keyed, streams

    src, out, ckpt = (str(tmp_path / x) for x in ("in", "out", "ckpt"))
    seen = []
    for rows in steps:
        feed(spark, src, rows, schema)
        with keyed.rocksdb_state(spark):
            streams.run_until_drained(streams.start(make(streams.file_stream(spark, src, schema)), ckpt, path=out))
        seen.append(spark.read.parquet(out).collect())
    return seen


def test_ledger_goes_on_after_a_restart(spark, tmp_path):
    from kestrel.streaming import keyed, streams

    rng = random.Random(1)
    rows = [(rng.choice([None, "a", "a", "b", "c"]), T0 + dt.timedelta(seconds=20 * i), i, rng.choice(["in", "gift", "out", "out", "other"]), rng.choice([None, rng.randrange(500) / 100])) for i in range(300)]
    # up to 50 rows (1000 s) out of order, which the delay allows
    late = sorted(rows, key=lambda r: r[2] + rng.randrange(50))
    end = [("end", dt.datetime(2100, 1, 1), -1, "in", 1.0)]
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    seen = drained(spark, lambda s: keyed.stream_ledger(s, "who", streams.event_time("ts"), "id", "kind", "amount", IN, OUT, "30 minutes"),
                   tmp_path, [late[:110], late[110:200], late[200:], end], MOVE)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before
    want = row_by_row([(r[0], r[1].timestamp(), *r[2:]) for r in rows])
    got = {r["id"]: (r["applied"], round(r["balance"] * 100)) for r in seen[-1] if r["id"] >= 0}
    assert got == want
    assert [len(x) for x in seen] == sorted({len(x) for x in seen}) and 0 < len(seen[1]) < len(want)
    assert {r["who"] for r in seen[-1]} >= {None, "a", "b", "c"}


@pytest.mark.parametrize("width, slide", [(300, 1), (60, 20), (5, 5)])
def test_runs_equal_counting_every_window(spark, tmp_path, width, slide):
    from kestrel.streaming import keyed, streams

    rng = random.Random(2)
    rows = [(rng.choice([None, "x", "x", "y"]), T0 + dt.timedelta(seconds=rng.randrange(3000) + rng.random())) for _ in range(150)]
    rows.sort(key=lambda r: r[1])
    end = [("end", dt.datetime(2100, 1, 1))]
    make = lambda s: keyed.sliding_runs(s, streams.event_time("ts"), "word", width, slide, "1 minute")
    last = drained(spark, make, tmp_path, [rows[:40], rows[40:100], rows[100:], end], "word string, ts timestamp")[-1]
    counts = Counter()
    for word, ts in rows:
        at = int(ts.timestamp()) // slide * slide
        for s in range(at + slide - width, at + slide, slide):
            counts[word, s] += 1
    got, runs = {}, defaultdict(list)
    for r in last:
        if r["word"] != "end":
            a, z = int(r["first_start"].timestamp()), int(r["last_start"].timestamp())
            runs[r["word"]].append((a, z, r["count"]))
            for s in range(a, z + 1, slide):
                assert (r["word"], s) not in got
                got[r["word"], s] = r["count"]
    assert got == dict(counts)
    for of in runs.values():  # runs are as long as can be
        of.sort()
        assert all(b[0] > a[1] + slide or b[2] != a[2] for a, b in zip(of, of[1:], strict=False))
        assert len(of) <= 2 * len(rows)


def test_width_is_a_multiple_of_the_slide(spark, tmp_path):
    from kestrel.streaming import keyed

    with pytest.raises(ValueError):
        keyed.sliding_runs(spark.createDataFrame([("x", T0)], "word string, ts timestamp"), F.col("ts"), "word", 7, 2, "1 minute")
