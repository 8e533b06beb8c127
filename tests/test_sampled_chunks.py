"""Chunks from sampled bounds: a hot key inside one hour is spread, and results equal the plain windows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from kestrel.operators import sessions, windows

T0 = dt.datetime(2024, 3, 1, 12)
EVENT = "user_id string, ts timestamp_ntz, id long"


def events(seed, n=3000, null=True):
    """One user has two fifths of all events, within 40 minutes; ties and nulls in between."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        if rng.random() < 0.4:
            rows.append(("hot", T0 + dt.timedelta(seconds=rng.randrange(2400)), i))
        else:
            rows.append((rng.choice(["a", "b", "c", None] if null else ["a", "b"]), T0 + dt.timedelta(minutes=rng.randrange(40_000)), i))
    if null:
        rows += [("hot", None, n), ("hot", None, n + 1), (None, None, n + 2), ("only", None, n + 3)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, chunks", [(1, 16), (2, 50), (3, None)])
def test_sessions_equal_the_plain_window(spark, seed, chunks):
    df = spark.createDataFrame(events(seed), EVENT)
    key = lambda x: sorted(map(str, x.collect()))
    want = key(sessions.assign_sessions_plain(df, gap_seconds=30))
    assert key(sessions.assign_sessions(df, gap_seconds=30, chunks=chunks)) == want
    assert key(sessions.assign_sessions(df, gap_seconds=30, chunk_unit="hour")) == want


def test_a_hot_hour_is_spread(spark):
    df = spark.createDataFrame(events(4, 6000, null=False), EVENT)
    by = windows.sampled_chunks(df, "user_id", "ts", 20)
    hot = {r["_c"]: r["n"] for r in by.where("user_id = 'hot'").groupBy("_c").agg(F.count("*").alias("n")).collect()}
    assert len(hot) >= 6 and max(hot.values()) < 6000 / 8
    # chunks rise with the time of a user, and equal rows share one
    spans = by.groupBy("user_id", "_c").agg(F.min("ts").alias("a"), F.max("ts").alias("z")).orderBy("user_id", "_c").collect()
    assert all(p["user_id"] != q["user_id"] or p["z"] < q["a"] for p, q in zip(spans, spans[1:], strict=False))
    # read again, the chunks are the same
    sizes = [sorted(map(tuple, by.groupBy("_c").count().collect())) for _ in range(2)]
    assert sizes[0] == sizes[1]


@pytest.mark.parametrize("chunks", [1, 30])
def test_other_windows_over_sampled_chunks(spark, chunks):
    rows = [(k, t, i, None if i % 11 == 0 else float(i % 7)) for i, (k, t, _) in enumerate(events(5, 800))]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, id long, v double")
    key = lambda x: sorted(map(str, x.collect()))
    chunked = windows.sampled_chunks(df, "k", "ts", chunks, alias="n")
    cols = ["k", "ts", "id", "v", "v_ma"]
    want = windows.centered_moving_avg(df, "k", "ts", "id", ["v"], chunk=F.lit(0)).select(cols)
    assert key(windows.centered_moving_avg(chunked, "k", "ts", "id", ["v"], chunk=F.col("n")).select(cols)) == key(want)
