"""Accounts of the streamed ledger share states: calls of Python do not grow with the accounts, and no account sees another."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests.test_keyed_state import T0, drained
from tests.test_ledger import IN, OUT, row_by_row


@pytest.mark.parametrize("shares", [1, 3])
def test_accounts_of_one_share_keep_apart(spark, tmp_path, shares):
    from kestrel.streaming import keyed, streams

    rng = random.Random(shares)
    big = 1 << 60  # a null beside it must not make it a float
    who = [None, *(big + i for i in range(12))]
    rows = [(rng.choice(who), T0 + dt.timedelta(seconds=20 * i), big + i, rng.choice(["in", "gift", "out", "out"]), rng.choice([None, rng.randrange(500) / 100])) for i in range(300)]
    end = [(-1, dt.datetime(2100, 1, 1), -1, "in", 1.0)]
    make = lambda s: keyed.stream_ledger(s, "who", streams.event_time("ts"), "id", "kind", "amount", IN, OUT, "30 minutes", shares)
    last = drained(spark, make, tmp_path, [rows, end], "who long, ts timestamp, id long, kind string, amount double")[-1]
    assert {r["id"]: (r["applied"], round(r["balance"] * 100)) for r in last if r["id"] >= 0} == row_by_row([(r[0], r[1].timestamp(), *r[2:]) for r in rows])
    assert {r["id"]: r["who"] for r in last if r["id"] >= 0} == {r[2]: r[0] for r in rows}


def test_states_do_not_grow_with_the_accounts(spark, tmp_path):
    from kestrel.streaming import keyed, streams

    src, out, ckpt = (str(tmp_path / x) for x in ("in", "out", "ckpt"))
    rows = spark.range(500).select(F.col("id").alias("who"), F.timestamp_seconds(F.col("id") + 1_700_000_000).alias("ts"), "id", F.lit("in").alias("kind"), F.lit(1.0).alias("amount"))
    rows.coalesce(1).write.parquet(src)
    with keyed.rocksdb_state(spark):
        led = keyed.stream_ledger(streams.file_stream(spark, src, rows.schema), "who", streams.event_time("ts"), "id", "kind", "amount", IN, OUT, "1 minute", 16)
        q = streams.start(led, ckpt, path=out)
        streams.run_until_drained(q)
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]) <= 16
