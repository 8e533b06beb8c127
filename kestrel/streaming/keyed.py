"""State of one's own for each key, with event-time timers (STM-11), and what is built on it.

The state lies in the RocksDB store (:func:`rocksdb_state`): on local disk and
spilled, with its changes in the stream's checkpoint, so a key that goes on
after a restart finds what it had. Rows of a micro-batch come unsorted, and rows
up to the watermark's delay late; both operators here therefore hold back what
the watermark has not passed, set a timer for the earliest of it, and work
through the rest in order. What they hold is bounded by the delay, not by the
stream.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from kestrel.operators.ledger import fold, in_cents

#: Shares that the accounts of a ledger are dealt to.
SHARES = 4096

_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Streams started inside keep their state in RocksDB; the session's own setting comes back."""
    before = spark.conf.get(_STORE)
    spark.conf.set(_STORE, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(_STORE, before)


def _wake(state: GroupState, at_ms: int) -> None:
    """A timer that fires once the watermark is past ``at_ms``."""
    state.setTimeoutTimestamp(max(at_ms, state.getCurrentWatermarkMs() + 1))


def stream_ledger(stream: DataFrame, account: str, ts: Column, id_col: str, kind: str, amount: str,
                  deposit_kinds, withdrawal_kinds, delay: str, shares: int = SHARES) -> DataFrame:
    """WIN-10 on a stream: (account, id, ts, applied, balance) of every movement, once it is final.

    Movements of an account are applied in the order of (ts, id). One is final
    when the watermark has passed its time, since an earlier one can come until
    then. Null amounts change nothing; a null account is an account, a null id
    comes first; movements without a time are left out, as the watermark cannot
    place them. Accounts are plain values (numbers, texts, dates): they travel as text.

    A call of Python costs what thousands of movements do, so accounts are not the
    keys: each belongs by its hash to one of ``shares``, whose state holds the
    balance of each of its accounts and their movements not yet final. A batch makes
    a call for each share at most. A checkpoint goes on with its own ``shares`` only.
    """
    rows = (stream.where(F.col(kind).isin(*deposit_kinds, *withdrawal_kinds)).withColumn("_et", ts).where("_et is not null")
            .withWatermark("_et", delay))
    whole, cents = F.col(id_col).cast("long"), in_cents(stream, amount)
    # null numbers would come to pandas as floats
    rows = rows.select(F.pmod(F.xxhash64(account), F.lit(shares)).cast("int").alias("_share"), "_et", F.col(account).cast("string").alias("_who"),
                       F.unix_micros("_et").alias("_us"), whole.isNotNull().alias("_named"), F.coalesce(whole, F.lit(0)).alias("_id"),
                       F.col(kind).isin(*deposit_kinds).alias("_dep"), cents.isNotNull().alias("_paid"), F.coalesce(cents, F.lit(0)).alias("_cents"))

    def run(_key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        accounts, balances, *moves = state.get if state.exists else ([],) * 7
        balance = dict(zip(accounts, balances, strict=True))
        held = list(zip(*moves, strict=True))
        for pdf in batches:
            ids = [i if named else None for i, named in zip(pdf["_id"].tolist(), pdf["_named"].tolist(), strict=True)]
            amounts = [c if paid else None for c, paid in zip(pdf["_cents"].tolist(), pdf["_paid"].tolist(), strict=True)]
            held += zip(pdf["_us"].tolist(), ids, pdf["_who"].tolist(), pdf["_dep"].tolist(), amounts, strict=True)
        held.sort(key=lambda m: (m[0], m[1] is not None, m[1] or 0))
        past = state.getCurrentWatermarkMs() * 1000
        n = bisect_right(held, past, key=lambda m: m[0])
        if n:
            applied, after = [], []
            for _, _, who, dep, cents in held[:n]:
                (ok,), (left,) = fold([dep], [cents], balance.get(who, 0))
                balance[who] = left
                applied.append(ok)
                after.append(left)
            us, ids, who, *_ = zip(*held[:n], strict=True)
            yield pd.DataFrame({"who": pd.Series(who, dtype=object), "id": pd.Series(ids, dtype=object if None in ids else "int64"),
                                "ts": pd.to_datetime(us, unit="us"), "applied": applied, "cents": after})
        held = held[n:]
        state.update((list(balance), list(balance.values()), *([list(x) for x in zip(*held, strict=True)] if held else ([],) * 5)))
        if held:
            _wake(state, held[0][0] // 1000 + 1)

    out = StructType([StructField("who", StringType()), StructField("id", LongType()), StructField("ts", TimestampType())]).add("applied", "boolean").add("cents", "long")
    got = rows.groupBy("_share").applyInPandasWithState(
        run, out, "accounts array<string>, balances array<long>, us array<long>, ids array<long>, who array<string>, dep array<boolean>, cents array<long>",
        "append", GroupStateTimeout.EventTimeTimeout)
    return got.select(F.col("who").cast(stream.schema[account].dataType).alias(account), "id", "ts", "applied", (F.col("cents").cast("double") / 100).alias("balance"))


class Differences(StatefulProcessor):
    """Running count of a key over the changes that its buckets make; see :func:`sliding_runs`."""

    def __init__(self, key: str, width_s: int, slide_s: int):
        self.key, self.width, self.slide = key, width_s, slide_s

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("changes", "count long, since long, times array<long>, deltas array<long>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        count, since, change = self._held()
        before = min(change, default=None)
        for pdf in rows:
            for at, n in zip(pdf["at"].tolist(), pdf["n"].tolist(), strict=True):
                for t, d in ((at + self.slide - self.width, n), (at + self.slide, -n)):
                    change[t] = change.get(t, 0) + d
        yield from self._told(key, count, since, change, before, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        count, since, change = self._held()
        yield from self._told(key, count, since, change, None, timerValues)

    def close(self) -> None:
        pass

    def _held(self) -> tuple[int, int, dict[int, int]]:
        if not self.state.exists():
            return 0, 0, {}
        count, since, times, deltas = self.state.get()
        return count, since, dict(zip(times, deltas, strict=True))

    def _told(self, key, count, since, change, timer_of, timerValues) -> Iterator[pd.DataFrame]:
        """The runs that are final; ``timer_of`` is the change that the key's timer waits for."""
        # a bucket still to come ends after the watermark, so it changes nothing at or before this time
        final = timerValues.getCurrentWatermarkInMs() // 1000 - self.width
        runs = []
        for t in sorted(t for t in change if t <= final):
            d = change.pop(t)
            if d:
                if count:
                    runs.append((since, t - self.slide, count))
                count, since = count + d, t
        first = min(change, default=None)
        if timer_of is not None and timer_of != first:
            self.handle.deleteTimer(self._at(timer_of))
        if first is None:
            self.state.clear()
        else:
            times = sorted(change)
            self.state.update((count, since, times, [change[t] for t in times]))
            if timer_of != first:
                self.handle.registerTimer(self._at(first))
        if runs:
            yield pd.DataFrame({self.key: pd.Series([key[0]] * len(runs), dtype=object if key[0] is None else None), "first": [r[0] for r in runs], "last": [r[1] for r in runs], "count": [r[2] for r in runs]})

    def _at(self, change: int) -> int:
        return (change + self.width) * 1000 + 1


def sliding_runs(stream: DataFrame, ts: Column, key: str, width_s: int, slide_s: int, delay: str) -> DataFrame:
    """STM-05 with an inverse: counts per sliding window and key, as runs of windows of equal count.

    An event lies in ``width / slide`` windows (300 at 300 s every 1 s). No copy is
    made for them: a bucket of n events, one slide long, adds n to the windows
    from one width before its end on and takes n off again from its end on. The
    state of a key is the running count and the changes that can still be
    joined by others; a row comes out where the count changes. Columns: key,
    ``first_start`` and ``last_start`` (starts of the first and the last window of
    the run), ``count``; windows without events have no row. Windows begin at
    multiples of the slide since the epoch; width is a multiple of slide.
    """
    if width_s % slide_s:
        raise ValueError("the width must be a multiple of the slide")
    rows = stream.withColumn("_et", ts).withWatermark("_et", delay)
    # one row for each slide and key, whatever the number of events
    buckets = rows.groupBy(F.window("_et", f"{slide_s} seconds").alias("b"), F.col(key)).agg(F.count(F.lit(1)).alias("n"))
    buckets = buckets.select(key, F.window_time("b").alias("_bt"), F.unix_seconds("b.start").alias("at"), "n")
    who = stream.schema[key]

    out = StructType([who]).add("first", "long").add("last", "long").add("count", "long")
    # after an aggregation only this kind of keyed state can follow
    got = buckets.groupBy(key).transformWithStateInPandas(Differences(key, width_s, slide_s), out, "Append", "EventTime")
    return got.select(key, F.timestamp_seconds("first").alias("first_start"), F.timestamp_seconds("last").alias("last_start"), "count")
