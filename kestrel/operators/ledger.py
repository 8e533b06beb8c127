"""Account ledger with refused withdrawals (WIN-10) and monthly statements (WIN-11).

Rule: a deposit always adds; a withdrawal is applied only when the balance
before it is strictly greater than the amount, else it is refused and the
balance stays. That is an order-dependent fold with a branch on the running
state, which no window aggregate can express.

Plan. Movements are range-partitioned by (account, order columns), so a large
account spreads over as many tasks as its rows need, and sorted; the sorted
partitions are checkpointed in the shared folder. An account that starts in a
partition opens with 0 there. Only a partition's first account may go on from
the partition before, and for it the partition states what it does to *any*
opening balance: a list of borders and, between two of them, one shift
(:class:`Shifts`). Withdrawals cut borders, deposits move them, shifts compose; a
list of over ``PIECES`` is closed and another one begun, so a summary is a
sequence of short lists. One streamed pass over the summaries (a few rows a
partition) gives every partition its opening balance, and a second pass over the
checkpointed partitions writes the balances.

Amounts are handled as integer cents, so the comparison and the balance
are exact; the output converts back to a 2-decimal double.

Defined cases: a movement without an amount changes nothing and is not applied;
a null account is an account like any other; null order values come first; rows
of another or no kind are no movements.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StructField, StructType

from kestrel.session import shared_dir

#: Pieces of one list of shifts.
PIECES = 1024
_LEAST = -(1 << 62)


def fold(deposit: list[bool], cents: list[int | None], balance: int) -> tuple[list[bool], list[int]]:
    """(applied, balance after) of movements in order, from an opening balance."""
    applied, after = [], []
    for dep, amount in zip(deposit, cents, strict=True):
        ok = amount is not None and (dep or balance > amount)
        if ok:
            balance += amount if dep else -amount
        applied.append(ok)
        after.append(balance)
    return applied, after


class Shifts:
    """What movements do to any opening balance: from ``low[i]`` on it is shifted by ``shift[i]``.

    ``closed`` holds the lists that got too long, in order; the open one comes last.
    """

    def __init__(self, pieces: int = PIECES):
        self.pieces, self.closed = pieces, []
        self.low, self.shift = [_LEAST], [0]

    def move(self, deposit: list[bool], cents: list[int | None]) -> None:
        added = 0  # deposits not yet in the shifts
        for dep, amount in zip(deposit, cents, strict=True):
            if amount is None:
                continue
            if dep:
                added += amount
                continue
            low, shift = [], []
            ends = [*self.low[1:], None]
            for at, end, old in zip(self.low, ends, self.shift, strict=True):
                border = amount - (old + added) + 1  # the least opening that the withdrawal applies to
                if border > at:
                    if not shift or shift[-1] != old:
                        low.append(at)
                        shift.append(old)
                    if end is not None and border >= end:
                        continue
                    at = border
                if not shift or shift[-1] != old - amount:
                    low.append(at)
                    shift.append(old - amount)
            self.low, self.shift = low, shift
            if len(low) > self.pieces:
                self._close(added)
                added = 0
        self.shift = [s + added for s in self.shift]

    def _close(self, added: int) -> None:
        self.closed.append((self.low, [s + added for s in self.shift]))
        self.low, self.shift = [_LEAST], [0]

    def lists(self) -> list[tuple[list[int], list[int]]]:
        return [*self.closed, (self.low, self.shift)]


def apply_shifts(low: Sequence[int], shift: Sequence[int], balance: int) -> int:
    return balance + int(shift[bisect_right(low, balance) - 1])


def _runs(accounts: list) -> Iterator[tuple[int, int]]:
    """(from, to) of each run of one account."""
    start = 0
    for i in range(1, len(accounts) + 1):
        if i == len(accounts) or accounts[i] != accounts[start]:
            yield start, i
            start = i


def _summaries(account: str, pieces: int):
    """Rows (account, part, seq, low, shift) of a sorted partition: its first account's lists, and the closing balance of
    its last account as a list without borders, if that is another one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, last, shifts, balance, kind = [], [], Shifts(pieces), 0, None
        for batch in batches:
            kind = batch.column(account).type
            accounts, dep, cents = (batch.column(c).to_pylist() for c in (account, "_dep", "_cents"))
            for a, b in _runs(accounts):
                if not first:
                    first = [accounts[a]]
                if not last and accounts[a] == first[0]:
                    shifts.move(dep[a:b], cents[a:b])
                else:
                    if last != [accounts[a]]:
                        last, balance = [accounts[a]], 0
                    balance = fold(dep[a:b], cents[a:b], balance)[1][-1]
        if first:
            rows = [(first[0], i, low, shift) for i, (low, shift) in enumerate(shifts.lists())]
            rows += [(last[0], 0, [], [balance])] if last else []
            part = TaskContext.get().partitionId()
            yield pa.record_batch([pa.array([r[0] for r in rows], kind), pa.array([part] * len(rows), pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
                                   pa.array([r[2] for r in rows], pa.list_(pa.int64())), pa.array([r[3] for r in rows], pa.list_(pa.int64()))],
                                  names=[account, "_part", "_seq", "_low", "_shift"])

    return run


def _openings(account: str):
    """(part, opening balance of its first account) from summaries sorted by (account, part, seq)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, balance = [], 0
        for batch in batches:
            parts, opened = [], []
            for who, part, seq, low, shift in zip(*(batch.column(c).to_pylist() for c in (account, "_part", "_seq", "_low", "_shift")), strict=True):
                if current != [who]:
                    current, balance = [who], 0
                if not low:
                    balance = shift[0]
                    continue
                if seq == 0:
                    parts.append(part)
                    opened.append(balance)
                balance = apply_shifts(low, shift, balance)
            yield pa.record_batch([pa.array(parts, pa.int32()), pa.array(opened, pa.int64())], names=["part", "opening"])

    return run


def _balances(account: str, opening: dict[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, balance = None, opening.get(TaskContext.get().partitionId(), 0)
        for batch in batches:
            accounts, dep, cents = (batch.column(c).to_pylist() for c in (account, "_dep", "_cents"))
            applied, after = [], []
            for a, b in _runs(accounts):
                if current is not None and current != [accounts[a]]:
                    balance = 0
                current = [accounts[a]]
                ok, left = fold(dep[a:b], cents[a:b], balance)
                balance = left[-1]
                applied += ok
                after += left
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(applied, pa.bool_()), pa.array(after, pa.int64())], names=[*batch.schema.names, "_applied", "_bal"])

    return run


def ledger(df: DataFrame, account: str, order_cols: Sequence[str], kind: str, amount: str,
           deposit_kinds: Sequence[str], withdrawal_kinds: Sequence[str],
           partitions: int | None = None, pieces: int = PIECES) -> DataFrame:
    """One row per movement: the input columns kept, plus ``applied`` and the
    ``balance`` after the movement. ``order_cols`` must order an account's
    movements totally (end with a unique column).
    """
    order = [account, *order_cols]
    spark = df.sparkSession
    mv = (df.filter(F.col(kind).isin(*deposit_kinds, *withdrawal_kinds))
          .withColumn("_dep", F.col(kind).isin(*deposit_kinds))
          .withColumn("_cents", in_cents(df, amount)))
    ordered = mv.repartitionByRange(partitions, *order) if partitions else mv.repartitionByRange(*order)
    shared_dir(spark)
    # both passes must see the same partitions; a checkpoint keeps them and their order
    ordered = ordered.sortWithinPartitions(*order).checkpoint()
    who = mv.schema[account]
    lists = ArrayType(LongType())
    summary = StructType([who, StructField("_part", IntegerType()), StructField("_seq", IntegerType()), StructField("_low", lists), StructField("_shift", lists)])
    sums = ordered.select(account, "_dep", "_cents").mapInArrow(_summaries(account, pieces), summary)
    sums = sums.repartition(account).sortWithinPartitions(account, "_part", "_seq")
    # one row for each partition
    opening = {r["part"]: r["opening"] for r in sums.mapInArrow(_openings(account), "part int, opening long").collect()}
    schema = StructType([*mv.schema.fields, StructField("_applied", BooleanType()), StructField("_bal", LongType())])
    out = ordered.mapInArrow(_balances(account, opening), schema)
    return (out.withColumn("applied", F.col("_applied"))
            .withColumn("balance", (F.col("_bal").cast("double") / 100))
            .drop("_dep", "_cents", "_applied", "_bal"))


def in_cents(df: DataFrame, amount: str) -> Column:
    """The amount in whole cents; NaN is no amount."""
    known = F.nanvl(F.col(amount), F.lit(None)) if df.schema[amount].dataType.typeName() in ("double", "float") else F.col(amount)
    return F.round(known * 100).cast("bigint")


def monthly_statement(ledger_rows: DataFrame, account: str, ts: str, order_cols: Sequence[str],
                      kind_is_deposit, amount: str) -> DataFrame:
    """WIN-11: per (account, month): applied deposits, applied withdrawals,
    refused withdrawals and the closing balance (balance after the month's
    last movement). One map-side combined aggregate; ``max_by`` picks the
    last movement without a window. A deposit without an amount adds 0, a
    withdrawal without one counts as refused."""
    cents = F.coalesce(in_cents(ledger_rows, amount), F.lit(0))
    last = F.struct(*[F.col(c) for c in order_cols])
    g = (ledger_rows.withColumn("month", F.date_trunc("month", F.col(ts)).cast("date"))
         .groupBy(account, "month")
         .agg(F.sum(F.when(kind_is_deposit, cents).otherwise(0)).alias("_dep"),
              F.sum(F.when(~kind_is_deposit & F.col("applied"), cents).otherwise(0)).alias("_wd"),
              F.sum((~kind_is_deposit & ~F.col("applied")).cast("bigint")).alias("refused_count"),
              F.max_by("balance", last).alias("closing_balance")))
    return g.select(account, "month", (F.col("_dep").cast("double") / 100).alias("deposits"),
                    (F.col("_wd").cast("double") / 100).alias("withdrawals"),
                    F.col("refused_count").cast("bigint").alias("refused_count"), "closing_balance")
