"""The ledger against the rule applied row by row, with accounts that span partitions."""

import random

import pytest

MOVE = "who string, ts long, id long, kind string, amount double"
IN, OUT = ("in", "gift"), ("out",)


def row_by_row(rows):
    """{id: (applied, balance in cents)}"""
    out, balance = {}, {}
    for who, ts, id_, kind, amount in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1] is not None, r[1] or 0, r[2])):
        if kind not in (*IN, *OUT):
            continue
        b, cents = balance.get(who, 0), None if amount is None else round(amount * 100)
        ok = cents is not None and (kind in IN or b > cents)
        b += (cents if kind in IN else -cents) if ok else 0
        balance[who] = b
        out[id_] = (ok, b)
    return out


def moves(seed, n, accounts, p_out, top):
    rng = random.Random(seed)
    names = [None, *map(str, range(accounts))]
    return [(names[min(rng.randrange(3 * len(names)), len(names) - 1)], rng.randrange(n) if rng.random() < 0.97 else None, i,
             "out" if rng.random() < p_out else rng.choice(["in", "gift", "other", None]), None if rng.random() < 0.03 else rng.randrange(top) / 100) for i in range(n)]


@pytest.mark.parametrize("seed, p_out, top, pieces", [(1, 0.3, 10_000, 1024), (2, 0.7, 2_000, 1024), (3, 0.9, 300, 4), (4, 0.5, 50, 1)])
def test_ledger_of_accounts_over_many_partitions(spark, seed, p_out, top, pieces):
    from kestrel.operators.ledger import ledger

    rows = moves(seed, 1500, 6, p_out, top)
    df = spark.createDataFrame(rows, MOVE).repartition(5)
    got = ledger(df, "who", ["ts", "id"], "kind", "amount", IN, OUT, partitions=13, pieces=pieces).collect()
    assert {r["id"]: (r["applied"], round(r["balance"] * 100)) for r in got} == row_by_row(rows) and len(got) == len(row_by_row(rows))


def test_one_account_fills_all_partitions(spark):
    from pyspark.sql import functions as F

    from kestrel.operators.ledger import ledger

    rows = [("a", t, t, "in" if t % 3 else "out", (t * 37 % 101) / 4) for t in range(2000)]
    out = ledger(spark.createDataFrame(rows, MOVE), "who", ["ts", "id"], "kind", "amount", IN, OUT, partitions=8)
    most = out.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
    assert most < 600  # not one task
    assert {r["id"]: (r["applied"], round(r["balance"] * 100)) for r in out.collect()} == row_by_row(rows)
    assert ledger(spark.createDataFrame([], MOVE), "who", ["ts", "id"], "kind", "amount", IN, OUT).count() == 0


def test_shifts_compose_for_every_opening():
    from kestrel.operators.ledger import Shifts, apply_shifts, fold

    rng = random.Random(5)
    for pieces in (1, 3, 1000):
        for _ in range(40):
            dep = [rng.random() < 0.4 for _ in range(60)]
            cents = [rng.choice([None, rng.randrange(40), -rng.randrange(5)]) for _ in dep]
            s = Shifts(pieces)
            s.move(dep[:25], cents[:25])
            s.move(dep[25:], cents[25:])
            for opening in range(-10, 400, 3):
                balance = opening
                for low, shift in s.lists():
                    balance = apply_shifts(low, shift, balance)
                assert balance == fold(dep, cents, opening)[1][-1]


def test_statement_with_missing_amounts(spark):
    from pyspark.sql import functions as F

    from kestrel.operators.ledger import ledger, monthly_statement

    rows = [("a", 1, 1, "in", 10.0), ("a", 2, 2, "out", None), ("a", 3, 3, "in", None), ("a", 4, 4, "out", 4.0), (None, 5, 5, "out", 1.0)]
    df = spark.createDataFrame(rows, MOVE).withColumn("at", F.timestamp_seconds("ts"))
    led = ledger(df, "who", ["ts", "id"], "kind", "amount", IN, OUT)
    got = {r["who"]: tuple(r)[2:] for r in monthly_statement(led, "who", "at", ["ts", "id"], F.col("kind").isin(*IN), "amount").collect()}
    assert got == {"a": (10.0, 4.0, 1, 6.0), None: (0.0, 0.0, 1, 0.0)}
