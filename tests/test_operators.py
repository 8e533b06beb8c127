"""Unit tests on hand-made rows (FIXTURES part 4) and the quirk borders."""

import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from kestrel.functions.scalars import decrypt_id, encrypt_id, iso_duration_minutes
from kestrel.operators import ledger, matching, recipes, retail, scd, sessions, windows


def test_scd2_worked_example(spark):
    d = dt.date
    dim = spark.createDataFrame([
        (1, "old address", False, d(2018, 2, 1), d(2018, 2, 2)),
        (1, "current address", True, d(2018, 2, 2), None),
        (2, "address two", True, d(2018, 2, 3), None),
        (3, "address three", True, d(2018, 2, 4), None)],
        "customerId int, address string, current boolean, effectiveDate date, endDate date")
    upd = spark.createDataFrame([(1, "new address", d(2018, 3, 3)), (3, "address three", d(2018, 4, 4)),
                                 (4, "new customer", d(2018, 4, 4))],
                                "customerId int, address string, effectiveDate date")
    out = {(r.customerId, r.address): r for r in scd.scd2_merge(dim, upd).collect()}
    assert len(out) == 6
    assert out[(1, "current address")].current is False
    assert out[(1, "current address")].endDate == d(2018, 3, 3)
    assert out[(1, "new address")].current is True and out[(1, "new address")].endDate is None
    assert out[(3, "address three")].current is True and out[(3, "address three")].endDate is None
    assert out[(4, "new customer")].current is True
    assert out[(2, "address two")].current is True
    staged = scd.staged_updates(dim, upd).collect()
    assert sorted((r.mergeKey, r.customerId) for r in staged if r.mergeKey is None) == [(None, 1)]
    assert scd.current_rows_check(scd.scd2_merge(dim, upd)).count() == 0


def test_class_borders(spark):
    df = spark.createDataFrame([(29,), (30,), (60,), (61,)], "total_cooking_time int")
    got = [r[0] for r in df.select(recipes.difficulty()).collect()]
    assert got == ["easy", "medium", "medium", "hard"]


def test_iso_duration_days_and_parts(spark):
    df = spark.createDataFrame([("PT1H30M",), ("P1DT2H",), ("PT45S",), ("PT5M",)], "d string")
    got = [r[0] for r in df.select(iso_duration_minutes("d")).collect()]
    assert got == [5400, 93600, 45, 300]


def test_alliance_sample(spark):
    rows = [("UP", "C1", "SP", 385422), ("UP", "C1", "INC", 84089), ("UP", "C1", "BJP", 400000)]
    df = spark.createDataFrame(rows, "state string, constituency string, party string, votes bigint")
    r = retail.alliance_totals(df, ["SP", "INC"]).collect()[0]
    assert r.ranking == "Ally:469511,BJP:400000"
    assert r.leader == "Ally" and r.total_votes == 869511


def test_session_border(spark):
    t0 = dt.datetime(2024, 1, 1, 0, 0, 0)
    rows = [(1, t0), (1, t0 + dt.timedelta(seconds=1799)), (1, t0 + dt.timedelta(seconds=1799 + 1800)),
            (2, t0 + dt.timedelta(days=1, seconds=-10)), (2, t0 + dt.timedelta(days=1, seconds=5))]
    df = spark.createDataFrame(rows, "user_id bigint, ts timestamp_ntz")
    got = sorted((r.user_id, r.logtime, r.session_id, r.total_activity_time)
                 for r in sessions.assign_sessions(df).collect())
    assert [g[2] for g in got] == ["1_0", "1_0", "1_1", "2_0", "2_0"]
    assert [g[3] for g in got] == [0, 1799, 1800, 0, 15]


def test_pair_sum(spark):
    vals = [10, 7, 8, 8, 6, 8, 9, 9]
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(vals)], "g int, i int, v int")
    got = sorted(r.v for r in retail.pair_sum_members(df, "g", "v", 18).collect())
    assert got == [8, 8, 8, 9, 9, 10]


def test_product_except_self(spark):
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate([1, 2, 3, 4])]
                               + [(2, i, v) for i, v in enumerate([0, 0, -9, 100])], "g int, i int, v int")
    got = {(r.g, r.i): r.product_others for r in windows.product_except_self(df, "g", "v").collect()}
    assert [got[(1, i)] for i in range(4)] == [24, 12, 8, 6]
    assert [got[(2, i)] for i in range(4)] == [0, 0, 0, 0]


def test_suffix_max(spark):
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate([16, 17, 4, 3, 5, 2])], "g int, i int, v int")
    got = [r.next_max for r in windows.suffix_max(df, "g", "i", "v").orderBy("i").collect()]
    assert got == [17, -1, 5, 5, -1, -1]


def test_ledger_refuses_equal_withdrawal(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(1, 1, t, "dep", 100.0), (1, 2, t, "wd", 100.0), (1, 3, t, "wd", 99.0), (1, 4, t, "wd", 5.0),
            (2, 5, t, "wd", 1.0)]
    df = spark.createDataFrame(rows, "acct int, id int, ts timestamp_ntz, kind string, amt double")
    got = [(r.id, r.applied, r.balance) for r in
           ledger.ledger(df, "acct", ["ts", "id"], "kind", "amt", ["dep"], ["wd"], partitions=3).orderBy("id").collect()]
    assert got == [(1, True, 100.0), (2, False, 100.0), (3, True, 1.0), (4, False, 1.0), (5, False, 0.0)]


def test_latest_per_key_tie_break(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 3, "c"), (2, 1, "d")], "k int, t int, v string")
    got = sorted(tuple(r) for r in windows.latest_per_key(df, "k", ["t", "v"]).collect())
    assert got == [(1, 5, "b"), (2, 1, "d")]


def test_standardizer_forms_agree_and_errors_become_rejects(spark):
    rows = [(" 12  Main St ", "nyc", "ny", "10001"), ("   ", "x", "y", "12345"), ("5 Oak Ave", "a", "b", "n/a")]
    src = matching.prepare_input(spark.createDataFrame(rows, "address string, city string, state string, zip string"),
                                 "address", "city", "state", "zip")
    cols = list(matching.STD_FIELDS)
    a = sorted(tuple(r) for r in matching.standardize_columns(src).select("input_street", *cols).collect())
    b = sorted(tuple(r) for r in matching.standardize_batches(src, batch_size=2).select("input_street", *cols).collect())
    assert a == b
    assert ("12  main st", "12 MAIN STREET", None, "10001", "NYC", "NY") in a
    routed = {r.input_street: r.reason for r in matching.route_rejects(matching.standardize_columns(src)).collect()}
    assert routed == {"12  main st": None, "": "NON_STANDARDIZED_ADDRESS", "5 oak ave": "PARTIAL"}

    def broken(_batch: pd.DataFrame) -> pd.DataFrame:
        raise IOError("service down")
    err = matching.route_rejects(matching.standardize_batches(src, broken)).select("reason").distinct().collect()
    assert [r.reason for r in err] == ["STANDARDIZER_ERROR"]


def test_surrogate_keys(spark):
    table = spark.createDataFrame([("a", "x", 1), ("b", "y", 2)], "s string, adv string, segment_id bigint")
    inc = spark.createDataFrame([("b", "y"), ("c", "z"), ("a", "z"), ("c", "z")], "s string, adv string")
    got = sorted(tuple(r) for r in matching.assign_surrogate_keys(inc, table, ["s", "adv"]).collect())
    assert got == [("a", "z", 3, True), ("b", "y", 2, False), ("c", "z", 4, True)]
    empty = spark.createDataFrame([], "s string, adv string, segment_id bigint")
    first = sorted(r.segment_id for r in matching.assign_surrogate_keys(inc, empty, ["s", "adv"]).collect())
    assert first == [1, 2, 3]


def test_cipher_roundtrip(spark):
    df = spark.createDataFrame([("u1",), ("u22",)], "id string")
    key = "0" * 16
    got = df.select(decrypt_id(encrypt_id("id", key), key).alias("d")).collect()
    assert [r.d for r in got] == ["u1", "u22"]


def test_square(spark):
    df = spark.range(1, 5).select((F.col("id") * F.col("id")).alias("sq"))
    assert [r.sq for r in df.collect()][-1] == 16
