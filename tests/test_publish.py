"""Publishes that split, stable ids, keyless rows, standardiser failures."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from kestrel.operators import matching, scd
from kestrel.plans import q_match
from kestrel.sinks import writers
from kestrel.sources.tables import Tables

from tests.settings import SMALL


def test_a_hot_partition_has_several_writers(spark, tmp_path):
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(0, 60000, 1, 8).select("id", F.lit("hot").alias("day"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
        path = str(tmp_path / "hot")
        writers.dynamic_partition_overwrite(rows, path, ["day"])
        out = spark.read.parquet(path)
        assert out.count() == 60000 and out.select("id").distinct().count() == 60000
        assert out.select(F.input_file_name()).distinct().count() > 1
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_a_second_publish_keeps_all_ids(spark):
    t = Tables(spark, SMALL)
    table = q_match.publish_gold(spark, t)
    columns = ["segment_id", "uhid", "nu_uhid", "hash_ip_addr", "file_name", "segment_name", "advertiser_name"]
    first = sorted(map(tuple, spark.table(table).select(*columns).collect()))
    assert first
    q_match.publish_gold(spark, t, table)
    assert sorted(map(tuple, spark.table(table).select(*columns).collect())) == first
    assert spark.table(table).where("dtm_created is null").count() == 0
    writers.drop_table(spark, table)


def test_misses_have_no_key_until_the_end(spark):
    uhids = spark.createDataFrame([("s", "a", "f", u) for u in ("u1", "u2", "u3", "u4")], "segment_name string, advertiser_name string, file_name string, uhid string")
    nu = spark.createDataFrame([("n1", "u1"), ("n2", "u2")], "nu_uhid string, uhid string")
    # a customer whose id is the default itself is no partner of those that have none
    inward = spark.createDataFrame([("n1", "Y"), ("n2", "N"), ("0", "Y")], "custid string, dsp_flag string")
    ap = spark.createDataFrame([("c1", "u1"), ("c3", "u3")], "cuhid string, uhid string")
    isp = spark.createDataFrame([("c1", "10.0.0.1", dt.date(2024, 1, 1)), ("c1", "10.0.0.2", dt.date(2024, 1, 2)), ("0", "10.9.9.9", dt.date(2024, 1, 1))],
                                "cuhid string, ip_addr string, dtm_last_modified date")
    got = matching.identity_chain(uhids, nu, inward, ap, isp).select("uhid", "nu_uhid", "cuhid", "ip_addr").collect()
    assert sorted(map(tuple, got)) == [("u1", "n1", "c1", "10.0.0.2"), ("u2", "0", "0", "0"), ("u3", "0", "c3", "0"), ("u4", "0", "0", "0")]


@pytest.mark.parametrize("reply", [lambda b: matching.rules_standardizer(b).iloc[:-1], lambda b: 1 / 0])
def test_a_failed_or_short_reply_makes_rejects(spark, reply):
    rows = spark.createDataFrame([("1 Elm St", "", "12345", "x", "y")] * 3, ", ".join(f"{c} string" for c in matching.INPUT_FIELDS))
    got = matching.route_rejects(matching.standardize_batches(rows, reply)).select("reason").collect()
    assert [r.reason for r in got] == [matching.REASON_STANDARDIZER_ERROR] * 3


def test_scd2_merge_null_keys_and_values(spark):
    day = dt.date
    dim = spark.createDataFrame([(1, "a", True, day(2020, 1, 1), None, 7), (2, None, True, day(2020, 1, 1), None, 8),
                                 (3, "c", False, day(2020, 1, 1), day(2021, 1, 1), 9), (None, "n", True, day(2020, 1, 1), None, 1)],
                                "customerId int, address string, current boolean, effectiveDate date, endDate date, extra int")
    upd = spark.createDataFrame([(1, "b", day(2022, 1, 1)), (2, "x", day(2022, 1, 1)), (3, "z", day(2022, 1, 1)), (None, "m", day(2022, 1, 1))],
                                "customerId int, address string, effectiveDate date")
    key = lambda r: tuple((v is None, str(v)) for v in r)
    got = sorted(map(tuple, scd.scd2_merge(dim, upd).select("customerId", "address", "current", "endDate", "extra").collect()), key=key)
    assert got == sorted([(1, "a", False, day(2022, 1, 1), 7), (1, "b", True, None, None), (2, None, True, None, 8),
                          (3, "c", False, day(2021, 1, 1), 9), (None, "n", True, None, 1), (None, "m", True, None, None)], key=key)
    safe = scd.scd2_merge(dim, upd, null_safe=True)
    assert safe.where("customerId = 2").count() == 2


class Counting:
    """A standardiser that notes each address it is sent, in a file of its own for each call."""

    def __init__(self, folder, fail=()):
        self.folder, self.fail = folder, fail

    def __call__(self, batch):
        import uuid

        with open(f"{self.folder}/{uuid.uuid4().hex}", "w") as f:
            f.write("\n".join(batch["input_street"]))
        if set(self.fail) & set(batch["input_street"]):
            raise OSError("no answer")
        return matching.rules_standardizer(batch)

    def sent(self):
        import os

        return [open(f"{self.folder}/{f}").read().split("\n") for f in os.listdir(self.folder)]


def test_the_lookup_sends_each_address_once_over_two_runs(spark, tmp_path):
    log, store = tmp_path / "log", str(tmp_path / "store")
    log.mkdir()
    ask = Counting(str(log))
    fields = ", ".join(f"{c} string" for c in matching.INPUT_FIELDS)
    rows = [(f"{i % 250} elm st", "", "12345", "x", None if i % 250 == 7 else "y") for i in range(2000)] + [("", "", "", "", "")] * 900
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], f"{fields}, id long").repartition(7)
    plain = sorted(map(str, matching.standardize_batches(df).collect()))
    first = matching.standardize_lookup(df.where("id % 250 < 100"), store, ask, 30)
    assert first.count() == first.select("id").distinct().count() == df.where("id % 250 < 100").count()
    both = matching.standardize_lookup(df, store, ask, 30)
    assert sorted(map(str, both.collect())) == plain
    sent = [a for call in ask.sent() for a in call]
    assert sorted(sent) == sorted({r[0] for r in rows})
    matching.standardize_lookup(df, store, ask, 30).count()
    assert len([a for call in ask.sent() for a in call]) == len(sent)


def test_failed_calls_are_sent_again(spark, tmp_path):
    log, store = tmp_path / "log", str(tmp_path / "store")
    log.mkdir()
    fields = ", ".join(f"{c} string" for c in matching.INPUT_FIELDS)
    df = spark.createDataFrame([(f"{i} elm st", "", "12345", "x", "y") for i in range(40)], fields).coalesce(1)
    bad = matching.standardize_lookup(df, store, Counting(str(log), ["3 elm st"]), 1000)
    assert {r["std_error"] for r in bad.collect()} == {matching.REASON_STANDARDIZER_ERROR}
    good = matching.standardize_lookup(df, store, Counting(str(log)), 1000)
    assert {r["std_error"] for r in good.collect()} == {None} and good.count() == 40
    assert len([a for call in Counting(str(log)).sent() for a in call]) == 80


def test_calls_are_filled_across_batches():
    import pandas as pd

    parts = [pd.DataFrame({"x": range(a, b)}) for a, b in ((0, 7), (7, 8), (8, 8), (8, 31), (31, 35))]
    calls = [c["x"].tolist() for c in matching._calls(iter(parts), 10)]
    assert [len(c) for c in calls] == [10, 10, 10, 5] and sum(calls, []) == list(range(35))
    assert list(matching._calls(iter([]), 10)) == []


def test_a_scope_leaves_nothing_behind(spark):
    import os

    from kestrel.session import Scope

    jsc = spark.sparkContext._jsc
    before = set(jsc.getPersistentRDDs().keySet())
    with pytest.raises(KeyError):
        with Scope(spark) as scope:
            a = scope.persist(spark.range(50))
            b = scope.written(a.selectExpr("id * 2 as id"))
            assert a.count() == b.count() == 50 and set(jsc.getPersistentRDDs().keySet()) != before
            folder = scope.folder.removeprefix("file:")
            assert os.path.isdir(folder)
            raise KeyError
    assert set(jsc.getPersistentRDDs().keySet()) == before and not os.path.exists(folder)


def test_extracts_bear_the_names_of_their_files(spark):
    from kestrel.plans.registry import QUERIES

    before = set(spark.sparkContext._jsc.getPersistentRDDs().keySet())
    out = QUERIES["extract_all"](spark, SMALL)
    names = {r[0] for r in out.select("extract").distinct().collect()}
    assert set(spark.sparkContext._jsc.getPersistentRDDs().keySet()) == before
    files = {n for n in names if not n.startswith(("uh_", "ip_"))}
    assert files and names >= {f"uh_{n}" for n in files} and any(n.startswith("ip_") for n in names)
    one = {k: sorted(r[0] for r in QUERIES[q](spark, SMALL).select(c).collect()) for k, q, c in (("nu", "extract_partner_ids", "nu_uhid"), ("uh", "extract_ids", "uhid"), ("ip", "extract_unhash_ip", "unhash_ip_addr"))}
    for kind, begin in (("uh", "uh_"), ("ip", "ip_")):
        assert sorted(r["value"] for r in out.where(F.col("extract").startswith(begin)).collect()) == one[kind]
    assert sorted(r["value"] for r in out.where(~F.col("extract").rlike("^(uh|ip)_")).collect()) == one["nu"]
