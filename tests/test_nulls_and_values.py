"""Rows with null keys or order values, exact values of any scale, and writes that leave the session alone."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from kestrel.operators import extracts, sessions, windows
from kestrel.session import scratch_path
from kestrel.sinks import writers
from kestrel.streaming import streams


def rows_of(df, *cols):
    return sorted(map(str, map(tuple, df.select(*cols).collect())))


@pytest.fixture(scope="module")
def cases(spark):
    day = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(60):
        ts = None if i % 11 == 0 else day + dt.timedelta(hours=7 * (i % 17), seconds=i)
        rows.append((i, None if i % 5 == 0 else f"p{i % 3}", None if i % 7 == 0 else i % 2, ts, None if i % 13 == 0 else i * 1.2345))
    return spark.createDataFrame(rows, "id long, place string, user_id long, ts timestamp_ntz, value double")


def test_centered_average_equals_the_plain_window(cases):
    w = Window.partitionBy("place", "user_id").orderBy("ts", "id").rowsBetween(-1, 1)
    v = F.col("value").cast("decimal(28,10)")
    plain = cases.withColumn("value_ma", F.sum(v).over(w).cast("double") / F.count("value").over(w))
    got = windows.centered_moving_avg(cases, ["place", "user_id"], "ts", "id", ["value"])
    a = {r["id"]: r["value_ma"] for r in got.collect()}
    b = {r["id"]: r["value_ma"] for r in plain.collect()}
    assert len(a) == 60 and a == pytest.approx(b)


def test_running_average_equals_the_plain_window(cases):
    w = Window.partitionBy("place").orderBy("ts")
    v = F.col("value").cast("decimal(28,10)")
    plain = cases.withColumn("value_avg", F.sum(v).over(w).cast("double") / F.when(F.count("value").over(w) > 0, F.count("value").over(w)))
    got = windows.running_avg(cases, "place", F.col("ts"), ["value"], F.to_date("ts"))
    a = {r["id"]: r["value_avg"] for r in got.collect()}
    b = {r["id"]: r["value_avg"] for r in plain.collect()}
    assert len(a) == 60 and a == pytest.approx(b)


def test_values_keep_their_decimals(spark):
    df = spark.createDataFrame([("k", 1, 3.333), ("k", 2, 4.0)], "k string, o int, v double")
    assert [r["v_ma"] for r in windows.centered_moving_avg(df, "k", "o", "o", "v", chunk=F.lit(0)).collect()] == [3.6665, 3.6665]
    big = spark.createDataFrame([("k", 1, 10 ** 17), ("k", 2, 10 ** 17)], "k string, o int, v long")
    assert windows.running_avg(big, "k", F.col("o"), "v", F.lit(0)).agg(F.max("v_avg")).first()[0] == 1e17


def test_sessions_equal_the_plain_form(cases):
    cols = ("user_id", "session_id", "logtime", "total_activity_time", "session_active_time", "source_date")
    assert rows_of(sessions.assign_sessions(cases), *cols) == rows_of(sessions.assign_sessions_plain(cases), *cols)


def test_suffix_maximum_and_product_keep_null_groups(spark, cases):
    w = Window.partitionBy("place").orderBy("id").rowsBetween(1, Window.unboundedFollowing)
    later = F.max("value").over(w)
    plain = cases.withColumn("next_max", F.when(later.isNull() | (F.col("value") > later), F.lit(-1)).otherwise(later))
    for chunk in (None, F.floor(F.col("id") / 4)):
        assert rows_of(windows.suffix_max(cases, "place", "id", "value", chunk=chunk), "id", "next_max") == rows_of(plain, "id", "next_max")
    assert windows.group_avg_rows(cases, "place", "value", "a").count() == 60
    df = spark.createDataFrame([("a", i) for i in range(1, 26)] + [(None, 2), (None, 5), ("b", 0), ("b", 0), ("c", 0), ("c", 7)], "g string, v long")
    got = sorted(map(str, map(tuple, windows.product_except_self(df, "g", "v").where("g is null or g <> 'a'").collect())))
    assert got == sorted(map(str, [(None, 2, 5), (None, 5, 2), ("b", 0, 0), ("b", 0, 0), ("c", 0, 7), ("c", 7, 0)]))
    assert {r[0] for r in windows.product_except_self(df, "g", "v").where("g = 'a'").select("product_others").collect()} == {None}


def test_a_long_group_has_a_linear_suffix_maximum(spark):
    df = spark.range(100_000).select(F.lit(1).alias("g"), F.col("id").alias("o"), F.pmod(F.xxhash64("id"), F.lit(10**6)).alias("v"))
    assert windows.suffix_max(df, "g", "o", "v").where("next_max = -1").count() >= 1


def test_upsert_keeps_null_keys_new_runs_and_unwritten_buckets(spark):
    path = scratch_path(spark, "upsert-nulls")
    ev = spark.createDataFrame([(None if i % 4 == 0 else i % 4, i) for i in range(40)], "k long, o long")
    streams.upsert_latest(path, "k", ["o"], buckets=4, run_id="a")(ev, 0)
    streams.upsert_latest(path, "k", ["o"], buckets=4, run_id="a")(ev, 0)
    assert spark.read.parquet(path).agg(F.sum("n_events"), F.count("*")).first()[:] == (40, 4)
    streams.upsert_latest(path, "k", ["o"], buckets=4, run_id="b")(ev, 0)  # a new checkpoint starts its ids anew
    assert spark.read.parquet(path).agg(F.sum("n_events")).first()[0] == 80
    # a crash that left one bucket of batch 1 unwritten: the replay writes that bucket alone
    before = spark.read.parquet(path).select("_bucket").distinct().collect()
    lost = before[0]["_bucket"]
    in_bucket = F.pmod(F.hash(F.col("k")), F.lit(4)) == lost
    streams.upsert_latest(path, "k", ["o"], buckets=4, run_id="b")(ev.where(~in_bucket), 1)
    streams.upsert_latest(path, "k", ["o"], buckets=4, run_id="b")(ev, 1)
    assert spark.read.parquet(path).agg(F.sum("n_events")).first()[0] == 120


def test_only_a_missing_map_is_empty(spark, tmp_path):
    assert extracts.read_hash_map(spark, f"{tmp_path}/none").count() == 0
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0.parquet").write_bytes(b"not parquet at all")
    with pytest.raises(Exception, match="parquet"):
        extracts.read_hash_map(spark, f"{tmp_path}/bad").count()


def test_partition_values_and_session_mode(spark, tmp_path):
    key = "spark.sql.sources.partitionOverwriteMode"
    spark.conf.set(key, "static")
    spark.sql("DROP TABLE IF EXISTS quoted")
    writers.create_partitioned_table(spark, "quoted", "v int, p string", ["p"], f"file://{tmp_path}/quoted")
    for p in ("O'Brien", "back\\slash"):
        for _ in range(2):
            writers.static_partition_overwrite(spark, "quoted", {"p": p}, spark.createDataFrame([(1,), (2,)], "v int"))
    assert {(r["p"], r["n"]) for r in spark.table("quoted").groupBy("p").agg(F.count("*").alias("n")).collect()} == {("O'Brien", 2), ("back\\slash", 2)}
    writers.insert_overwrite(spark.createDataFrame([(5, "O'Brien")], "v int, p string"), "quoted")
    assert spark.table("quoted").count() == 3 and spark.conf.get(key) == "static"
    writers.drop_table(spark, "quoted")
