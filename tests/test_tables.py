"""Newest partition from the catalogue, and inserts that keep a bucketed layout."""

import uuid

import pytest
from pyspark.sql import functions as F

from kestrel.operators import retail
from kestrel.plans import q_sinks
from kestrel.sinks import writers
from tests.settings import SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def table(spark):
    name = f"t_{uuid.uuid4().hex[:10]}"
    yield name
    writers.drop_table(spark, name)


def test_newest_partition_is_the_only_one_listed(spark, table, tmp_path):
    writers.create_partitioned_table(spark, table, "id long, day date, kind string", ["day", "kind"], str(tmp_path / "t"))
    assert retail.latest_stored_partition(spark, table, "day").count() == 0
    rows = spark.range(100).select("id", F.when(F.col("id") < 90, F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 9).cast("int"))).alias("day"), F.lit("a+b c/d").alias("kind"))
    writers.insert_overwrite(rows, table)
    got = retail.latest_stored_partition(spark, table, "day")
    assert sorted(r.id for r in got.collect()) == [i for i in range(90) if i % 9 == 8]
    assert "PartitionFilters" in plan(got) and all("day=2024-01-09" in r[0] for r in got.select(F.input_file_name()).collect())
    assert {r.kind for r in retail.latest_stored_partition(spark, table, "kind").collect()} == {"a+b c/d"}
    # the newest day emptied: the one before it
    spark.sql(f"ALTER TABLE {table} DROP PARTITION (day = DATE '2024-01-09', kind = 'a+b c/d')")
    assert {str(r.day) for r in retail.latest_stored_partition(spark, table, "day").collect()} == {"2024-01-08"}


def test_latest_day_is_counted_behind_a_pushed_bound(spark):
    o = spark.read.parquet(f"{SMALL}/orders.parquet")
    got = retail.latest_partition(o, "o_orderdate")
    assert "GreaterThanOrEqual(o_orderdate" in got._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    want = o.groupBy(F.to_date("o_orderdate").alias("d")).count().orderBy(F.desc("d")).first()
    assert tuple(got.first()) == tuple(want)
    assert retail.latest_partition(o.limit(0), "o_orderdate").count() == 0
    assert retail.latest_partition(o.withColumn("o_orderdate", F.lit(None).cast("date")), "o_orderdate").count() == 0


def test_two_inserts_keep_the_bucketed_join_without_exchange(spark, table, tmp_path):
    other = f"{table}_o"
    a = spark.range(1000).select("id", (F.col("id") % 3).cast("string").alias("s"), F.lit(1).alias("x"))
    try:
        for name in (table, other):
            assert writers.bucketed_table(a.where("id < 300"), name, str(tmp_path / name), "s", "id", 8) == 8
        for name in (table, other):
            writers.append_bucketed(a.where("id between 300 and 599").select("x", "s", "id"), name)
            writers.append_bucketed(a.where("id >= 600"), name)
        per_bucket = spark.table(table).select(F.input_file_name().alias("f")).distinct().count()
        assert per_bucket <= 3 * 8 * 3  # one file for each load, bucket and partition
        j = spark.table(table).join(spark.table(other).select("id", F.col("x").alias("y")), "id")
        agg = j.groupBy("id").agg(F.sum("x").alias("n"))
        before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            assert "Exchange" not in plan(agg) and agg.count() == 1000 and agg.agg(F.sum("n")).first()[0] == 1000
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    finally:
        writers.drop_table(spark, other)


def test_bucket_count_grows_with_the_rows(spark):
    assert [writers.bucket_count(spark.range(n), 4, 100) for n in (0, 400, 401, 1600, 2500)] == [4, 4, 8, 16, 32]
    assert "Exchange" not in plan(q_sinks.sink_bucketed(spark, SMALL))
