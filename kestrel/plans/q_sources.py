"""Source queries (SRC-01 .. SRC-15): each writes a fixture table in the
format under test to the shared folder, then reads it back through the
library's reader with an explicit schema (no inference job)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from kestrel.plans.registry import query
from kestrel.session import scratch_path
from kestrel.sources import readers
from kestrel.sources.tables import Tables

PART_SCHEMA = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
# Text form of a timestamp without zone, to the microsecond (the CSV default keeps milliseconds only).
TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


@query("src_format_scan", "SELECT * FROM part")
def src_format_scan(spark, sf):
    """SRC-01 / SRC-05: format named by a parameter (here json)."""
    path = scratch_path(spark, "part-json")
    Tables(spark, sf).part.write.mode("overwrite").json(path)
    return readers.scan(spark, "json", path, PART_SCHEMA)


@query("src_csv_header", "SELECT * FROM events")
def src_csv_header(spark, sf):
    """SRC-02 / SRC-09: CSV with a header line in every file, typed by schema."""
    path = scratch_path(spark, "events-csv")
    (Tables(spark, sf).events.write.mode("overwrite").option("header", True)
     .option("timestampNTZFormat", TS_TEXT).csv(path))
    return (readers.csv_with_header(spark, path, EVENTS_SCHEMA, options={"timestampNTZFormat": TS_TEXT}))


_SEPS = ((",", "comma"), ("|", "pipe"), ("\t", "tab"))


@query("src_delimited_text", "\nUNION ALL\n".join(
    f"SELECT *, '{name}' AS sep FROM part" for _, name in _SEPS))
def src_delimited_text(spark, sf):
    """SRC-06 / SRC-07 / SRC-08: comma, literal pipe (Q1) and tab separated
    text without header, typed by position."""
    part = Tables(spark, sf).part
    out = None
    for sep, name in _SEPS:
        path = scratch_path(spark, f"part-{name}")
        part.write.mode("overwrite").option("sep", sep).option("header", False).csv(path)
        df = readers.delimited_text(spark, path, PART_SCHEMA, sep).withColumn("sep", F.lit(name))
        out = df if out is None else out.unionByName(df)
    return out


@query("src_sequencefile", "SELECT r_regionkey AS key, r_name AS value FROM region")
def src_sequencefile(spark, sf):
    """SRC-12: (key, value) pairs written as a Hadoop SequenceFile and read back."""
    path = scratch_path(spark, "region-seq")
    (Tables(spark, sf).region.select("r_regionkey", "r_name").rdd
     .map(lambda r: (int(r[0]), str(r[1]))).saveAsSequenceFile(path))
    return readers.sequence_file(spark, path).select(F.col("key").cast("int").alias("key"), "value")


GEN_BASE = dt.datetime(2020, 1, 1)


@query("gen_user_activity", f"""
SELECT CAST(1 + CAST('0x' || substr(h, 1, 7) AS BIGINT) % 250 AS INTEGER) AS user_id,
       TIMESTAMP '{GEN_BASE}' + to_days(CAST(1 + CAST('0x' || substr(h, 8, 7) AS BIGINT) % 301 AS INTEGER)) AS created_at
FROM (SELECT md5(CAST(o_orderkey AS VARCHAR)) AS h FROM orders)
""")
def gen_user_activity(spark, sf):
    """SRC-15 / DAT-07 / MTH-04: one activity row per order: user id in
    1..250 and created_at = base + 1..301 days, both drawn from a hash of the
    order key, so a recomputed task draws the same values."""
    h = F.md5(F.col("o_orderkey").cast("string").cast("binary"))

    def drawn(at: int, below: int):
        return F.conv(F.substring(h, at, 7), 16, 10).cast("bigint") % below + 1

    o = Tables(spark, sf).orders.select("o_orderkey")
    days = drawn(8, 301).cast("int")
    return o.select(
        drawn(1, 250).cast("int").alias("user_id"),
        (F.lit(GEN_BASE).cast("timestamp_ntz") + F.make_interval(F.lit(0), F.lit(0), F.lit(0), days))
        .alias("created_at"))
