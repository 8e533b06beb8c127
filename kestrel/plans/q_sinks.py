"""Sink and table-maintenance queries (SNK-*, TBL-*). Each writes to a fresh
location below the shared folder and returns what a reader sees there."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from kestrel.operators import retail
from kestrel.plans.registry import query
from kestrel.session import scratch_path
from kestrel.sinks import writers
from kestrel.sinks.writers import SinkConfig
from kestrel.sources import readers
from kestrel.sources.tables import Tables

ORDERS_SCHEMA = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
                 "o_orderdate timestamp_ntz, o_orderpriority string")
TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


@query("sink_config_write", "SELECT * FROM orders")
def sink_config_write(spark, sf):
    """SNK-01 (+Q2): CSV with header, two partition columns, as many write tasks
    as the rows need; read back by schema."""
    path = scratch_path(spark, "orders-cfg")
    conf = SinkConfig(path, "csv", "overwrite", ["o_orderstatus", "o_orderpriority"], options={"timestampNTZFormat": TS_TEXT})
    writers.write(Tables(spark, sf).orders, conf)
    return readers.csv_with_header(spark, path, ORDERS_SCHEMA, options={"timestampNTZFormat": TS_TEXT})


@query("sink_dynamic_overwrite", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m') AS order_month
FROM orders WHERE year(o_orderdate) <> 1995 OR o_orderstatus = 'F'""")
def sink_dynamic_overwrite(spark, sf):
    """SNK-02 / SNK-03 / TBL-03 / PRT-03: a month-partitioned table is
    loaded, then the 1995 months are re-delivered holding only their F
    orders; dynamic overwrite replaces exactly those months."""
    o = Tables(spark, sf).orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                        F.date_format("o_orderdate", "yyyy-MM").alias("order_month"))
    path = scratch_path(spark, "orders-by-month")
    table = _name("orders_by_month")
    writers.create_partitioned_table(spark, table, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
                                     "o_totalprice double, order_month string", ["order_month"], path)
    writers.insert_overwrite(o, table)
    redelivered = o.filter(F.col("order_month").startswith("1995") & (F.col("o_orderstatus") == "F"))
    writers.insert_overwrite(redelivered, table)
    return spark.table(table)


@query("sink_static_partition_overwrite", """
SELECT o_orderkey, o_custkey,
       CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN o_totalprice * 2 ELSE o_totalprice END
         AS o_totalprice,
       o_orderstatus, o_orderpriority
FROM orders""")
def sink_static_partition_overwrite(spark, sf):
    """SNK-04 / PIP-11: publish one (status, priority) partition with new
    values, twice; the second run replaces the first (idempotent)."""
    o = Tables(spark, sf).orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus",
                                        "o_orderpriority")
    table = _name("orders_gold")
    writers.create_partitioned_table(spark, table, "o_orderkey bigint, o_custkey bigint, o_totalprice double, "
                                     "o_orderstatus string, o_orderpriority string",
                                     ["o_orderstatus", "o_orderpriority"], scratch_path(spark, "orders-gold"))
    writers.insert_overwrite(o, table)
    spec = {"o_orderstatus": "F", "o_orderpriority": "1-URGENT"}
    part = (o.filter((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT"))
            .withColumn("o_totalprice", F.col("o_totalprice") * 2))
    for _ in range(2):
        writers.static_partition_overwrite(spark, table, spec, part)
    return spark.table(table)


@query("sink_bucketed", """
SELECT o.o_orderkey, o.o_orderstatus, CAST(count(*) AS BIGINT) AS line_count,
       CAST(sum(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey GROUP BY 1, 2""")
def sink_bucketed(spark, sf):
    """TBL-02 / SNK-06: orders partitioned by status and bucketed by key,
    lineitem bucketed the same way, as many buckets as the larger one needs; one
    half of each is loaded, the other inserted in two goes. Their join and the
    aggregation by order key read matching buckets without an exchange."""
    t = Tables(spark, sf)
    ot, lt = _name("orders_b"), _name("lineitem_b")
    orders = t.orders.select("o_orderkey", "o_orderstatus")
    lines = t.lineitem.select("l_orderkey", "l_extendedprice", "l_returnflag")
    n = writers.bucket_count(lines)
    for df, name, place, part, key in ((orders, ot, "orders-b", "o_orderstatus", "o_orderkey"), (lines, lt, "lineitem-b", "l_returnflag", "l_orderkey")):
        writers.bucketed_table(df.where(F.col(key) % 2 == 0), name, scratch_path(spark, place), part, key, n)
        for rest in (1, 3):
            writers.append_bucketed(df.where(F.col(key) % 4 == rest), name)
    o, li = spark.table(ot), spark.table(lt)
    j = o.join(li, o.o_orderkey == li.l_orderkey)
    return j.groupBy("o_orderkey", "o_orderstatus").agg(
        F.count(F.lit(1)).cast("bigint").alias("line_count"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("revenue"))


@query("latest_stored_partition", """
SELECT o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y-%m') AS order_month FROM orders
WHERE strftime(o_orderdate, '%Y-%m') = (SELECT max(strftime(o_orderdate, '%Y-%m')) FROM orders)""")
def latest_stored_partition(spark, sf):
    """AGG-05 / SRT-05: the newest month of a table partitioned by month, found in
    the catalogue; the scan lists that one partition."""
    o = Tables(spark, sf).orders.select("o_orderkey", "o_orderstatus", F.date_format("o_orderdate", "yyyy-MM").alias("order_month"))
    table = _name("orders_monthly")
    writers.create_partitioned_table(spark, table, "o_orderkey bigint, o_orderstatus string, order_month string", ["order_month"], scratch_path(spark, "orders-monthly"))
    writers.insert_overwrite(o, table)
    return retail.latest_stored_partition(spark, table, "order_month")


_CODECS = (("parquet", "gzip"), ("orc", "snappy"), ("parquet", "zstd"))


@query("sink_codec_roundtrip", "\nUNION ALL\n".join(
    f"SELECT *, '{fmt}/{codec}' AS codec FROM orders" for fmt, codec in _CODECS))
def sink_codec_roundtrip(spark, sf):
    """SNK-11 / SNK-12: compression codec as a writer option (Avro is not on
    this machine's classpath; the writer takes any format name)."""
    o = Tables(spark, sf).orders
    out = None
    for fmt, codec in _CODECS:
        path = scratch_path(spark, f"orders-{fmt}-{codec}")
        writers.write(o, SinkConfig(path, fmt, "overwrite", options={"compression": codec}))
        df = readers.scan(spark, fmt, path, ORDERS_SCHEMA).withColumn("codec", F.lit(f"{fmt}/{codec}"))
        out = df if out is None else out.unionByName(df)
    return out


@query("sink_text_lines", """
SELECT CAST(n_nationkey AS VARCHAR) || ',' || n_name || ',' || CAST(n_regionkey AS VARCHAR) AS value FROM nation""")
def sink_text_lines(spark, sf):
    """SNK-13: rows as comma-joined text lines."""
    path = writers.text_lines(Tables(spark, sf).nation, scratch_path(spark, "nation-text"))
    return spark.read.text(path)


@query("sink_single_file", "SELECT n_nationkey, n_name FROM nation")
def sink_single_file(spark, sf):
    """PRT-02 / SNK-09: a small extract as one headerless gzip file."""
    n = Tables(spark, sf).nation.select("n_nationkey", "n_name")
    path = writers.extract_csv(n, scratch_path(spark, "extract"), "nations", files=1)
    return readers.delimited_text(spark, path, n.schema, ",")


@query("sink_path_overwrite", """
SELECT o_orderkey, o_totalprice * CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 1 END AS o_totalprice, o_orderstatus FROM orders""")
def sink_path_overwrite(spark, sf):
    """SNK-02: files by status; the F partition alone is delivered again."""
    o = Tables(spark, sf).orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    path = scratch_path(spark, "orders-by-status")
    writers.dynamic_partition_overwrite(o, path, ["o_orderstatus"])
    again = o.where("o_orderstatus = 'F'").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    writers.dynamic_partition_overwrite(again, path, ["o_orderstatus"])
    return spark.read.schema(o.schema).parquet(path)


@query("tbl_partition_ddl", """
SELECT DISTINCT 'o_orderstatus=' || o_orderstatus AS partition FROM orders WHERE o_orderstatus <> 'P'
UNION ALL SELECT 'o_orderstatus=X'""")
def tbl_partition_ddl(spark, sf):
    """TBL-03 / TBL-04 / TBL-05: drop and create a partitioned table, load it, add an
    empty partition, drop one, list the partitions (a catalog command)."""
    o = Tables(spark, sf).orders.select("o_orderkey", "o_orderstatus")
    table = _name("orders_parts")
    path = scratch_path(spark, "orders-parts")
    writers.drop_table(spark, table)
    writers.create_partitioned_table(spark, table, "o_orderkey bigint, o_orderstatus string", ["o_orderstatus"], path)
    writers.insert_overwrite(o, table)
    spark.sql(f"ALTER TABLE {table} ADD PARTITION (o_orderstatus = 'X')")
    spark.sql(f"ALTER TABLE {table} DROP PARTITION (o_orderstatus = 'P')")
    return spark.sql(f"SHOW PARTITIONS {table}")
