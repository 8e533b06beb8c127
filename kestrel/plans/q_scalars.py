"""Projection, filter and scalar-function queries (PRJ, FLT, STR, DAT, ARR, UDF)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from kestrel.functions import scalars as S
from kestrel.functions.udfs import register_cook_minutes
from kestrel.plans.registry import query
from kestrel.sources.tables import Tables


@query("proj_select_alias", """
SELECT c_custkey AS customer_id, c_name AS customer_name, c_acctbal AS balance FROM customer
""")
def proj_select_alias(spark, sf):
    c = Tables(spark, sf).customer
    return c.select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"),
                    F.col("c_acctbal").alias("balance"))


@query("proj_square", """
SELECT p_partkey, p_size, CAST(p_size AS BIGINT) * p_size AS p_size_sq FROM part
""")
def proj_square(spark, sf):
    """PRJ-05 / MTH-05: element-wise square."""
    p = Tables(spark, sf).part
    return p.select("p_partkey", "p_size", (F.col("p_size").cast("bigint") * F.col("p_size")).alias("p_size_sq"))


MONTH_LO = dt.date(1996, 1, 1)
MONTH_HI = dt.date(1996, 1, 31)


@query("flt_between_month", f"""
SELECT * FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '{MONTH_LO}' AND DATE '{MONTH_HI}'
""")
def flt_between_month(spark, sf):
    """FLT-04 + DAT-02: inclusive date range, stated on the raw timestamp so
    that the bounds are pushed into the Parquet scan (row-group pruning)."""
    o = Tables(spark, sf).orders
    lo = dt.datetime.combine(MONTH_LO, dt.time())
    hi = dt.datetime.combine(MONTH_HI + dt.timedelta(days=1), dt.time())
    return o.filter((F.col("o_orderdate") >= F.lit(lo).cast("timestamp_ntz"))
                    & (F.col("o_orderdate") < F.lit(hi).cast("timestamp_ntz")))


@query("str_translate_clean", """
SELECT p_partkey, p_name, translate(p_name, ', !)(''', '') AS clean_name FROM part
""")
def str_translate_clean(spark, sf):
    p = Tables(spark, sf).part
    return p.select("p_partkey", "p_name", S.clean_name("p_name").alias("clean_name"))


@query("str_split_part", """
SELECT s_suppkey, split_part(s_name, '#', 1) AS name_prefix, split_part(s_name, '#', 2) AS name_number,
       CAST(split_part(s_name, '#', 2) AS BIGINT) AS name_id
FROM supplier
""")
def str_split_part(spark, sf):
    """STR-05 + ARR-06: n-th field by split_part and by array position."""
    s = Tables(spark, sf).supplier
    parts = F.split(F.col("s_name"), "#")
    return s.select("s_suppkey", S.nth_part("s_name", "#", 1).alias("name_prefix"),
                    parts.getItem(1).alias("name_number"),
                    parts.getItem(1).cast("bigint").alias("name_id"))


def _log_lines(t: Tables):
    """Combined-format log lines built from events (FIXTURES part 3); every
    tenth line has no ip, which the pattern allows."""
    e = t.events
    ip = F.when(F.col("event_id") % 10 == 0, F.lit("")).otherwise(F.concat_ws(
        ".", F.lit("10"), (F.col("user_id") % 256).cast("string"),
        (F.col("event_id") % 256).cast("string"), F.lit("1")))
    line = F.concat(
        ip, F.lit(" - u"), F.col("user_id").cast("string"), F.lit(" ["),
        F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(" +0000] \"GET /"), F.col("event_type"),
        F.lit(" HTTP/1.1\" "), F.when(F.col("event_type") == "error", "500").otherwise("200"), F.lit(" "),
        F.round(F.col("value") * 100).cast("bigint").cast("string"), F.lit(" \"-\" \"agent/"),
        F.col("user_id").cast("string"), F.lit("\""))
    return e.select("event_id", line.alias("line"))


@query("log_parse_fields", """
SELECT event_id,
       CASE WHEN event_id % 10 = 0 THEN '' ELSE '10.' || CAST(user_id % 256 AS VARCHAR) || '.' || CAST(event_id % 256 AS VARCHAR) || '.1' END AS ip,
       '-' AS client, 'u' || CAST(user_id AS VARCHAR) AS "user",
       strftime(ts, '[%d/%b/%Y:%H:%M:%S +0000]') AS datetime,
       'GET /' || event_type || ' HTTP/1.1' AS request,
       CASE WHEN event_type = 'error' THEN '500' ELSE '200' END AS status,
       CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) AS bytes,
       '-' AS referer, 'agent/' || CAST(user_id AS VARCHAR) AS agent, true AS matched
FROM events
""")
def log_parse_fields(spark, sf):
    """STR-09: parse the nine fields back out of each line with one pattern."""
    lines = _log_lines(Tables(spark, sf))
    return S.parse_log_line(lines.select("event_id", "line"), "line").drop("line")


@query("date_from_epoch_ms", """
SELECT o_orderkey, epoch_ms(o_orderdate) AS order_epoch_ms, CAST(o_orderdate AS DATE) AS order_date FROM orders
""")
def date_from_epoch_ms(spark, sf):
    """DAT-01: epoch milliseconds (derived from the order date) back to a date."""
    o = Tables(spark, sf).orders.select("o_orderkey", F.unix_millis(S.to_ltz("o_orderdate")).alias("order_epoch_ms"))
    return o.withColumn("order_date", S.date_from_epoch_ms("order_epoch_ms"))


@query("date_bounds_from_file_name", """
SELECT DISTINCT strftime(o_orderdate, '%m-%d-%Y') || '.csv' AS file_name,
       CAST(o_orderdate AS DATE) AS file_date,
       CAST(CAST(o_orderdate AS DATE) - INTERVAL 6 DAY AS DATE) AS range_start,
       CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 DAY AS DATE) AS range_end
FROM orders
""")
def date_bounds_from_file_name(spark, sf):
    """DAT-06 + SRC-16 + STR-05: file key -> day (MM-dd-yyyy) -> the
    inclusive slice d-6 .. d+1 the date-range job reads."""
    names = Tables(spark, sf).orders.select(
        F.concat(F.date_format("o_orderdate", "MM-dd-yyyy"), F.lit(".csv")).alias("file_name")).distinct()
    d = F.to_date(S.nth_part("file_name", ".", 1), "MM-dd-yyyy")
    return names.select("file_name", d.alias("file_date"), F.date_sub(d, 6).alias("range_start"),
                        F.date_add(d, 1).alias("range_end"))


def _durations(t: Tables):
    p = t.part
    cook = F.concat(F.lit("P"), (F.col("p_partkey") % 2).cast("string"), F.lit("DT"),
                    (F.col("p_partkey") % 3).cast("string"), F.lit("H"), F.col("p_size").cast("string"), F.lit("M"))
    prep = F.concat(F.lit("PT"), (F.col("p_partkey") % 40).cast("string"), F.lit("M"))
    return p.select("p_partkey", cook.alias("cookTime"), prep.alias("prepTime"))


_DURATION_ORACLE = """
SELECT p_partkey,
       CAST(((p_partkey % 2) * 86400 + (p_partkey % 3) * 3600 + p_size * 60 + (p_partkey % 40) * 60) // 60 AS BIGINT) AS total_minutes,
       CAST(((p_partkey % 3) * 3600 + p_size * 60 + (p_partkey % 40) * 60) // 60 AS BIGINT) AS total_minutes_no_days
FROM part
"""


@query("date_iso_duration_minutes", _DURATION_ORACLE)
def date_iso_duration_minutes(spark, sf):
    """DAT-08 / UDF-01 with native column expressions; ``no_days`` is the
    reference's ``.seconds`` reading (Q19)."""
    d = _durations(Tables(spark, sf))
    total = S.iso_duration_minutes("cookTime") + S.iso_duration_minutes("prepTime")
    no_days = S.iso_duration_minutes("cookTime", False) + S.iso_duration_minutes("prepTime", False)
    return d.select("p_partkey", F.floor(total / 60).cast("bigint").alias("total_minutes"),
                    F.floor(no_days / 60).cast("bigint").alias("total_minutes_no_days"))


@query("udf_registered_sql", """
SELECT p_partkey,
       CAST(((p_partkey % 2) * 86400 + (p_partkey % 3) * 3600 + p_size * 60 + (p_partkey % 40) * 60) // 60 AS BIGINT) AS total_minutes
FROM part
""")
def udf_registered_sql(spark, sf):
    """UDF-06: a vectorised (pandas) UDF registered by name and called from SQL."""
    register_cook_minutes(spark, "total_cook_minutes")
    _durations(Tables(spark, sf)).createOrReplaceTempView("kestrel_recipe_durations")
    return spark.sql("SELECT p_partkey, total_cook_minutes(cookTime, prepTime) AS total_minutes "
                     "FROM kestrel_recipe_durations")


@query("arr_lateral_explode", """
SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos, unnest(embedding) AS x FROM embeddings
""")
def arr_lateral_explode(spark, sf):
    """ARR-02: LATERAL VIEW posexplode over an array column."""
    Tables(spark, sf).embeddings.createOrReplaceTempView("kestrel_embeddings")
    return spark.sql("SELECT vec_id, pos, x FROM kestrel_embeddings LATERAL VIEW posexplode(embedding) t AS pos, x")


@query("arr_inline_structs", """
SELECT l_orderkey, l_linenumber, l_partkey, 'quantity' AS measure, l_quantity AS amount FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'price', l_extendedprice FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'discount', l_discount FROM lineitem
""")
def arr_inline_structs(spark, sf):
    """ARR-03: ``inline`` of an array<struct> column into rows and columns.
    Each row carries a fixed-size array (three measures), so no array grows
    with the data."""
    li = Tables(spark, sf).lineitem
    arr = F.array(*[F.struct(F.lit(n).alias("measure"), F.col(c).alias("amount"))
                    for n, c in (("quantity", "l_quantity"), ("price", "l_extendedprice"), ("discount", "l_discount"))])
    return li.select("l_orderkey", "l_linenumber", "l_partkey", F.inline(arr))
