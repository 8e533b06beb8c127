"""Data-quality checks (TBL-01, PIP-17) and the arrival gate (AGG-18)."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.operators import quality
from kestrel.plans.registry import query
from kestrel.sources.tables import Tables


@query("gate_file_count", """
WITH days AS (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events)
SELECT f.d AS file_day, CAST(count(*) AS BIGINT) AS days_present, count(*) >= 7 AS gate_open
FROM days f JOIN days x ON x.d BETWEEN f.d - INTERVAL 6 DAY AND f.d + INTERVAL 1 DAY
GROUP BY f.d
""")
def gate_file_count(spark, sf):
    """AGG-18 re-aimed (Q11, Q12): for each day with data, whether at least
    7 days of its window d-6 .. d+1 hold data."""
    return quality.days_present_gate(Tables(spark, sf).events, "ts", before=6, after=1, need=7)


_UNIQUE_SQL = """
SELECT '{t}' AS table_name, CAST(sum(n) AS BIGINT) AS total_rows, CAST(count(*) AS BIGINT) AS distinct_keys,
       CAST(sum(CASE WHEN n > 1 THEN 1 ELSE 0 END) AS BIGINT) AS duplicated_keys,
       CAST(sum(CASE WHEN {nulls} THEN n ELSE 0 END) AS BIGINT) AS null_key_rows,
       sum(CASE WHEN n > 1 THEN 1 ELSE 0 END) = 0 AND sum(CASE WHEN {nulls} THEN n ELSE 0 END) = 0 AS passed
FROM (SELECT {keys}, count(*) AS n FROM {t} GROUP BY {keys})"""


@query("dq_unique_key", _UNIQUE_SQL.format(t="orders", keys="o_orderkey", nulls="o_orderkey IS NULL")
       + "\nUNION ALL" + _UNIQUE_SQL.format(t="lineitem", keys="l_orderkey, l_linenumber",
                                          nulls="l_orderkey IS NULL OR l_linenumber IS NULL"))
def dq_unique_key(spark, sf):
    """TBL-01 as a check: orders passes on o_orderkey; lineitem fails on
    (l_orderkey, l_linenumber), which is not unique in the fixtures."""
    t = Tables(spark, sf)
    return (quality.unique_key_check(t.orders, ["o_orderkey"], "orders")
            .unionByName(quality.unique_key_check(t.lineitem, ["l_orderkey", "l_linenumber"], "lineitem")))


_PROFILE_COLS = ("o_orderkey", "o_custkey", "l_linenumber", "l_quantity", "l_shipdate")


@query("dq_null_profile", "WITH j AS (SELECT o.o_orderkey, o.o_custkey, l.l_linenumber, l.l_quantity, l.l_shipdate "
       "FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey)\n"
       + "\nUNION ALL\n".join(
           f"SELECT 'orders_lines' AS table_name, '{c}' AS column_name, "
           f"CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_count, "
           f"CAST(count(*) AS BIGINT) AS row_count FROM j" for c in _PROFILE_COLS))
def dq_null_profile(spark, sf):
    """PIP-17: null counts per column of orders left-joined to their lines
    (orders without lines give the nulls)."""
    t = Tables(spark, sf)
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    j = t.orders.select("o_orderkey", "o_custkey").join(li, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return quality.null_profile(j.select(*_PROFILE_COLS), "orders_lines")
