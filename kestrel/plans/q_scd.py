"""SCD type 2 queries. The dimension stands in as customer (key c_custkey,
address = market segment): customers with a negative balance have only a
closed row (Q23), BUILDING customers also carry an older closed row. Every
customer sends an update (a changed address when the balance is above 5000,
the same one otherwise) and customers above 9000 also bring a new key
(FIXTURES part 3)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from kestrel.operators import dimension as store
from kestrel.operators import scd
from kestrel.plans.registry import query
from kestrel.session import scratch_path
from kestrel.sources.tables import Tables

LOAD_DATE = dt.date(2020, 1, 1)
HISTORY_DATE = dt.date(2018, 1, 1)
CLOSED_DATE = dt.date(2023, 1, 1)
UPDATE_DATE = dt.date(2024, 6, 1)
NEW_KEY_OFFSET = 1_000_000

STAGE_SQL = f"""
WITH dim AS (
  SELECT c_custkey AS customerId, c_mktsegment AS address, (c_acctbal >= 0) AS current,
         DATE '{LOAD_DATE}' AS effectiveDate,
         CASE WHEN c_acctbal < 0 THEN DATE '{CLOSED_DATE}' END AS endDate
  FROM customer
  UNION ALL
  SELECT c_custkey, 'OLD ' || c_mktsegment, false, DATE '{HISTORY_DATE}', DATE '{LOAD_DATE}'
  FROM customer WHERE c_mktsegment = 'BUILDING'),
upd AS (
  SELECT c_custkey AS customerId,
         CASE WHEN c_acctbal > 5000 THEN c_mktsegment || ' NEW' ELSE c_mktsegment END AS address,
         DATE '{UPDATE_DATE}' AS effectiveDate
  FROM customer
  UNION ALL
  SELECT c_custkey + {NEW_KEY_OFFSET}, c_mktsegment, DATE '{UPDATE_DATE}' FROM customer WHERE c_acctbal > 9000)
"""


def dimension(t: Tables):
    c = t.customer
    cur = c.select(F.col("c_custkey").alias("customerId"), F.col("c_mktsegment").alias("address"),
                   (F.col("c_acctbal") >= 0).alias("current"),
                   F.lit(LOAD_DATE).alias("effectiveDate"),
                   F.when(F.col("c_acctbal") < 0, F.lit(CLOSED_DATE)).alias("endDate"))
    hist = c.filter(F.col("c_mktsegment") == "BUILDING").select(
        F.col("c_custkey").alias("customerId"), F.concat(F.lit("OLD "), F.col("c_mktsegment")).alias("address"),
        F.lit(False).alias("current"), F.lit(HISTORY_DATE).alias("effectiveDate"),
        F.lit(LOAD_DATE).alias("endDate"))
    return cur.unionByName(hist)


def updates(t: Tables):
    c = t.customer
    upd = c.select(
        F.col("c_custkey").alias("customerId"),
        F.when(F.col("c_acctbal") > 5000, F.concat(F.col("c_mktsegment"), F.lit(" NEW")))
        .otherwise(F.col("c_mktsegment")).alias("address"),
        F.lit(UPDATE_DATE).alias("effectiveDate"))
    new = c.filter(F.col("c_acctbal") > 9000).select(
        (F.col("c_custkey") + NEW_KEY_OFFSET).alias("customerId"), F.col("c_mktsegment").alias("address"),
        F.lit(UPDATE_DATE).alias("effectiveDate"))
    return upd.unionByName(new)


@query("scd2_staged_updates", STAGE_SQL + """
, flagged AS (
  SELECT u.customerId, u.address, u.effectiveDate,
         (SELECT count(*) FROM dim d WHERE d.customerId = u.customerId AND d.current AND d.address <> u.address) AS changed
  FROM upd u)
SELECT CASE WHEN copy = 0 THEN customerId END AS mergeKey, customerId, address, effectiveDate
FROM (SELECT customerId, address, effectiveDate, unnest(range(0, 1 + changed)) AS copy FROM flagged)
""")
def scd2_staged_updates(spark, sf):
    t = Tables(spark, sf)
    return scd.staged_updates(dimension(t), updates(t))


MERGE_SQL = STAGE_SQL + """,
chg AS (SELECT u.customerId, u.address, u.effectiveDate FROM upd u JOIN dim c
        ON u.customerId = c.customerId WHERE c.current AND u.address <> c.address)
SELECT d.customerId, d.address,
       CASE WHEN d.current AND x.customerId IS NOT NULL THEN false ELSE d.current END AS current,
       d.effectiveDate,
       CASE WHEN d.current AND x.customerId IS NOT NULL THEN x.effectiveDate ELSE d.endDate END AS endDate
FROM dim d LEFT JOIN chg x ON d.customerId = x.customerId
UNION ALL SELECT customerId, address, true, effectiveDate, CAST(NULL AS DATE) FROM chg
UNION ALL SELECT customerId, address, true, effectiveDate, CAST(NULL AS DATE) FROM upd
          WHERE customerId NOT IN (SELECT customerId FROM dim)
"""


@query("scd2_merge", MERGE_SQL)
def scd2_merge(spark, sf):
    t = Tables(spark, sf)
    return scd.scd2_merge(dimension(t), updates(t))


@query("scd2_stored_merge", MERGE_SQL)
def scd2_stored_merge(spark, sf):
    """TBL-06 / JON-10 / PIP-04 / SRT-06: the dimension as a stored table, merged
    copy on write; the updates sent once more change nothing and make no version;
    read back in the order of keys."""
    t = Tables(spark, sf)
    base = scratch_path(spark, "dimension")
    store.create(dimension(t), base, buckets=8)
    for _ in range(2):
        store.merge(spark, base, updates(t))
    return store.ordered(store.read(spark, base))
