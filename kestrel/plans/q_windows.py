"""Window queries: moving averages, latest per key, suffix max, leave-one-out."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from kestrel.functions.scalars import epoch_seconds
from kestrel.operators import ledger, windows
from kestrel.plans.registry import query
from kestrel.sources.tables import Tables

# The load date stamped on the daily file (PRJ-02); a job parameter.
FILE_LOAD_DATE = dt.date(2024, 2, 1)


@query("ma_rows_frame", f"""
SELECT event_id, event_type, user_id, ts, value,
       CAST(sum(CAST(value AS DECIMAL(18,2))) OVER w AS DOUBLE) / CAST(count(value) OVER w AS DOUBLE) AS value_ma,
       DATE '{FILE_LOAD_DATE}' AS file_load_date
FROM events
WINDOW w AS (PARTITION BY event_type, user_id ORDER BY ts, event_id ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)
""")
def ma_rows_frame(spark, sf):
    """PIP-14 / WIN-01: centred 3-row moving average per place (event type,
    user) ordered by time, with the file's load date stamped on."""
    ev = Tables(spark, sf).events.select("event_id", "event_type", "user_id", "ts", "value")
    out = windows.centered_moving_avg(ev, ["event_type", "user_id"], "ts", "event_id", ["value"])
    return out.withColumn("file_load_date", F.lit(FILE_LOAD_DATE))


# The date-range job's file day d covers d-6 .. d+1 (Q12).
RANGE_FILE_DAY = dt.date(2024, 1, 10)
RANGE_LO = RANGE_FILE_DAY - dt.timedelta(days=6)
RANGE_HI = RANGE_FILE_DAY + dt.timedelta(days=1)


@query("ma_date_range", f"""
SELECT event_id, event_type, user_id, value, CAST(ts AS DATE) AS source_date,
       CAST(sum(CAST(value AS DECIMAL(18,2))) OVER w AS DOUBLE) / CAST(count(value) OVER w AS DOUBLE) AS value_avg
FROM events
WHERE value IS NOT NULL AND CAST(ts AS DATE) BETWEEN DATE '{RANGE_LO}' AND DATE '{RANGE_HI}'
WINDOW w AS (PARTITION BY event_type, user_id ORDER BY CAST(floor(epoch(ts)) AS BIGINT)
             RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""")
def ma_date_range(spark, sf):
    """PIP-15 / WIN-02 / FLT-03 / FLT-04 / DAT-04 / PRJ-04: running average
    from the start of the slice. The date bounds filter the raw timestamp
    column (half-open on the next day), so the predicate reaches the
    Parquet scan."""
    ev = Tables(spark, sf).events
    lo = dt.datetime.combine(RANGE_LO, dt.time())
    hi = dt.datetime.combine(RANGE_HI + dt.timedelta(days=1), dt.time())
    sl = ev.filter(F.col("value").isNotNull() & (F.col("ts") >= F.lit(lo).cast("timestamp_ntz"))
                   & (F.col("ts") < F.lit(hi).cast("timestamp_ntz")))
    sl = sl.select("event_id", "event_type", "user_id", "value", "ts", F.to_date("ts").alias("source_date"))
    out = windows.running_avg(sl, ["event_type", "user_id"], epoch_seconds("ts"), ["value"], F.to_date("ts"))
    return out.drop("ts")


@query("win_latest_per_key", """
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice, o_orderstatus FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
WHERE rn = 1
""")
def win_latest_per_key(spark, sf):
    o = Tables(spark, sf).orders
    return windows.latest_per_key(o, "o_custkey", ["o_orderdate", "o_orderkey"],
                                  ["o_orderkey", "o_orderdate", "o_totalprice", "o_orderstatus"])


@query("join_latest_per_key", """
SELECT c.c_custkey, c.c_mktsegment, COALESCE(x.o_orderkey, 0) AS latest_orderkey, x.o_orderdate AS latest_orderdate
FROM customer c LEFT JOIN (
  SELECT o_custkey, o_orderkey, o_orderdate FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
  WHERE rn = 1) x ON c.c_custkey = x.o_custkey
""")
def join_latest_per_key(spark, sf):
    """JON-09: left join to the latest row per key (WIN-06 as max_by), which is
    worked out and joined once."""
    t = Tables(spark, sf)
    latest = windows.latest_per_key(t.orders, "o_custkey", ["o_orderdate", "o_orderkey"], ["o_orderkey", "o_orderdate"])
    c = t.customer.select("c_custkey", "c_mktsegment")
    j = c.join(latest, c["c_custkey"] == latest["o_custkey"], "left")
    return j.select("c_custkey", "c_mktsegment", F.coalesce("o_orderkey", F.lit(0)).alias("latest_orderkey"), F.col("o_orderdate").alias("latest_orderdate"))


_LINE_ORDER = "l_linenumber, l_partkey, l_suppkey, l_quantity"
# Lines per window chunk: a hot order is windowed in pieces of this many line numbers.
LINE_CHUNK = 4


@query("win_suffix_max", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
       CASE WHEN m IS NULL OR l_quantity > m THEN -1.0 ELSE m END AS next_max
FROM (SELECT *, max(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY {_LINE_ORDER}
                                      ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS m FROM lineitem)
""")
def win_suffix_max(spark, sf):
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    w_order = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return windows.suffix_max(li.withColumn("_o", w_order), "l_orderkey", "_o", "l_quantity",
                              chunk=F.floor(F.col("l_linenumber") / LINE_CHUNK)).drop("_o")


@query("win_product_except_self", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CAST(COALESCE(product(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY {_LINE_ORDER}
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1)
     * COALESCE(product(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY {_LINE_ORDER}
                ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 1) AS BIGINT) AS product_others
FROM lineitem
""")
def win_product_except_self(spark, sf):
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return windows.product_except_self(li, "l_orderkey", "l_linenumber")


# Account movements stand in as events (FIXTURES part 3): signup and click
# are deposits, purchase is a withdrawal, value is the amount.
DEPOSITS = ("signup", "click")
WITHDRAWALS = ("purchase",)

LEDGER_SQL = """
WITH RECURSIVE mv AS (
  SELECT user_id, event_id, ts, event_type, value, event_type IN ('signup', 'click') AS is_deposit,
         CAST(round(value * 100) AS BIGINT) AS cents,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
  FROM events WHERE event_type IN ('signup', 'click', 'purchase')),
r AS (
  SELECT user_id, CAST(0 AS BIGINT) AS rn, CAST(0 AS BIGINT) AS bal, CAST(NULL AS BOOLEAN) AS applied
  FROM mv GROUP BY user_id
  UNION ALL
  SELECT r.user_id, mv.rn,
         CASE WHEN mv.is_deposit THEN r.bal + mv.cents WHEN r.bal > mv.cents THEN r.bal - mv.cents ELSE r.bal END,
         mv.is_deposit OR r.bal > mv.cents
  FROM r JOIN mv ON mv.user_id = r.user_id AND mv.rn = r.rn + 1),
led AS (
  SELECT mv.user_id, mv.event_id, mv.ts, mv.event_type, mv.value, mv.is_deposit, mv.cents, r.applied,
         CAST(r.bal AS DOUBLE) / 100 AS balance
  FROM mv JOIN r ON mv.user_id = r.user_id AND mv.rn = r.rn)
"""


def _ledger(spark, sf):
    ev = Tables(spark, sf).events.select("user_id", "event_id", "ts", "event_type", "value")
    return ledger.ledger(ev, "user_id", ["ts", "event_id"], "event_type", "value", DEPOSITS, WITHDRAWALS)


@query("ledger_balances", LEDGER_SQL + """
SELECT user_id, event_id, ts, event_type, value, applied, balance FROM led""")
def ledger_balances(spark, sf):
    """WIN-10: every movement with applied/refused and the balance after it."""
    return _ledger(spark, sf)


@query("ledger_monthly", LEDGER_SQL + """
SELECT user_id, CAST(date_trunc('month', ts) AS DATE) AS month,
       CAST(sum(CASE WHEN is_deposit THEN cents ELSE 0 END) AS DOUBLE) / 100 AS deposits,
       CAST(sum(CASE WHEN NOT is_deposit AND applied THEN cents ELSE 0 END) AS DOUBLE) / 100 AS withdrawals,
       CAST(sum(CASE WHEN NOT is_deposit AND NOT applied THEN 1 ELSE 0 END) AS BIGINT) AS refused_count,
       arg_max(balance, (ts, event_id)) AS closing_balance
FROM led GROUP BY 1, 2""")
def ledger_monthly(spark, sf):
    """WIN-11: monthly statement per account from the ledger."""
    return ledger.monthly_statement(_ledger(spark, sf), "user_id", "ts", ["ts", "event_id"],
                                    F.col("event_type").isin(*DEPOSITS), "value")
