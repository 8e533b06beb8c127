"""Queries of WL-RETAIL, WL-VOTE, text counts, joins and small aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.operators import retail, text
from kestrel.plans.registry import query
from kestrel.sources.tables import Tables


@query("retail_daily_status_revenue", """
SELECT CAST(o.o_orderdate AS DATE) AS order_date, o.o_orderstatus AS order_status,
       CAST(round(sum(CAST(l.l_extendedprice AS DECIMAL(18,2))), 2) AS DOUBLE) AS order_amount,
       count(DISTINCT o.o_orderkey) AS order_count
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
GROUP BY 1, 2
ORDER BY order_date DESC, order_status, order_amount DESC, order_count
""")
def retail_daily_status_revenue(spark, sf):
    t = Tables(spark, sf)
    return retail.daily_status_revenue(t.orders, t.lineitem)


@query("retail_revenue_per_day", """
SELECT CAST(o.o_orderdate AS DATE) AS order_date,
       CAST(sum(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
       count(*) AS item_count, count(DISTINCT o.o_orderkey) AS order_count
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
WHERE o.o_orderstatus IN ('F', 'O')
GROUP BY 1
""")
def retail_revenue_per_day(spark, sf):
    t = Tables(spark, sf)
    return retail.revenue_per_day(t.orders, t.lineitem, ("F", "O"))


@query("retail_category_stats", """
SELECT p_type AS category, max(p_retailprice) AS max_price, min(p_retailprice) AS min_price,
       CAST(CAST(floor((sum(CAST(round(p_retailprice * 100) AS BIGINT)) * 2 + count(p_retailprice))
                       / (count(p_retailprice) * 2)) AS DECIMAL(12,0)) / 100 AS DOUBLE) AS avg_price,
       count(DISTINCT p_partkey) AS total_products
FROM part WHERE p_retailprice < 950 GROUP BY p_type
""")
def retail_category_stats(spark, sf):
    return retail.category_stats(Tables(spark, sf).part, 950.0)


@query("retail_category_avg", """
SELECT p_type AS category,
       CAST(sum(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) / CAST(count(p_retailprice) AS DOUBLE) AS avg_price
FROM part GROUP BY p_type
""")
def retail_category_avg(spark, sf):
    return retail.category_avg(Tables(spark, sf).part)


@query("retail_busiest_day_orders", """
SELECT * FROM orders WHERE CAST(o_orderdate AS DATE) IN (
  SELECT d FROM (SELECT CAST(o_orderdate AS DATE) AS d, count(1) AS n FROM orders GROUP BY 1
                 ORDER BY n DESC, d ASC LIMIT 1))
""")
def retail_busiest_day_orders(spark, sf):
    return retail.busiest_day_orders(Tables(spark, sf).orders)


@query("retail_topn_per_group", """
SELECT p_brand, p_partkey, p_name, p_retailprice, rank FROM (
  SELECT p_brand, p_partkey, p_name, p_retailprice,
         row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey ASC) AS rank
  FROM part) WHERE rank <= 3
""")
def retail_topn_per_group(spark, sf):
    p = Tables(spark, sf).part.select("p_brand", "p_partkey", "p_name", "p_retailprice")
    return retail.top_n_per_group(p, "p_brand", "p_retailprice", 3, "p_partkey")


# Stand-in for the election data (FIXTURES part 3): market segment = state,
# nation = constituency, order priority = party, orders = votes.
VOTE_STATE = "BUILDING"
VOTE_ALLIES = ["1-URGENT", "2-HIGH"]


@query("vote_alliance_totals", f"""
WITH cand AS (
  SELECT c.c_mktsegment AS state, c.c_nationkey AS constituency,
         CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Ally' ELSE o.o_orderpriority END AS party,
         count(*) AS votes
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  WHERE c.c_mktsegment = '{VOTE_STATE}'
  GROUP BY 1, 2, 3)
SELECT state, constituency,
       string_agg(party || ':' || CAST(votes AS VARCHAR), ',' ORDER BY votes DESC, party) AS ranking,
       (list(party ORDER BY votes DESC, party))[1] AS leader,
       CAST(sum(votes) AS BIGINT) AS total_votes
FROM cand GROUP BY state, constituency
""")
def vote_alliance_totals(spark, sf):
    t = Tables(spark, sf)
    per_cust = t.orders.groupBy("o_custkey", "o_orderpriority").agg(F.count(F.lit(1)).alias("votes"))
    cust = t.customer.filter(F.col("c_mktsegment") == VOTE_STATE)
    cand = per_cust.join(cust, per_cust.o_custkey == cust.c_custkey).select(
        F.col("c_mktsegment").alias("state"), F.col("c_nationkey").alias("constituency"),
        F.col("o_orderpriority").alias("party"), "votes")
    return retail.alliance_totals(cand, VOTE_ALLIES)


@query("text_word_counts", """
SELECT word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents)
WHERE word <> '' GROUP BY word
""")
def text_word_counts(spark, sf):
    return text.word_counts(Tables(spark, sf).documents, "text")


def _tagged_messages(t: Tables):
    # Message text with hashtags, built from events (FIXTURES part 3).
    return t.events.select(F.concat(F.lit("saw #"), F.col("event_type"), F.lit(" by u"),
                                    F.col("user_id").cast("string")).alias("text"))


@query("text_hashtag_counts", """
SELECT word AS tag, count(*) AS n FROM (
  SELECT unnest(string_split('saw #' || event_type || ' by u' || CAST(user_id AS VARCHAR), ' ')) AS word FROM events)
WHERE starts_with(word, '#') GROUP BY word
""")
def text_hashtag_counts(spark, sf):
    return text.hashtag_counts(_tagged_messages(Tables(spark, sf)), "text")


@query("text_first_field_word_count", """
SELECT CAST(sum(n) AS BIGINT) AS total_words, CAST(count(*) AS BIGINT) AS total_lines FROM (
  SELECT len(list_filter(string_split(split_part(line, ',', 1), ' '), lambda w: w <> '')) AS n
  FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents))
""")
def text_first_field_word_count(spark, sf):
    return text.first_field_word_count(Tables(spark, sf).documents, "text")


@query("agg_distinct_pairs", "SELECT DISTINCT lang, source FROM documents")
def agg_distinct_pairs(spark, sf):
    return retail.distinct_pairs(Tables(spark, sf).documents, "lang", "source")


@query("agg_histogram", "SELECT l_quantity AS value, count(*) AS n FROM lineitem GROUP BY l_quantity")
def agg_histogram(spark, sf):
    return retail.value_histogram(Tables(spark, sf).lineitem, "l_quantity")


@query("latest_partition", """
SELECT CAST(o_orderdate AS DATE) AS latest_date, count(*) AS rows_on_latest FROM orders
GROUP BY 1 ORDER BY 1 DESC LIMIT 1
""")
def latest_partition(spark, sf):
    return retail.latest_partition(Tables(spark, sf).orders, "o_orderdate")


@query("join_left_default", """
SELECT o.o_orderkey, o.o_orderstatus, COALESCE(l.n, 0) AS line_count
FROM orders o LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) l
  ON o.o_orderkey = l.l_orderkey
""")
def join_left_default(spark, sf):
    t = Tables(spark, sf)
    lines = t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    o = t.orders.select("o_orderkey", "o_orderstatus")
    return retail.join_left_default(o, lines, "o_orderkey", "l_orderkey", "n", 0, "line_count")


@query("join_pair_sum", """
SELECT l.l_orderkey, l.l_linenumber, l.l_quantity, 50 - l.l_quantity AS partner
FROM lineitem l
WHERE EXISTS (SELECT 1 FROM lineitem r WHERE r.l_orderkey = l.l_orderkey AND r.l_quantity = 50 - l.l_quantity)
""")
def join_pair_sum(spark, sf):
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    return retail.pair_sum_members(li, "l_orderkey", "l_quantity", 50.0).withColumn(
        "partner", F.lit(50.0) - F.col("l_quantity"))


@query("partition_row_counts", """
SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS mismatches FROM customer
""")
def partition_row_counts(spark, sf):
    """AGG-17 + PRT-04 + PRJ-03 + JON-07: rows per physical partition after a
    hash repartition, attached to every row; the query reports all rows and
    the partitions whose attached count is not what a second count finds. The
    number of partitions is the session's."""
    from kestrel.operators.quality import rows_per_partition
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows_per_partition(Tables(spark, sf).customer.select("c_custkey", "c_name"), n, "c_custkey")
    per = rows.groupBy("partition_id", "partition_rows").agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.sum("n").alias("n_rows"), F.sum((F.col("n") != F.col("partition_rows")).cast("bigint")).alias("mismatches"))
