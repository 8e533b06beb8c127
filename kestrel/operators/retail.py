"""WL-RETAIL and WL-VOTE: joins, grouped aggregates, top-N, alliance totals.

Design notes for scale
* Line items are pre-aggregated per order *before* the join with orders:
  the partial aggregate combines on the map side, so a hot order key costs
  one row per map task, the join then runs on order grain (1:1), and the
  distinct-order count becomes a plain count.
* Money is summed as decimal (exact, order independent) and converted to
  double once at the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kestrel.functions.scalars import money, money_sum


def _order_totals(items: DataFrame, order_key: str, amount: str) -> DataFrame:
    """One row per order: exact amount and item count (map-side combined)."""
    return items.groupBy(F.col(order_key).alias("_ok")).agg(
        money_sum(amount).alias("_amt"), F.count(F.lit(1)).alias("_items"))


def daily_status_revenue(orders: DataFrame, items: DataFrame, *,
                         order_key="o_orderkey", item_order_key="l_orderkey",
                         date_col="o_orderdate", status_col="o_orderstatus",
                         amount_col="l_extendedprice") -> DataFrame:
    """JON-01 + AGG-01 + SRT-01 + MTH-01.

    Per (order day, status): rounded revenue and number of distinct orders,
    sorted by day desc, status, amount desc, count.
    """
    per_order = _order_totals(items, item_order_key, amount_col)
    o = orders.select(F.col(order_key).alias("_ok"),
                      F.to_date(date_col).alias("order_date"),
                      F.col(status_col).alias("order_status"))
    j = o.join(per_order, "_ok")
    out = j.groupBy("order_date", "order_status").agg(
        F.round(F.sum("_amt"), 2).cast("double").alias("order_amount"),
        F.count(F.lit(1)).alias("order_count"))
    return out.orderBy(F.desc("order_date"), "order_status", F.desc("order_amount"), "order_count")


def revenue_per_day(orders: DataFrame, items: DataFrame, statuses=("F", "O"), *,
                    order_key="o_orderkey", item_order_key="l_orderkey",
                    date_col="o_orderdate", status_col="o_orderstatus",
                    amount_col="l_extendedprice") -> DataFrame:
    """FLT-07 + JON-03 + AGG-10: revenue, item count and order count per day
    for orders whose status is in ``statuses`` (Q15: both counts)."""
    per_order = _order_totals(items, item_order_key, amount_col)
    o = (orders.filter(F.col(status_col).isin(list(statuses)))
         .select(F.col(order_key).alias("_ok"), F.to_date(date_col).alias("order_date")))
    return (o.join(per_order, "_ok").groupBy("order_date")
            .agg(F.sum("_amt").cast("double").alias("revenue"),
                 F.sum("_items").alias("item_count"),
                 F.count(F.lit(1)).alias("order_count")))


def category_stats(products: DataFrame, price_below: float, *, category="p_type",
                   product_id="p_partkey", price="p_retailprice") -> DataFrame:
    """FLT-08 + AGG-02 + MTH-02: per category of products cheaper than
    ``price_below``: max, min, average price as decimal(10,2) (decimal
    average, rounded half up), distinct product count."""
    g = (products.filter(F.col(price) < F.lit(price_below))
         .groupBy(F.col(category).alias("category"))
         .agg(F.max(price).alias("max_price"), F.min(price).alias("min_price"),
              F.avg(money(price)).cast("decimal(10,2)").cast("double").alias("avg_price"),
              F.count_distinct(product_id).alias("total_products")))
    return g.select("category", "max_price", "min_price", "avg_price", "total_products")


def category_avg(products: DataFrame, *, category="p_type", price="p_retailprice") -> DataFrame:
    """AGG-03: unrounded average price per category (exact decimal sum)."""
    return products.groupBy(F.col(category).alias("category")).agg(
        (money_sum(price).cast("double") / F.count(price).cast("double")).alias("avg_price"))


def busiest_day_orders(orders: DataFrame, *, date_col="o_orderdate", order_key="o_orderkey") -> DataFrame:
    """JON-06 + FLT-10 + AGG-04 + SRT-04: the orders of the day with most orders.

    Ties on the count go to the earliest day (Q17). The single winning day
    is found with a top-1 (TakeOrderedAndProject) and kept by a left-semi
    join; the one-row side is broadcast, which is size-bounded by the limit.
    """
    day = F.to_date(date_col)
    top = (orders.groupBy(day.alias("_d")).agg(F.count(F.lit(1)).alias("_n"))
           .orderBy(F.desc("_n"), F.asc("_d")).limit(1).select("_d"))
    return orders.join(F.broadcast(top), day == F.col("_d"), "left_semi")


def top_n_per_group(df: DataFrame, group: str, value: str, n: int, tie: str) -> DataFrame:
    """WIN-07 / UDF-07: the ``n`` rows with the largest ``value`` per group.

    ``row_number() <= n`` lets Spark plan a partial WindowGroupLimit before
    the shuffle, so each map task forwards at most n rows per group.
    """
    w = Window.partitionBy(group).orderBy(F.desc(value), F.asc(tie))
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def alliance_totals(candidates: DataFrame, allied: list[str], *, region="state", seat="constituency",
                    party="party", votes="votes", ally_name="Ally") -> DataFrame:
    """CND-03 + AGG-11/12 + ARR-04/05 (PIP-16): relabel allied parties, sum
    votes per (region, seat, party), list the parties per seat by votes desc.

    The relabel runs before the aggregation, so the sum is a map-side
    combined groupBy; the per-seat list holds one entry per party, i.e. it
    is bounded by the number of parties, not by the number of rows. The
    list is given as text ``party:votes`` joined by ``,`` (ties by name).
    """
    lab = F.when(F.col(party).isin(allied), F.lit(ally_name)).otherwise(F.col(party))
    per_party = (candidates.groupBy(F.col(region).alias(region), F.col(seat).alias(seat), lab.alias("party"))
                 .agg(F.sum(votes).cast("bigint").alias("votes")))
    ranked = per_party.groupBy(region, seat).agg(
        F.sort_array(F.collect_list(F.struct((-F.col("votes")).alias("neg"), F.col("party"), F.col("votes")))).alias("_l"),
        F.sum("votes").alias("total_votes"))
    return ranked.select(
        region, seat,
        F.array_join(F.transform("_l", lambda x: F.concat(x["party"], F.lit(":"), x["votes"].cast("string"))), ",").alias("ranking"),
        F.element_at("_l", 1)["party"].alias("leader"),
        "total_votes")


def join_left_default(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                      value: str, default=0, alias="value") -> DataFrame:
    """JON-04 + CND-04: left outer join; misses get ``default``."""
    r = right.select(F.col(right_key).alias("_rk"), F.col(value).alias("_v"))
    return (left.join(r, left[left_key] == r["_rk"], "left")
            .withColumn(alias, F.coalesce(F.col("_v"), F.lit(default))).drop("_rk", "_v"))


def pair_sum_members(df: DataFrame, group: str, value: str, target) -> DataFrame:
    """JON-11 (re-aimed exercise): every row whose partner ``target - value``
    occurs in the same group, duplicates kept, a value may pair with itself (Q3).

    An equi left-semi join on (group, target - value) replaces the all-pairs
    loop; the right side is the distinct (group, value) set, so no pair list
    is ever built.
    """
    vals = df.select(F.col(group).alias("_g"), F.col(value).alias("_v")).distinct()
    # compared as decimals: 50 - 49.9 is not 0.1 in doubles
    cond = df[group].eqNullSafe(vals["_g"]) & ((F.lit(target).cast("decimal(28,10)") - df[value].cast("decimal(28,10)")) == vals["_v"].cast("decimal(28,10)"))
    return df.join(vals, cond, "left_semi")


def value_histogram(df: DataFrame, value: str) -> DataFrame:
    """AGG-13: rows per distinct value."""
    return df.groupBy(F.col(value).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def distinct_pairs(df: DataFrame, *cols: str) -> DataFrame:
    """AGG-07 / SET-03."""
    return df.select(*cols).distinct()


def latest_partition(df: DataFrame, date_col: str) -> DataFrame:
    """AGG-05 + SRT-05: the latest day present and its row count (one row; none
    for a table without a day).

    The day is one ``max``, a single number from each task; the count reads the
    rows at or after its midnight, a bound that reaches the scan, where partitions
    and row groups before it are skipped by their statistics.
    """
    last = df.agg(F.max(date_col).alias("d")).select(F.to_date("d").alias("d")).first()["d"]
    out = "latest_date date, rows_on_latest bigint"
    if last is None:
        return df.sparkSession.createDataFrame([], out)
    kind = df.schema[date_col].dataType
    rows = df.where(F.col(date_col) >= F.lit(last).cast(kind))
    return rows.groupBy().agg(F.lit(last).alias("latest_date"), F.count(F.lit(1)).alias("rows_on_latest"))


def latest_stored_partition(spark: SparkSession, table: str, column: str) -> DataFrame:
    """AGG-05 + SRT-05 on a table partitioned by ``column``: the rows of its
    greatest partition. Which one that is, the catalogue's list of partitions
    says, so no file is opened for it; only that partition's files are read. No
    rows if there is no partition, or none with a value."""
    kind = spark.table(table).schema[column].dataType
    text = F.regexp_extract("partition", f"(?:^|/){column}=([^/]*)", 1)
    # file names write special characters as %XX; a plus stands for itself
    value = F.when(text != "__HIVE_DEFAULT_PARTITION__", F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))).cast(kind))
    last = spark.sql(f"SHOW PARTITIONS {table}").select(F.max(value).alias("v")).first()["v"]
    return spark.table(table).where(F.lit(False) if last is None else F.col(column) == F.lit(last).cast(kind))
