"""Data-quality checks and physical layout reports (PIP-08, PIP-17, TBL-01,
AGG-15, AGG-17, AGG-18)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rows_per_partition(df: DataFrame, n: int, key: str) -> DataFrame:
    """AGG-17 / UDF-05: hash-repartition by ``key`` into ``n`` partitions,
    count rows per physical partition and attach the count to each row.

    The count table has at most ``n`` rows, so broadcasting it is bounded
    by the partition count, not by the data.
    """
    parted = df.repartition(n, key).withColumn("partition_id", F.spark_partition_id())
    counts = parted.groupBy("partition_id").agg(F.count(F.lit(1)).alias("partition_rows"))
    return parted.join(F.broadcast(counts), "partition_id")


def unique_key_check(df: DataFrame, keys: list[str], table: str) -> DataFrame:
    """TBL-01 (primary key as a check): one row with total rows, distinct
    keys, duplicated keys, null keys and a pass flag."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    any_null = None
    for c in keys:
        any_null = F.col(c).isNull() if any_null is None else (any_null | F.col(c).isNull())
    out = per_key.groupBy().agg(
        F.sum("_n").cast("bigint").alias("total_rows"),
        F.count(F.lit(1)).cast("bigint").alias("distinct_keys"),
        F.sum(F.when(F.col("_n") > 1, 1).otherwise(0)).cast("bigint").alias("duplicated_keys"),
        F.sum(F.when(any_null, F.col("_n")).otherwise(0)).cast("bigint").alias("null_key_rows"))
    return out.select(F.lit(table).alias("table_name"), "*",
                      ((F.col("duplicated_keys") == 0) & (F.col("null_key_rows") == 0)).alias("passed"))


def null_profile(df: DataFrame, table: str) -> DataFrame:
    """PIP-17: per column, the number of nulls, in one pass (one global
    aggregate row, combined map-side, then unpivoted with ``stack``)."""
    cols = df.columns
    aggs = [F.sum(F.col(c).isNull().cast("bigint")).alias(f"n_{c}") for c in cols]
    aggs.append(F.count(F.lit(1)).alias("_rows"))
    one = df.groupBy().agg(*aggs)
    stack = "stack({n}, {args}) as (column_name, null_count)".format(
        n=len(cols), args=", ".join(f"'{c}', `n_{c}`" for c in cols))
    return one.selectExpr(f"'{table}' as table_name", "_rows as row_count", stack).select(
        "table_name", "column_name", F.col("null_count").cast("bigint").alias("null_count"),
        F.col("row_count").cast("bigint").alias("row_count"))


def days_present_gate(df: DataFrame, ts: str, before: int = 6, after: int = 1, need: int = 7) -> DataFrame:
    """AGG-18 re-aimed (Q11, Q12): for every day that has data (a "file
    day" d), how many distinct days of d-before .. d+after have data, and
    whether that reaches ``need``.

    Each data day is copied to the file days it counts for (before+after+1
    copies, a constant), then counted per file day: a groupBy, no window
    over the whole table and no single-task step.
    """
    days = df.select(F.to_date(ts).alias("d")).distinct()
    offs = days.select("d", F.explode(F.sequence(F.lit(-after), F.lit(before))).alias("_off"))
    spread = offs.select(F.date_add(F.col("d"), F.col("_off")).alias("file_day"))
    counted = spread.groupBy("file_day").agg(F.count(F.lit(1)).alias("days_present"))
    out = counted.join(days.withColumnRenamed("d", "file_day"), "file_day", "left_semi")
    return out.select("file_day", F.col("days_present").cast("bigint").alias("days_present"),
                      (F.col("days_present") >= need).alias("gate_open"))


def has_rows(df: DataFrame) -> bool:
    """AGG-15: existence test (a LIMIT 1 job)."""
    return not df.isEmpty()
