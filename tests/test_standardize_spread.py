"""The batch standardiser's work is dealt out however few files the rows lie in, and its calls stay full."""

import pandas as pd
from pyspark.sql import functions as F

from kestrel.operators import matching


def rows_of(spark, n):
    text = F.concat(F.lit("  "), F.sha2(F.col("id").cast("string"), 256))
    return spark.range(0, n, 1, 1).select("id", F.concat(text, F.lit("  elm st")).alias("input_street"), F.lit(None).cast("string").alias("input_secondary"),
                                          F.lit("12345").alias("input_zip"), text.alias("input_city"), text.alias("input_state"))


def test_rows_of_one_file_are_dealt_out(spark):
    got = matching.standardize_batches(rows_of(spark, 40_000)).withColumn("p", F.spark_partition_id())
    got = got.groupBy("p").agg(F.count("*").alias("n"), F.count("std_delivery_line_1").alias("known")).collect()
    assert len(got) > 1 and sum(r["n"] for r in got) == sum(r["known"] for r in got) == 40_000


def test_a_small_table_is_sent_in_full_calls(spark):
    def sizes(batch: pd.DataFrame) -> pd.DataFrame:
        return matching.rules_standardizer(batch).assign(std_city=str(len(batch)))

    got = matching.standardize_batches(rows_of(spark, 250), sizes).groupBy("std_city").count().collect()
    assert sorted(tuple(r) for r in got) == [("100", 200), ("50", 50)]


def test_replies_stay_with_their_rows(spark):
    """Over many hand-backs, with a failing call among them."""
    def some(batch: pd.DataFrame) -> pd.DataFrame:
        if batch["input_street"].str.contains("  " + FAIL, regex=False).any():
            raise OSError("no answer")
        return matching.rules_standardizer(batch)

    import hashlib
    FAIL = hashlib.sha256(b"777").hexdigest()
    got = matching.standardize_batches(rows_of(spark, 25_000), some)
    failed = got.where("std_error is not null")
    assert failed.count() == 100 and failed.where("id = 777 and std_city is null").count() == 1
    right = F.col("std_delivery_line_1") == F.concat(F.upper(F.sha2(F.col("id").cast("string"), 256)), F.lit(" ELM STREET"))
    assert got.where("std_error is null").where(right & F.col("std_delivery_line_2").isNull()).count() == 24_900
