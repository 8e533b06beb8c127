"""Text counts (ARR-01, FLT-06, STR-07, AGG-14).

Words come from splitting on a single blank, as the reference does; empty
words (from runs of blanks) are dropped (Q9). Counting is a groupBy with
map-side partial aggregation, so a very frequent word ("the") costs one
row per map task in the shuffle, never a hot reducer input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def words(df: DataFrame, text: str, sep: str = " ") -> DataFrame:
    """One row per non-empty word of ``text`` (whole texts, no prefix)."""
    return (df.select(F.explode(F.split(F.col(text), sep)).alias("word"))
            .filter(F.col("word") != ""))


def word_counts(df: DataFrame, text: str) -> DataFrame:
    """ARR-01 + AGG: count per word."""
    return words(df, text).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def hashtag_counts(df: DataFrame, text: str, prefix: str = "#") -> DataFrame:
    """FLT-06 + STR-07: count per word that starts with ``prefix``."""
    return (words(df, text).filter(F.col("word").startswith(prefix))
            .groupBy(F.col("word").alias("tag")).agg(F.count(F.lit(1)).alias("n")))


def first_field_word_count(df: DataFrame, text: str, field_sep: str = ",") -> DataFrame:
    """AGG-14: total number of words in the first ``field_sep`` field of
    every line. Pure expressions per row (no explode), then one global sum."""
    lines = F.split(F.col(text), "\n")
    per_line = F.transform(lines, lambda l: F.size(F.filter(
        F.split(F.split_part(l, F.lit(field_sep), F.lit(1)), " "), lambda w: w != "")))
    per_doc = F.aggregate(per_line, F.lit(0).cast("bigint"), lambda a, b: a + b)
    return df.groupBy().agg(F.sum(per_doc).cast("bigint").alias("total_words"),
                            F.sum(F.size(lines)).cast("bigint").alias("total_lines"))
