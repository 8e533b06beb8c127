"""WL-ETL steps: name cleaning, contains-filter, cooking-time classes (PIP-02).

Every step is a ``DataFrame -> DataFrame`` function for ``run_job``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.functions.scalars import clean_name, iso_duration_minutes
from kestrel.operators.windows import group_avg_rows

# CND-01 class borders (fixed values of the spec): below 30 minutes easy,
# 30 to 60 inclusive medium, above 60 hard.
EASY_BELOW = 30
HARD_ABOVE = 60


def clean_names(col: str = "name"):
    """STR-01 step: delete the fixed character set from ``col``."""
    def step(df: DataFrame) -> DataFrame:
        return df.withColumn(col, clean_name(col))
    return step


def contains_ci(col: str, word: str):
    """FLT-05 / STR-06 step: lower(col) LIKE '%word%'."""
    def step(df: DataFrame) -> DataFrame:
        return df.filter(F.lower(F.col(col)).like(f"%{word.lower()}%"))
    return step


def with_total_minutes(cook: str = "cookTime", prep: str = "prepTime", out: str = "total_cooking_time",
                       count_days: bool = True):
    """DAT-08 / UDF-01 step: (cook + prep) ISO durations in whole minutes."""
    def step(df: DataFrame) -> DataFrame:
        secs = iso_duration_minutes(cook, count_days) + iso_duration_minutes(prep, count_days)
        return df.withColumn(out, F.floor(secs / 60).cast("bigint"))
    return step


def difficulty(minutes: str = "total_cooking_time") -> F.Column:
    """CND-01."""
    m = F.col(minutes)
    return (F.when(m < EASY_BELOW, "easy").when(m.between(EASY_BELOW, HARD_ABOVE), "medium")
            .when(m > HARD_ABOVE, "hard"))


def with_difficulty(minutes: str = "total_cooking_time"):
    def step(df: DataFrame) -> DataFrame:
        return df.withColumn("difficulty", difficulty(minutes))
    return step


def class_average(minutes: str = "total_cooking_time"):
    """PIP-02, spec form: one row per class (difficulty, avg_total_cooking_time)."""
    def step(df: DataFrame) -> DataFrame:
        return df.groupBy("difficulty").agg(
            (F.sum(minutes).cast("double") / F.count(minutes).cast("double")).alias("avg_total_cooking_time"))
    return step


def class_average_rows(minutes: str = "total_cooking_time"):
    """PIP-02, code form (Q4): every recipe row with its class average."""
    def step(df: DataFrame) -> DataFrame:
        return group_avg_rows(df, "difficulty", minutes, "avg_total_cooking_time").select(
            "difficulty", "avg_total_cooking_time")
    return step
