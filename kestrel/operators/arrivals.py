"""Day files that arrive one by one: a gate for each day, and running averages that start where earlier days ended
(PIP-15 with AGG-18, WIN-02; also the partition write of PIP-14).

A *file day* is a day that has rows. Its average slice reaches ``before`` days
back; its gate opens once at least ``need`` of the days from ``before`` ago to
``after`` ahead have arrived. Below ``base`` two tables are kept::

    totals/day=…     per key the sum and count of each measure on that day
    output/day=…     the rows of the day, with the running averages; gate open only

When files of some days have come, only those days are read: their totals are
written anew. A file day is worked out again if one of the days it looks at has
changed, with its own rows and, in place of the rows of earlier days, their
totals. Days whose gate is closed have no output; a late file reopens only the
days that look at it. Both tables are replaced by the partition, so a batch that
is run again writes the same.

Measures are summed exactly (decimals). Rows without a day belong to no file;
null keys are keys like any other; null measures take no part in an average.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.operators.windows import running_avg, running_totals
from kestrel.sinks.writers import dynamic_partition_overwrite
from kestrel.sources.readers import read_if_there


@dataclass(frozen=True)
class Job:
    """What is averaged, and when a day may be."""
    base: str
    keys: Sequence[str]
    measures: Sequence[str]
    order: Column
    chunk: Column
    before: int = 6
    after: int = 1
    need: int = 7


def day_totals(rows: DataFrame, job: Job) -> DataFrame:
    """Per (day, key): sum and count of each measure. Every day of ``rows`` has at least one row."""
    return running_totals(rows, ["day", *job.keys], list(job.measures))


def stored_totals(spark: SparkSession, job: Job) -> DataFrame | None:
    return read_if_there(spark, f"{job.base}/totals")


def gates(days: DataFrame, job: Job) -> DataFrame:
    """(day, days_present, gate_open) of every arrived day; ``days`` holds each once."""
    seen = days.select(F.explode(F.sequence(F.date_sub("day", job.after), F.date_add("day", job.before))).alias("day"))
    counted = seen.groupBy("day").agg(F.count(F.lit(1)).alias("days_present"))
    return counted.join(days, "day").select("day", "days_present", (F.col("days_present") >= job.need).alias("gate_open"))


def process(spark: SparkSession, arrived: list, rows_of: Callable[[list], DataFrame], job: Job) -> list:
    """Takes in the files of the ``arrived`` days and writes the outputs they change; returns the days written.

    ``rows_of(days)`` reads all rows of some days (with a column ``day``), and only
    those. Days are dates, a few for each batch of files.
    """
    if not arrived:
        return []
    dynamic_partition_overwrite(day_totals(rows_of(arrived), job), f"{job.base}/totals", ["day"])
    totals = stored_totals(spark, job)
    # folder names alone say which days there are
    days = totals.select("day").distinct()
    new = spark.createDataFrame([(d,) for d in arrived], "day date")
    touched = new.select(F.explode(F.sequence(F.date_sub("day", job.after), F.date_add("day", job.before))).alias("day")).distinct()
    open_ = [r["day"] for r in gates(days, job).where("gate_open").join(touched, "day", "left_semi").orderBy("day").collect()]
    if not open_:
        return []
    # what the days before have left, for each day that is written: at most ``before`` rows a key
    wanted = spark.createDataFrame([(d,) for d in open_], "file_day date")
    ahead = wanted.select("file_day", F.explode(F.sequence(F.date_sub("file_day", job.before), F.date_sub("file_day", 1))).alias("day"))
    sums = [F.sum(f"{m}_{x}").alias(f"{m}_{x}") for m in job.measures for x in ("sum", "count")]
    opening = totals.join(ahead, "day").groupBy("file_day", *job.keys).agg(*sums).withColumnRenamed("file_day", "day")
    out = running_avg(rows_of(open_), ["day", *job.keys], job.order, list(job.measures), job.chunk, opening=opening)
    dynamic_partition_overwrite(out, f"{job.base}/output", ["day"])
    return open_


def output(spark: SparkSession, job: Job) -> DataFrame | None:
    return read_if_there(spark, f"{job.base}/output")
