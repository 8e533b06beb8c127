"""File, text, JDBC and SequenceFile sources (SRC-01 .. SRC-13).

Text sources always get an explicit schema, so a scan never runs an
inference job over the input (SURVEY 1.3).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def scan(spark: SparkSession, fmt: str, path: str, schema: StructType | str | None = None,
         options: dict[str, str] | None = None) -> DataFrame:
    """SRC-01 / SRC-05: format-by-name scan (json, parquet, orc, csv, avro, ...)."""
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load(path)


def csv_with_header(spark: SparkSession, path: str, schema: StructType | str, sep: str = ",",
                    options: dict[str, str] | None = None) -> DataFrame:
    """SRC-02 / SRC-09: header line dropped in every file, typed by schema.

    ANSI mode makes a bad number an error; ``mode=PERMISSIVE`` keeps the row
    with a null (Q21)."""
    r = spark.read.schema(schema).option("header", True).option("sep", sep).option("mode", "PERMISSIVE")
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.csv(path)


def delimited_text(spark: SparkSession, path: str, schema: StructType | str, sep: str) -> DataFrame:
    """SRC-06 / SRC-07 / SRC-08: comma, pipe (literal, Q1) or tab separated
    text without header, fields typed by position through ``schema``."""
    return spark.read.schema(schema).option("sep", sep).option("header", False).csv(path)


def jdbc_table(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
               lower: int | None = None, upper: int | None = None, num_partitions: int | None = None,
               props: dict | None = None) -> DataFrame:
    """SRC-10 / SRC-11: relational import. With ``partition_column`` the
    read is split into ``num_partitions`` parallel range queries."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
             .option("upperBound", upper).option("numPartitions", num_partitions))
    for k, v in (props or {}).items():
        r = r.option(k, v)
    return r.load()


def import_all_tables(spark: SparkSession, url: str, tables: list[str], target: str, fmt: str = "parquet",
                      compression: str = "snappy") -> dict[str, str]:
    """SRC-11: copy every listed table into ``<target>/<table>``."""
    out = {}
    for t in tables:
        path = f"{target}/{t}"
        jdbc_table(spark, url, t).write.mode("overwrite").option("compression", compression).format(fmt).save(path)
        out[t] = path
    return out


def sequence_file(spark: SparkSession, path: str, key: str = "key", value: str = "value") -> DataFrame:
    """SRC-12: a Hadoop SequenceFile of (key, value) pairs as a DataFrame.
    The only RDD use in the package: SequenceFiles have no DataFrame reader."""
    return spark.sparkContext.sequenceFile(path).toDF([key, value])


def read_if_there(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """The Parquet table at ``path``; None if nothing was written there yet. Any other read error is raised."""
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
