"""Sinks and table maintenance (SNK-*, TBL-*).

Every writer takes the DataFrame and plain parameters. None of them
collects data to the driver; the output file count is a parameter that
defaults to "let Spark decide" (one file per task), because funnelling a
large output through ``coalesce(1)`` makes one task write all of it.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass
class SinkConfig:
    """SNK-01: what a config-driven job writes and how."""
    path: str
    fmt: str = "parquet"
    mode: str = "overwrite"
    partition_cols: list[str] = field(default_factory=list)
    repartition: int | None = None
    header: bool = True
    overwrite: str = "static"
    options: dict[str, str] = field(default_factory=dict)


def write(df: DataFrame, conf: SinkConfig) -> str:
    """SNK-01 (+Q2: any number of partition columns). Rows are gathered by the
    partition columns (:func:`gathered`); ``repartition`` fixes the number of
    write tasks instead. ``overwrite`` says what mode "overwrite" replaces,
    whatever the session's setting: all (static) or the partitions present (dynamic)."""
    out = df
    if conf.repartition:
        out = (out.repartition(conf.repartition, *conf.partition_cols) if conf.partition_cols
               else out.repartition(conf.repartition))
    elif conf.partition_cols:
        out = gathered(out, conf.partition_cols)
    w = out.write.format(conf.fmt).mode(conf.mode)
    if conf.fmt == "csv":
        w = w.option("header", conf.header)
    for k, v in conf.options.items():
        w = w.option(k, v)
    if conf.partition_cols:
        w = w.partitionBy(*conf.partition_cols).option("partitionOverwriteMode", conf.overwrite)
    w.save(conf.path)
    return conf.path


def gathered(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows brought together by ``cols`` for a write. A rebalance, not a plain
    hash exchange: AQE joins small pieces and splits a value that holds more
    than the advisory partition size, so a hot partition has several writers."""
    return df.hint("rebalance", *cols)


def dynamic_partition_overwrite(df: DataFrame, path: str, partition_cols: list[str], fmt: str = "parquet",
                                distribute: bool = True) -> str:
    """SNK-02 / SNK-03 / PRT-03: replace only the partitions present in ``df``.

    ``distribute`` gathers rows by the partition columns first, so not every
    task writes into every directory; a large partition is split over several
    tasks (:func:`gathered`).
    """
    out = gathered(df, partition_cols) if distribute else df
    (out.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_cols).save(path))
    return path


def create_partitioned_table(spark: SparkSession, name: str, schema_ddl: str, partition_cols: list[str],
                             location: str, fmt: str = "parquet", buckets: tuple[int, str] | None = None) -> None:
    """TBL-03 / TBL-02: CREATE TABLE ... PARTITIONED BY [CLUSTERED BY .. INTO n BUCKETS]."""
    clustered = f" CLUSTERED BY ({buckets[1]}) INTO {buckets[0]} BUCKETS" if buckets else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema_ddl}) USING {fmt} "
              f"PARTITIONED BY ({', '.join(partition_cols)}){clustered} LOCATION '{location}'")


def static_partition_overwrite(spark: SparkSession, table: str, spec: dict[str, str], df: DataFrame) -> None:
    """SNK-04 / PIP-11: INSERT OVERWRITE exactly one static partition.

    Rows go in by name: the select list follows the table's non-partition
    columns (Q31), whatever order ``df`` has. Re-running with the same spec
    replaces the partition, so the publish is idempotent.
    """
    cols = [f.name for f in spark.table(table).schema.fields if f.name not in spec]
    view = f"_kestrel_src_{uuid.uuid4().hex}"
    df.select(*cols).createOrReplaceTempView(view)
    part = ", ".join(f"{k} = {_literal(v)}" for k, v in spec.items())
    try:
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({part}) SELECT {', '.join(cols)} FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def _literal(value) -> str:
    """A SQL string literal of any text."""
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def insert_overwrite(df: DataFrame, table: str, distribute: bool = True) -> None:
    """SNK-03 / PRT-03: INSERT OVERWRITE TABLE with dynamic partitions: only
    the partitions present in ``df`` are replaced. Columns go in by name;
    ``distribute`` gathers rows by the partition columns first
    (:func:`gathered`)."""
    spark = df.sparkSession
    cols = [f.name for f in spark.table(table).schema.fields]
    parts = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    out = df.select(*cols)
    if distribute and parts:
        out = gathered(out, parts)
    # insertInto takes the mode from the session only; the caller's setting comes back
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        out.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(key, before)


def append_into(df: DataFrame, table: str) -> None:
    """SNK-05 / SNK-06: INSERT INTO (append), columns matched by name."""
    spark = df.sparkSession
    cols = [f.name for f in spark.table(table).schema.fields]
    df.select(*cols).write.insertInto(table)


def drop_table(spark: SparkSession, name: str) -> None:
    """TBL-05."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


#: Rows that a bucket is aimed at.
BUCKET_ROWS = 5_000_000


def bucket_count(df: DataFrame, least: int = 4, rows: int = BUCKET_ROWS) -> int:
    """Buckets for a table of this size, a power of two, so that tables of unlike
    size have counts that divide one another."""
    need = max(least, -(-df.count() // rows))
    return 1 << (need - 1).bit_length()


def bucketed_table(df: DataFrame, name: str, path: str, partition_col: str, bucket_col: str, buckets: int | None = None,
                   fmt: str = "parquet") -> int:
    """TBL-02 / SNK-06: partitioned + bucketed table. A later join or
    aggregation on ``bucket_col`` between tables with the same bucketing
    reads co-located buckets without an exchange. The number of buckets, by
    default from the size of ``df``, is returned."""
    n = buckets or bucket_count(df)
    (df.repartition(n, bucket_col).write.format(fmt).mode("overwrite").option("path", path)
     .partitionBy(partition_col).bucketBy(n, bucket_col).sortBy(bucket_col).saveAsTable(name))
    return n


def append_bucketed(df: DataFrame, table: str) -> None:
    """SNK-06: INSERT INTO a partitioned and bucketed table, columns by name.

    Rows are dealt out by the table's own bucket function first, so a task holds
    whole buckets and an insert adds one file a bucket and partition, not one for
    each task besides. The table's layout stays, and joins on the bucket column
    still need no exchange.
    """
    spark = df.sparkSession
    meta = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    n = int(meta["Num Buckets"])
    by = [c.strip("`[] ") for c in meta["Bucket Columns"].strip("[]").split(",")]
    cols = [f.name for f in spark.table(table).schema.fields]
    df.select(*cols).repartition(n, *by).write.insertInto(table)


def extract_csv(df: DataFrame, base: str, name: str, compression: str = "gzip", header: bool = False,
                files: int | None = None, mode: str = "overwrite") -> str:
    """SNK-09 / SNK-10 re-aimed: write a headerless compressed CSV extract to
    ``<base>/<name>/``; overwrite replaces an earlier extract of that name,
    so no file renaming or deleting outside Spark is needed. ``files=1``
    reproduces the single-file extract (only for small extracts)."""
    out = df.coalesce(files) if files else df
    path = f"{base}/{name}"
    out.write.mode(mode).option("compression", compression).option("header", header).csv(path)
    return path


def text_lines(df: DataFrame, path: str, sep: str = ",") -> str:
    """SNK-13: one comma-joined text line per row."""
    df.select(F.concat_ws(sep, *[F.col(c).cast("string") for c in df.columns]).alias("value")).write.mode(
        "overwrite").text(path)
    return path


def jdbc_write(df: DataFrame, url: str, table: str, mode: str = "append", props: dict | None = None) -> None:
    """SNK-14: export to a relational table (sqoop export re-aimed)."""
    w = df.write.format("jdbc").option("url", url).option("dbtable", table).mode(mode)
    for k, v in (props or {}).items():
        w = w.option(k, v)
    w.save()
