"""Hash-map upkeep and the three extracts of the gold table (PIP-12, PIP-13,
HSH-01, JON-02, FLT-02, SNK-09, SNK-10).

The reference runs one file at a time; here every extract covers all files
of the gold table in one job and writes one directory per file name
(``partitionBy("file_name")``), which replaces the part-file renaming.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.functions.scalars import hash_ip
from kestrel.operators.quality import has_rows
from kestrel.sources.readers import read_if_there

HASH_MAP_SCHEMA = "hash_ip_addr string, ip string, source_date date"


def read_hash_map(spark: SparkSession, path: str) -> DataFrame:
    found = read_if_there(spark, path, HASH_MAP_SCHEMA)
    return spark.createDataFrame([], HASH_MAP_SCHEMA) if found is None else found


def upkeep_hash_map(spark: SparkSession, ips: DataFrame, path: str, salt: str = "") -> DataFrame:
    """PIP-12 (+Q22): the hash map is partitioned by ``source_date``; for each
    date of ``ips`` (columns ip, source_date) that has no partition yet, the
    distinct ips are hashed and written as that date's partition. Dates
    already present are left alone, so a rerun writes nothing. Returns the
    map as stored."""
    have = read_hash_map(spark, path).select("source_date").distinct()
    todo = ips.join(have, "source_date", "left_anti").select("ip", "source_date").distinct()
    if has_rows(todo):
        (todo.select(hash_ip("ip", salt).alias("hash_ip_addr"), "ip", "source_date")
         .hint("rebalance", "source_date")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("source_date").parquet(path))
    return read_hash_map(spark, path)


def partner_ids(gold: DataFrame) -> DataFrame:
    """PIP-13 first extract: partner ids longer than 2 characters (drops the
    '0' sentinel)."""
    return gold.filter(F.length("nu_uhid") > 2).select("file_name", "nu_uhid")


def ids(gold: DataFrame) -> DataFrame:
    """PIP-13 second extract: ids longer than 2 characters that have a
    partner id or an ip."""
    return (gold.filter(F.length("uhid") > 2)
            .filter((F.length("nu_uhid") > 2) | (F.length("hash_ip_addr") > 2))
            .select("file_name", "uhid"))


def unhashed_ips(gold: DataFrame, hash_map: DataFrame, since=None) -> DataFrame:
    """PIP-13 third extract (JON-02): hashed ips of the gold rows turned back
    into ips through the hash map.

    Of the map only the pairs that the gold rows ask for are brought to one
    each, not every pair of every date; ``since`` (a date) leaves out older
    partitions of the map unread."""
    h = gold.filter(F.length("hash_ip_addr") > 2).select("file_name", "hash_ip_addr")
    m = hash_map if since is None else hash_map.where(F.col("source_date") >= F.lit(since))
    m = m.join(h.select("hash_ip_addr").distinct(), "hash_ip_addr", "left_semi").select("hash_ip_addr", "ip").distinct()
    return h.join(m, "hash_ip_addr").select("file_name", F.col("ip").alias("unhash_ip_addr"))


#: The extracts by kind, each of (gold rows, hash map), their column, and what their file names begin with.
EXTRACTS = {"nu": lambda gold, _map: partner_ids(gold), "uh": lambda gold, _map: ids(gold), "ip": unhashed_ips}
COLUMNS = {"nu": "nu_uhid", "uh": "uhid", "ip": "unhash_ip_addr"}
PREFIX = {"nu": "", "uh": "uh_", "ip": "ip_"}


def publish_extracts(gold: DataFrame, hash_map: DataFrame, base: str) -> str:
    """PIP-13 / SNK-10 / STR-08: all three extracts below ``<base>/published/``, one
    directory for each of ``<file>``, ``uh_<file>`` and ``ip_<file>``, written in
    one job; a file's earlier extracts are replaced."""
    out = None
    for kind, make in EXTRACTS.items():
        part = make(gold, hash_map).select(F.concat(F.lit(PREFIX[kind]), "file_name").alias("file_name"), F.col(COLUMNS[kind]).alias("value"))
        out = part if out is None else out.unionByName(part)
    return write_extract(out, base, "published")


def write_extract(df: DataFrame, base: str, kind: str, files: int | None = None) -> str:
    """SNK-09 / SNK-10: headerless gzip CSV, one directory per file name under
    ``<base>/<kind>/``; overwrite replaces an earlier extract of the same
    file. ``files`` caps the file count per task set (1 = single file, only
    for small extracts)."""
    path = f"{base}/{kind}"
    out = df.coalesce(files) if files else df.hint("rebalance", "file_name")
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("compression", "gzip").option("header", False).partitionBy("file_name").csv(path))
    return path


def read_extract(spark: SparkSession, path: str, column: str) -> DataFrame:
    return spark.read.schema(f"{column} string, file_name string").option("header", False).csv(path)
