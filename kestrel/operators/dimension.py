"""A stored type-2 dimension that is merged in place, copy on write (TBL-06, JON-10, PIP-04, SRT-06).

Layout below ``base``::

    data/<commit>/_cur=<true|false>/_bucket=<b>/part-…    rows, never changed once written
    versions/<n>/part-…                                   one file: the folders that version n consists of

Current rows lie apart from closed ones, both by a hash bucket of the key. A
merge reads the current rows of the buckets that the updates name, and of the
closed rows there the keys alone. It writes anew only the current rows of buckets
in which something changes, and the rows it closes as a further folder; all other
folders go over into the next version as they are. The version file is written
last, by one task, so it is there whole or not at all: a merge that dies before
leaves the old version in force and a commit folder that nothing names. Two
merges from one version cannot both publish, as the second finds the file there.

The driver sees one row for each folder (two times the buckets, and one more for
each bucket that a merge has closed rows in).
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kestrel.sources.readers import read_if_there

#: Current rows that a bucket is aimed at when a dimension is created.
BUCKET_ROWS = 1_000_000
_VERSION = "version long, buckets int, schema string, current boolean, bucket int, folder string"


@dataclass(frozen=True)
class Names:
    """Column names of a dimension."""
    key: str = "customerId"
    value: str = "address"
    current: str = "current"
    effective: str = "effectiveDate"
    end: str = "endDate"


@dataclass(frozen=True)
class Version:
    number: int
    buckets: int
    schema: StructType
    #: (current, bucket, commit)
    folders: frozenset


def versions(spark: SparkSession, base: str) -> DataFrame | None:
    """Every version's folders; None if there is no dimension."""
    return read_if_there(spark, f"{base}/versions/*", _VERSION)


def latest(spark: SparkSession, base: str, number: int | None = None) -> Version:
    """The version in force, or the given one."""
    all_ = versions(spark, base)
    if all_ is None:
        raise ValueError(f"no dimension at {base}")
    if number is None:
        number = all_.agg(F.max("version")).first()[0]
    rows = all_.where(F.col("version") == number).collect()
    if not rows:
        raise ValueError(f"no version {number} at {base}")
    return Version(number, rows[0]["buckets"], StructType.fromJson(json.loads(rows[0]["schema"])),
                   frozenset((r["current"], r["bucket"], r["folder"]) for r in rows if r["folder"] is not None))


def read(spark: SparkSession, base: str, version: Version | None = None, current: bool | None = None, buckets=None) -> DataFrame:
    """The rows of a version, of its current or closed part only, or of some buckets only."""
    v = version or latest(spark, base)
    paths = [f"{base}/data/{folder}/_cur={str(cur).lower()}/_bucket={b}" for cur, b, folder in sorted(v.folders)
             if (current is None or cur == current) and (buckets is None or b in buckets)]
    return spark.read.schema(v.schema).parquet(*paths) if paths else spark.createDataFrame([], v.schema)


def ordered(dim: DataFrame, names: Names = Names()) -> DataFrame:
    """SRT-06: by key, the versions of a key from the oldest on."""
    return dim.orderBy(names.key, names.effective, F.col(names.end).asc_nulls_last())


def _bucket(key: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")


def _write(rows: DataFrame, base: str) -> list[tuple[bool, int, str]]:
    """Writes rows with ``_cur`` and ``_bucket`` as a commit; returns its folders."""
    commit = uuid.uuid4().hex
    path = f"{base}/data/{commit}"
    rows.hint("rebalance", "_cur", "_bucket").write.partitionBy("_cur", "_bucket").parquet(path)
    parts = "_cur boolean, _bucket int"
    # folder names alone answer this
    found = rows.sparkSession.read.schema(parts).parquet(path).select("_cur", "_bucket").distinct().collect()
    return [(r["_cur"], r["_bucket"], commit) for r in found if r["_bucket"] is not None]


def publish(spark: SparkSession, base: str, number: int, buckets: int, schema: StructType, folders) -> None:
    """Version ``number`` in force; an error if it is there already."""
    rows = [(number, buckets, schema.json(), *f) for f in sorted(folders)] or [(number, buckets, schema.json(), None, None, None)]
    spark.createDataFrame(rows, _VERSION).coalesce(1).write.mode("errorifexists").parquet(f"{base}/versions/{number:012d}")


def create(dim: DataFrame, base: str, names: Names = Names(), buckets: int | None = None) -> int:
    """Stores ``dim`` as version 0. The number of buckets stays for good."""
    spark = dim.sparkSession
    n = buckets or max(1, -(-dim.where(F.col(names.current)).count() // BUCKET_ROWS))
    rows = dim.withColumn("_cur", F.coalesce(F.col(names.current), F.lit(False))).withColumn("_bucket", _bucket(F.col(names.key), n))
    publish(spark, base, 0, n, dim.schema, _write(rows, base))
    return 0


def stage_merge(spark: SparkSession, base: str, updates: DataFrame, names: Names = Names(), null_safe: bool = False) -> tuple[Version, frozenset] | None:
    """Writes what a merge changes; (version it starts from, folders of the next one), or None if nothing changes.
    Nothing of it is in force before :func:`publish`."""
    v, key = latest(spark, base), names.key
    upd = updates.withColumn("_bucket", _bucket(F.col(key), v.buckets))
    asked = {r["_bucket"] for r in upd.select("_bucket").distinct().collect()}
    now = read(spark, base, v, True, asked).select(F.col(key).alias("_k"), F.col(names.value).alias("_old"))
    gone = read(spark, base, v, False, asked).select(F.col(key).alias("_k"))
    differs = ~F.col(names.value).eqNullSafe(F.col("_old")) if null_safe else F.col(names.value) != F.col("_old")
    changed = upd.join(now, upd[key] == now["_k"]).where(differs).drop("_k", "_old").withColumn("_new", F.lit(False))
    # a key that any row has, current or closed, is not inserted
    unknown = upd.join(now, upd[key] == now["_k"], "left_anti").join(gone, F.col(key) == gone["_k"], "left_anti").withColumn("_new", F.lit(True))
    # read three times below: the changes alone, in the shared folder
    path = f"{base}/staged/{uuid.uuid4().hex}"
    changed.unionByName(unknown).write.parquet(path)
    delta = spark.read.schema(changed.schema).parquet(path)
    rewritten = {r["_bucket"] for r in delta.select("_bucket").distinct().collect()}
    if not rewritten:
        return None
    held = read(spark, base, v, True, rewritten)
    ends = delta.where("not _new").select(F.col(key).alias("_k"), F.col(names.effective).alias("_end"))
    staying = held.join(ends, held[key] == ends["_k"], "left_anti")
    closed = held.join(ends, held[key] == ends["_k"])
    types = {f.name: f.dataType for f in v.schema.fields}
    closed = closed.select(*[{names.current: F.lit(False), names.end: F.col("_end")}.get(c, F.col(c)).cast(types[c]).alias(c) for c in types])
    special = {names.current: F.lit(True), names.end: F.lit(None)}
    opened = delta.select(*[(special.get(c) if c in special else F.col(c) if c in updates.columns else F.lit(None)).cast(types[c]).alias(c) for c in types])
    rows = staying.unionByName(opened).withColumn("_cur", F.lit(True)).unionByName(closed.withColumn("_cur", F.lit(False)))
    written = _write(rows.withColumn("_bucket", _bucket(F.col(key), v.buckets)), base)
    return v, frozenset(f for f in v.folders if not (f[0] and f[1] in rewritten)) | frozenset(written)


def merge(spark: SparkSession, base: str, updates: DataFrame, names: Names = Names(), null_safe: bool = False) -> int:
    """PIP-04 on a stored dimension; the number of the version then in force. ``updates`` holds at most one row per key."""
    staged = stage_merge(spark, base, updates, names, null_safe)
    if staged is None:
        return latest(spark, base).number
    v, folders = staged
    publish(spark, base, v.number + 1, v.buckets, v.schema, folders)
    return v.number + 1
