"""Slowly changing dimension, type 2 (PIP-03, PIP-04, TBL-06, JON-08/10, SET-01).

Spark's built-in Parquet tables have no MERGE, so the merge is written as
what it computes: a new version of the dimension,

    untouched rows  ∪  closed rows  ∪  new current rows of changed keys
                    ∪  rows of keys the dimension has never seen

The merge is one full outer join on the business key: every row of it becomes
one row of the new version, or two where a current row closes and its
successor opens. The dimension and the updates are each read once.
The MERGE's matching rule is kept: a key matches if *any* dimension row has
it, so a key whose rows are all closed is neither updated nor inserted
(Q23), and a NULL value never counts as a change unless ``null_safe``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _changed(dim: DataFrame, updates: DataFrame, key: str, value: str, current: str, null_safe: bool) -> DataFrame:
    cur = dim.filter(F.col(current)).select(F.col(key).alias("_k"), F.col(value).alias("_old"))
    j = updates.join(cur, updates[key] == cur["_k"])
    differs = (~F.col(value).eqNullSafe(F.col("_old"))) if null_safe else (F.col(value) != F.col("_old"))
    return j.filter(differs).drop("_k", "_old")


def staged_updates(dim: DataFrame, updates: DataFrame, key: str = "customerId", value: str = "address",
                   current: str = "current", null_safe: bool = False) -> DataFrame:
    """PIP-03: every update with mergeKey = its key, plus the changed ones
    again with mergeKey = NULL (UNION ALL by name)."""
    keyed = updates.select(F.col(key).alias("mergeKey"), *updates.columns)
    again = _changed(dim, updates, key, value, current, null_safe)
    again = again.select(F.lit(None).cast(updates.schema[key].dataType).alias("mergeKey"), *updates.columns)
    return keyed.unionByName(again)


def scd2_merge(dim: DataFrame, updates: DataFrame, key: str = "customerId", value: str = "address",
               current: str = "current", effective: str = "effectiveDate", end: str = "endDate",
               null_safe: bool = False) -> DataFrame:
    """PIP-04: the dimension after the type-2 merge of ``updates``.

    ``updates`` holds at most one row per key (as a MERGE source must).
    """
    types = {f.name: f.dataType for f in dim.schema.fields}
    old = dim.select(F.struct(*dim.columns).alias("_d"), F.col(key).alias("_dk"))
    sent = updates.select(F.struct(*updates.columns).alias("_u"), F.col(key).alias("_uk"))
    both = old.join(sent, F.col("_dk") == F.col("_uk"), "full_outer")
    was, now = F.col("_d")[value], F.col("_u")[value]
    differs = ~was.eqNullSafe(now) if null_safe else was != now
    met = F.col("_d").isNotNull() & F.col("_u").isNotNull()
    closing = F.coalesce(met & F.col("_d")[current] & differs, F.lit(False))

    def version(of: dict) -> Column:
        return F.struct(*[of[c].cast(types[c]).alias(c) for c in dim.columns])

    kept = {c: F.col("_d")[c] for c in dim.columns}
    closed = kept | {current: F.lit(False), end: F.col("_u")[effective]}
    fresh = {c: F.col("_u")[c] for c in dim.columns if c in updates.columns}
    opened = {c: F.lit(None) for c in dim.columns} | fresh | {current: F.lit(True), end: F.lit(None)}
    rows = (F.when(F.col("_d").isNull(), F.array(version(opened)))
            .when(closing, F.array(version(closed), version(opened)))
            .otherwise(F.array(version(kept))))
    return both.select(F.inline(rows))


def current_rows_check(dim: DataFrame, key: str = "customerId", current: str = "current") -> DataFrame:
    """Property: at most one current row per key. Returns the offending keys."""
    return (dim.filter(F.col(current)).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > 1))
