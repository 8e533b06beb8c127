"""Connected components of an edge list by alternating large-star and small-star rounds.

Each round is two partial aggregates and two joins; the rounds grow with the
logarithm of the longest chain. A node with very many neighbours is spread
over ``SALTS`` join keys, its minimum (one row) is repeated for each. Lineage
is cut with ``checkpoint()`` in the shared folder after each round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.session import shared_dir

SALTS = 16


def _with_least(pairs: DataFrame) -> DataFrame:
    """(u, v, m): m is the least of u and its neighbours."""
    least = pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    least = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return pairs.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")).join(least, ["u", "salt"])


def _pairs(frame: DataFrame, u, v) -> DataFrame:
    return frame.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u <> v")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v); root is the least node of its component.

    Loops and repeated edges change nothing; edges with a null end are left out.
    """
    shared_dir(edges.sparkSession)
    e = _pairs(edges.where("u is not null and v is not null"), "u", "v")
    e = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct().checkpoint()
    before = None
    while True:
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _pairs(_with_least(both).where("v > u"), "v", "m").distinct()
        small = _with_least(large)
        e = _pairs(small, "v", "m").unionAll(_pairs(small, "u", "m")).distinct().checkpoint()
        now = e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("u").cast("decimal(38,0)"))).first()
        if now == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = now
