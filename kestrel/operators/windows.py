"""Window analytics: moving averages, latest row per key, top-N, suffix
maximum, leave-one-out product, whole-group averages.

Skew. A plain ``Window.partitionBy(key)`` sends every row of a key to one
task; with one key holding a third of the data that task sorts a third of
the data. The ordered operators here therefore take a *chunk* column — a
coarse, order-preserving function of the order key (the day of a
timestamp, or the number that :func:`sampled_chunks` finds where a key is hot
within any such unit) — and run the window on ``(key, chunk)``. What a
row needs from outside its chunk (the neighbour rows at chunk borders,
the totals of earlier chunks) comes from a per-(key, chunk) table that has
one row per chunk: it is built by map-side combined aggregation and
windowed per key, so its size grows with the number of chunks (days),
not with the rows. The chunk table is joined back null-safely, so rows with a
null key or a null order value stay, as in the plain window.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.functions.scalars import exact
from kestrel.session import shared_dir


def _cols(xs) -> list[str]:
    return [xs] if isinstance(xs, str) else list(xs)


def join_back(rows: DataFrame, per_key: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join of rows with a one-row-per-key table; null keys are keys like any other."""
    named = per_key.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in per_key.columns if c not in keys])
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return rows.join(named, cond).drop(*[f"_k_{k}" for k in keys])


def sampled_chunks(df: DataFrame, keys, order, chunks: int | None = None, alias: str = "_c") -> DataFrame:
    """``df`` with a chunk number that rises with (keys, order) and holds about as
    many rows as any other, however the rows lie in time.

    The bounds are those of a range exchange, which Spark samples from the rows:
    a key with a third of the rows gets a third of the chunks, be it within one
    hour, while small keys share one. Rows equal in (keys, order) are in one
    chunk, nulls come first. The chunk is the partition number, so the frame
    is checkpointed in the shared folder: whatever reads it, and however often,
    sees the same bounds.
    """
    by = [*_cols(keys), *_cols(order)]
    parted = df.repartitionByRange(chunks, *by) if chunks else df.repartitionByRange(*by)
    shared_dir(df.sparkSession)
    return parted.withColumn(alias, F.spark_partition_id()).checkpoint()


def centered_moving_avg(df: DataFrame, keys, order: str, tie: str, measures,
                        chunk: Column | None = None, suffix: str = "_ma", value_type: str | None = None) -> DataFrame:
    """WIN-01: average of the previous, current and next row per key
    (``rowsBetween(-1, 1)``), for each measure. Sums are exact in
    ``value_type`` (see ``scalars.exact``).
    """
    keys = _cols(keys)
    measures = _cols(measures)
    chunk = F.to_date(F.col(order)) if chunk is None else chunk
    base = df.withColumn("_c", chunk)
    w = Window.partitionBy(*keys, "_c").orderBy(order, tie)
    inner = base
    for m in measures:
        inner = (inner.withColumn(f"_p_{m}", F.lag(m).over(w))
                 .withColumn(f"_n_{m}", F.lead(m).over(w)))
    inner = (inner.withColumn("_first", F.lag(F.lit(1)).over(w).isNull())
             .withColumn("_last", F.lead(F.lit(1)).over(w).isNull()))
    ordering = F.struct(F.col(order), F.col(tie))
    vals = F.struct(*[F.col(m).alias(m) for m in measures])
    chunks = base.groupBy(*keys, "_c").agg(F.min_by(vals, ordering).alias("_cf"),
                                           F.max_by(vals, ordering).alias("_cl"))
    wc = Window.partitionBy(*keys).orderBy("_c")
    chunks = chunks.select(*keys, "_c", F.lag("_cl").over(wc).alias("_prev_last"),
                           F.lead("_cf").over(wc).alias("_next_first"))
    out = join_back(inner, chunks, [*keys, "_c"])
    for m in measures:
        prev = F.when(F.col("_first"), F.col("_prev_last")[m]).otherwise(F.col(f"_p_{m}"))
        nxt = F.when(F.col("_last"), F.col("_next_first")[m]).otherwise(F.col(f"_n_{m}"))
        trio = [prev, F.col(m), nxt]
        trio_exact = [F.coalesce(exact(x, df.schema[m].dataType, value_type), F.lit(0)) for x in trio]
        total = trio_exact[0] + trio_exact[1] + trio_exact[2]
        n = sum((x.isNotNull().cast("int") for x in trio[1:]), trio[0].isNotNull().cast("int"))
        out = out.withColumn(m + suffix, F.when(n > 0, total.cast("double") / n.cast("double")))
    drop = ["_c", "_first", "_last", "_prev_last", "_next_first"]
    drop += [f"_p_{m}" for m in measures] + [f"_n_{m}" for m in measures]
    return out.drop(*drop)


def running_totals(df: DataFrame, keys, measures, value_type: str | None = None) -> DataFrame:
    """Per key the exact sum and the count of each measure, as ``running_avg`` takes them for an opening."""
    aggs = []
    for m in _cols(measures):
        aggs += [F.sum(exact(F.col(m), df.schema[m].dataType, value_type)).alias(f"{m}_sum"), F.count(m).alias(f"{m}_count")]
    return df.groupBy(*_cols(keys)).agg(*aggs)


def running_avg(df: DataFrame, keys, order: Column, measures, chunk: Column,
                suffix: str = "_avg", value_type: str | None = None, opening: DataFrame | None = None) -> DataFrame:
    """WIN-02: average from the first row of the key up to the current row
    and its peers (the default RANGE frame of an ordered window).

    ``order`` must be a column expression; ``chunk`` an order-preserving
    coarsening of it (peers then always share a chunk). ``opening`` holds what
    came before the rows of ``df``: at most one row per key, with
    ``<measure>_sum`` and ``<measure>_count`` (see :func:`running_totals`).
    """
    keys = _cols(keys)
    measures = _cols(measures)
    base = df.withColumn("_o", order).withColumn("_c", chunk)
    w = Window.partitionBy(*keys, "_c").orderBy("_o")
    inner = base
    aggs = []
    for m in measures:
        inner = (inner.withColumn(f"_s_{m}", F.sum(exact(F.col(m), df.schema[m].dataType, value_type)).over(w))
                 .withColumn(f"_k_{m}", F.count(m).over(w)))
        aggs += [F.sum(exact(F.col(m), df.schema[m].dataType, value_type)).alias(f"_cs_{m}"), F.count(m).alias(f"_ck_{m}")]
    chunks = base.groupBy(*keys, "_c").agg(*aggs)
    before = Window.partitionBy(*keys).orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    sel = [*keys, "_c"]
    for m in measures:
        sel += [F.coalesce(F.sum(f"_cs_{m}").over(before), F.lit(0)).alias(f"_bs_{m}"),
                F.coalesce(F.sum(f"_ck_{m}").over(before), F.lit(0)).alias(f"_bk_{m}")]
    chunks = chunks.select(*sel)
    out = join_back(inner, chunks, [*keys, "_c"])
    drop = ["_o", "_c"]
    if opening is not None:
        named = opening.select(*[F.col(k).alias(f"_ok_{k}") for k in keys], *[F.col(f"{m}_{x}").alias(f"_o{x}_{m}") for m in measures for x in ("sum", "count")])
        cond = F.lit(True)
        for k in keys:
            cond = cond & F.col(k).eqNullSafe(F.col(f"_ok_{k}"))
        out = out.join(named, cond, "left").drop(*[f"_ok_{k}" for k in keys])
    for m in measures:
        s = F.coalesce(F.col(f"_s_{m}"), F.lit(0)) + F.col(f"_bs_{m}")
        k = F.col(f"_k_{m}") + F.col(f"_bk_{m}")
        if opening is not None:
            s, k = s + F.coalesce(F.col(f"_osum_{m}"), F.lit(0)), k + F.coalesce(F.col(f"_ocount_{m}"), F.lit(0))
            drop += [f"_osum_{m}", f"_ocount_{m}"]
        out = out.withColumn(m + suffix, F.when(k > 0, s.cast("double") / k.cast("double")))
        drop += [f"_s_{m}", f"_k_{m}", f"_bs_{m}", f"_bk_{m}"]
    return out.drop(*drop)


def group_avg_rows(df: DataFrame, group: str, value: str, alias: str) -> DataFrame:
    """WIN-03: the whole-group average attached to every row (order key =
    partition key, so every row is a peer). Written as aggregate + join: the
    aggregate combines map-side and has one row per group; Spark broadcasts it
    while it is small. Rows of a null group get that group's average."""
    g = df.groupBy(group).agg((F.sum(value).cast("double") / F.count(value)).alias(alias))
    return join_back(df, g, [group])


def latest_per_key(df: DataFrame, key: str, order_cols, cols=None) -> DataFrame:
    """WIN-06: the latest row per key by ``order_cols`` (desc, last = tie-break).

    ``max_by`` over a struct is an ordinary aggregate: it combines on the
    map side, so a key with a third of the rows costs one row per map task
    in the shuffle (a ``row_number()`` window would sort all of them in one
    task).
    """
    order_cols = _cols(order_cols)
    cols = [c for c in (cols or df.columns) if c != key]
    rec = F.struct(*[F.col(c) for c in cols])
    best = df.groupBy(key).agg(F.max_by(rec, F.struct(*[F.col(c) for c in order_cols])).alias("_r"))
    return best.select(key, *[F.col("_r")[c].alias(c) for c in cols])


def suffix_max(df: DataFrame, group: str, order: str, value: str, tie: str | None = None,
               alias: str = "next_max", chunk: Column | None = None) -> DataFrame:
    """WIN-08: max of the later rows of the group; -1 for the last row and
    for a row strictly greater than every later row.

    With ``chunk`` (an order-preserving coarsening of ``order``) the window
    runs per (group, chunk) and the maximum of all later chunks comes from
    a one-row-per-chunk table, so a huge group is spread over its chunks.
    """
    # the later rows are the rows before in descending order: a frame that only grows costs one step a row
    ords = [F.col(c).desc() for c in [order] + ([tie] if tie else [])]
    if chunk is None:
        w = Window.partitionBy(group).orderBy(*ords).rowsBetween(Window.unboundedPreceding, -1)
        later = F.max(value).over(w)
        return df.withColumn(alias, F.when(later.isNull() | (F.col(value) > later), F.lit(-1))
                             .otherwise(later))
    base = df.withColumn("_c", chunk)
    w = Window.partitionBy(group, "_c").orderBy(*ords).rowsBetween(Window.unboundedPreceding, -1)
    inner = base.withColumn("_in", F.max(value).over(w))
    after = Window.partitionBy(group).orderBy(F.col("_c").desc()).rowsBetween(Window.unboundedPreceding, -1)
    chunks = (base.groupBy(group, "_c").agg(F.max(value).alias("_cm"))
              .select(group, "_c", F.max("_cm").over(after).alias("_out")))
    j = join_back(inner, chunks, [group, "_c"])
    later = F.greatest(F.col("_in"), F.col("_out"))
    return (j.withColumn(alias, F.when(later.isNull() | (F.col(value) > later), F.lit(-1)).otherwise(later))
            .drop("_c", "_in", "_out"))


#: Two to this power is beyond every bigint, so no group has a result with more other values than that of 2 or more.
_MOST_FACTORS = 64


def product_except_self(df: DataFrame, group: str, value: str, alias: str = "product_others") -> DataFrame:
    """WIN-09: product of all other rows of the group (order free), exact, for a
    column of whole numbers. A row's result is null only if it does not fit a
    bigint itself.

    A group is summed up map-side: its zeros, its negative values and its values
    of 2 or more in size. If there are more than 64 of the latter, every result
    without a zero in it is too large, and they are not looked at again; of the
    other groups at most 64 numbers a group are multiplied, in decimal(38,0).
    Beyond 38 digits no row of the group has a result that fits, so an overflow
    means null; below, the row's own value divides the product without rest.
    Null values take no part and give null; null groups are a group.
    """
    kind = df.schema[value].dataType
    if kind.typeName() not in ("byte", "short", "integer", "long") and not (kind.typeName() == "decimal" and kind.scale == 0):
        raise ValueError(f"{value} is no column of whole numbers")
    v = F.col(value).cast("decimal(38,0)")
    sums = df.groupBy(group).agg(F.sum((v == 0).cast("bigint")).alias("_z"), F.sum((v < 0).cast("bigint")).alias("_neg"),
                                 F.sum((F.abs(v) >= 2).cast("bigint")).alias("_m"))
    few = sums.where(F.col("_m").between(1, _MOST_FACTORS)).select(group)
    factors = join_back(df.where(F.abs(v) >= 2).select(group, F.abs(v).alias("_f")), few, [group])
    one = F.lit(1).cast("decimal(38,0)")
    product = F.aggregate(F.collect_list("_f"), one, lambda a, f: F.try_multiply(a, f).cast("decimal(38,0)"))
    products = factors.groupBy(group).agg(product.alias("_p"))
    named = products.select(F.col(group).alias("_k"), "_p")
    per = sums.join(named, F.col(group).eqNullSafe(F.col("_k")), "left").withColumn("_p", F.when(F.col("_m") == 0, one).otherwise(F.col("_p"))).drop("_k")
    j = join_back(df, per, [group]).withColumn("_v", F.abs(v))
    # the size of the result is _p divided by the row's own size, or _p itself for the row of a group's only zero
    own = F.when(F.col("_v") >= 2, F.col("_v")).otherwise(one)
    limit = F.lit(Decimal(2 ** 63))
    negative = (F.col("_neg") - (v < 0).cast("bigint")) % 2 == 1
    size = F.expr("_p div greatest(_v, cast(1 as decimal(38,0)))")
    room = own * limit
    exact_ = (F.when(F.col("_p") < room, F.when(negative, -size).otherwise(size))
              .when((F.col("_p") == room) & negative, F.lit(Decimal(-(2 ** 63))).cast("bigint")))
    res = F.when(v.isNull(), F.lit(None)).when((F.col("_z") >= 2) | ((F.col("_z") == 1) & (v != 0)), F.lit(0)).otherwise(exact_)
    return j.withColumn(alias, res.cast("bigint")).drop("_z", "_neg", "_m", "_p", "_v")
