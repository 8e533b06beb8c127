"""Best-fit packing under conflicts (operator 9).

Documents become sequences of at most ``capacity`` words. A longer document is
cut: each full piece is a bin of its own, the rest is packed like a document.
A bin carries two bitmaps, of the sources and of the duplicate clusters of its
documents, and takes no second document of either. A cluster is a component of
near copies (operator 7), also for rows without an id; with ``near`` off only
exact copies (ASCII case aside) are one, which saves the fingerprints. Bins stand in the order of
what is left of them; the search starts at the smallest residual that holds
the document and goes on to its successors until a bin's bitmaps agree, so the
tightest compatible bin is found. Documents come longest first.

Documents are dealt out at random (by a hash of the id) into shards of about
``shard_rows`` pieces, packed one by one; a source that holds a third of all
documents is spread over all shards. What random shards lose against one
packing of everything is the open end of each shard. Only lengths and keys are
shuffled, not texts.

Defined cases: a null or empty text has no words, and its row no bin; a null
source conflicts with nothing; documents without text are no cluster; repeated
rows are documents of their own (copies, so of one cluster); a null doc_id is
packed like any other; an empty table gives an empty result; other columns are
not looked at.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import ascii_lower
from kestrel.llm.simhash import grouped

CAPACITY = 2048
SHARD_ROWS = 4096

_OUT = "doc_id long, piece int, first_word long, n_words int, bin_id long, place int, bin_words int"


def best_fit(items: list[tuple[int, int, int]], capacity: int) -> list[int]:
    """Bin of each item (words, source bitmap, cluster bitmap); items come in the order they are placed."""
    order: list[tuple[int, int]] = []  # (residual, bin), sorted
    sources: list[int] = []
    clusters: list[int] = []
    out = []
    for words, source, cluster in items:
        at = bisect_left(order, (words, -1))
        while at < len(order) and (sources[order[at][1]] & source or clusters[order[at][1]] & cluster):
            at += 1
        if at < len(order):
            left, b = order.pop(at)
        else:
            left, b = capacity, len(sources)
            sources.append(0)
            clusters.append(0)
        sources[b] |= source
        clusters[b] |= cluster
        insort(order, (left - words, b))
        out.append(b)
    return out


def _bits(values: list, alone: bool) -> list[int]:
    """A bit for each different value; none for null, nor (``alone``) for a value that stands once."""
    seen: dict = {}
    for v in values:
        seen[v] = seen.get(v, 0) + 1
    bit: dict = {None: 0}
    for v in values:
        if v not in bit:
            bit[v] = 0 if alone and seen[v] == 1 else 1 << (len(bit) - 1)
    return [bit[v] for v in values]


def _pack(capacity: int):
    def run(rows: pa.Table) -> pa.Table:
        got = rows.to_pylist()
        # the order does not hang on how the rows arrived
        got.sort(key=lambda r: (-r["n_words"], r["doc_id"] is None, r["doc_id"] or 0, r["piece"], r["cluster"] or 0, r["source"] or ""))
        source, cluster = _bits([r["source"] for r in got], False), _bits([r["cluster"] for r in got], True)
        open_ = [i for i, r in enumerate(got) if r["n_words"] < capacity]
        bins = [None] * len(got)
        for i, b in zip(open_, best_fit([(got[i]["n_words"], source[i], cluster[i]) for i in open_], capacity), strict=True):
            bins[i] = b
        more = max((b for b in bins if b is not None), default=-1) + 1
        for i, b in enumerate(bins):
            if b is None:
                bins[i], more = more, more + 1
        used, place = [0] * more, []
        held = [0] * more
        for r, b in zip(got, bins, strict=True):
            place.append(held[b])
            held[b] += 1
            used[b] += r["n_words"]
        shard = got[0]["shard"]
        return pa.table({
            "doc_id": pa.array([r["doc_id"] for r in got], pa.int64()), "piece": pa.array([r["piece"] for r in got], pa.int32()),
            "first_word": pa.array([r["piece"] * capacity for r in got], pa.int64()), "n_words": pa.array([r["n_words"] for r in got], pa.int32()),
            "bin_id": pa.array([(shard << 32) | b for b in bins], pa.int64()), "place": pa.array(place, pa.int32()), "bin_words": pa.array([used[b] for b in bins], pa.int32()),
        })

    return run


def pack(docs: DataFrame, capacity: int = CAPACITY, shard_rows: int = SHARD_ROWS, near: bool = True) -> DataFrame:
    """(doc_id, piece, first_word, n_words, bin_id, place, bin_words): one row for each piece of each document.

    ``bin_words`` is what the whole bin holds; ``place`` the order inside it.
    A document without words has one row, of a null bin.
    """
    words = F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    source = F.col("source").cast("string") if "source" in docs.columns else F.lit(None).cast("string")
    keys = [source.alias("source"), words.alias("words"), F.xxhash64(ascii_lower(F.col("text"))).alias("copy")]
    if near:
        rows = grouped(docs, keys).withColumnRenamed("root", "cluster")
    else:
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *keys).withColumn("cluster", F.col("copy"))
    # a piece for each full ``capacity`` words and one for the rest
    last = F.when(F.col("words") % capacity == 0, F.expr(f"words div {capacity}") - 1).otherwise(F.expr(f"words div {capacity}"))
    pieces = rows.where("words > 0").withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    pieces = pieces.withColumn("n_words", F.least(F.lit(capacity), F.col("words") - F.col("piece") * capacity).cast("int"))
    # pieces are counted and not documents: long texts have very many
    n_pieces = rows.agg(F.sum(F.ceil(F.col("words") / capacity))).first()[0] or 0
    shards = max(1, -(-int(n_pieces) // shard_rows))
    # rows without an id are spread by their text
    shard = F.pmod(F.xxhash64(F.coalesce("doc_id", "copy"), "piece"), F.lit(shards)).cast("int")
    dealt = pieces.select("doc_id", F.col("piece").cast("int").alias("piece"), "n_words", "source", "cluster", shard.alias("shard"))
    packed = dealt.groupBy("shard").applyInArrow(_pack(capacity), _OUT)
    none = rows.where("words = 0").select("doc_id", F.lit(0).alias("piece"), F.lit(0).cast("long").alias("first_word"), F.lit(0).alias("n_words"),
                                          F.lit(None).cast("long").alias("bin_id"), F.lit(None).cast("int").alias("place"), F.lit(None).cast("int").alias("bin_words"))
    return packed.unionAll(none)
