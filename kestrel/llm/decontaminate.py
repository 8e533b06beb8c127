"""Benchmark decontamination by winnowing (operator 3).

A window is ``window`` consecutive words of a benchmark item (the whole item
if it has fewer words). A document word inside any occurrence of a window is
hit.

Winnowing: of every ``window - gram + 1`` consecutive ``gram``-word hashes
the least is kept as a fingerprint. Equal windows keep equal fingerprints, so
every shared window meets in the join of document and benchmark fingerprints;
each meeting is extended word by word to both sides, and counts if at least
``window`` words agree. Items of fewer words join on the hash of all their
words (winnowing windows of one gram).

The benchmark is the smaller side. Its text is measured first. Up to
``index_bytes`` its index is broadcast and one pass over the documents, without
a shuffle, does the join. Beyond that, documents go into blocks; blocks and
items meet by fingerprint in a shuffle, and each block gets just the items that
share a fingerprint with it.

Defined cases: null texts have no words; rows with a null doc_id are judged
like any other; items with a null item_id hit words but are in no list; equal
item_ids are one item; equal texts under different ids are each listed;
repeated document rows each return a row; empty tables give rows without hits,
or no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import (ALNUM_WORDS, BLOCK_BYTES, LOWER, U64, Words, blocks, bucket_of, cuts, free_name, grams, member, ranges, slices,
                                sliding_min, text_bytes, work_path)

WINDOW = 10
GRAM = 5
INDEX_BYTES = 32 << 20


def words_of(column) -> tuple[Words, np.ndarray]:
    data, off = text_bytes(column)
    w = Words(LOWER[data], off, ALNUM_WORDS)
    return w, w.hashes()


def winnow(w: Words, h: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, fingerprints) kept of the texts of at least ``window`` words."""
    if w.n < window:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    g, span = grams(h, gram), window - gram + 1
    low = sliding_min(g, span)
    low[~w.fits(window)[: len(low)]] = 0
    edge = np.zeros(span - 1, U64)
    best = ~sliding_min(~np.r_[edge, low, edge], span)  # the largest minimum of the windows around each gram
    at = np.flatnonzero(g == best)
    return at, g[at]


class Index:
    """Benchmark items by fingerprint."""

    def __init__(self, ids: list, texts, window: int, gram: int):
        self.ids, self.window, self.gram = ids, window, gram
        w, self.h = words_of(texts)
        self.item = w.doc()
        self.first, self.last = np.repeat(w.ptr[:-1], w.count), np.repeat(w.ptr[1:], w.count)
        at, fp = winnow(w, self.h, window, gram)
        order = np.argsort(fp, kind="stable")
        self.long = fp[order], at[order]
        self.short = {}
        for n in np.unique(w.count[(w.count > 0) & (w.count < window)]).tolist():
            at = w.ptr[:-1][w.count == n]
            fp = grams(self.h, n)[at]
            order = np.argsort(fp, kind="stable")
            self.short[n] = fp[order], at[order]

    def keys(self) -> np.ndarray:
        return np.concatenate([self.long[0], *(fp for fp, _ in self.short.values())])

    def _meet(self, at, fp, side):
        """Pairs (document place, item place) of equal fingerprints."""
        keys, places = side
        one, start = np.unique(keys, return_index=True)
        got = member(fp, one)
        at, got = at[got >= 0], got[got >= 0]
        count = np.diff(np.r_[start, len(keys)])[got]
        return np.repeat(at, count), places[ranges(start[got], count)]

    def hits(self, w: Words, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hit words as a mask, and the distinct pairs text, item)."""
        n, first, last = w.n, np.repeat(w.ptr[:-1], w.count), np.repeat(w.ptr[1:], w.count)
        begin, end, item = [], [], []
        p, q = self._meet(*winnow(w, h, self.window, self.gram), self.long)
        reach = self.window - self.gram
        left, right = np.zeros(len(p), np.int64), np.full(len(p), self.gram)
        same = np.ones(len(p), bool)
        for i in range(self.gram):
            same &= h[p + i] == self.h[q + i]
        p, q, left, right = p[same], q[same], left[same], right[same]
        for side, out in ((-1, left), (1, right)):
            go = np.ones(len(p), bool)
            for i in range(1, reach + 1):
                a, b = (p - i, q - i) if side < 0 else (p + self.gram - 1 + i, q + self.gram - 1 + i)
                go &= (a >= first[p]) & (a < last[p]) & (b >= self.first[q]) & (b < self.last[q])
                go[go] = h[a[go]] == self.h[b[go]]
                out[go] += 1
        full = left + right >= self.window
        begin.append((p - left)[full])
        end.append((p + right)[full])
        item.append(self.item[q[full]])
        for k, side in self.short.items():
            g = grams(h, k)
            at = np.flatnonzero(w.fits(k)[: len(g)])
            p, q = self._meet(at, g[at], side)
            same = np.ones(len(p), bool)
            for i in range(k):
                same &= h[p + i] == self.h[q + i]
            begin.append(p[same])
            end.append(p[same] + k)
            item.append(self.item[q[same]])
        begin, end, item = map(np.concatenate, (begin, end, item))
        step = np.zeros(n + 1, np.int64)
        np.add.at(step, begin, 1)
        np.add.at(step, end, -1)
        text = np.searchsorted(w.ptr, begin, "right") - 1
        pair = np.unique(text * max(1, len(self.ids)) + item)
        return np.cumsum(step)[:n] > 0, pair // max(1, len(self.ids)), pair % max(1, len(self.ids))


_HITS = "doc_id long, n_words long, n_hit long, spans array<struct<first:int,n:int>>, items array<string>"
_SPANS = pa.list_(pa.struct([("first", pa.int32()), ("n", pa.int32())]))


def _judge(part, index: Index | None) -> pa.RecordBatch:
    w, h = words_of(part.column("text"))
    mask, text, item = index.hits(w, h) if index else (np.zeros(w.n, bool), np.zeros(0, int), np.zeros(0, int))
    n_hit = np.diff(np.r_[0, np.cumsum(mask)][w.ptr])
    spans, items = [[] for _ in w.count], [[] for _ in w.count]
    for i in np.flatnonzero(n_hit).tolist():
        m = mask[w.ptr[i]: w.ptr[i + 1]].astype(np.int8)
        edge = np.flatnonzero(np.diff(np.r_[0, m, 0]))
        spans[i] = [{"first": int(a), "n": int(b - a)} for a, b in zip(edge[::2], edge[1::2], strict=True)]
    for i, j in zip(text.tolist(), item.tolist(), strict=True):
        if index.ids[j] is not None:
            items[i].append(index.ids[j])
    ids = part.column("doc_id")
    ids = ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids
    return pa.record_batch([ids, pa.array(w.count, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(spans, _SPANS), pa.array([sorted(set(x)) for x in items], pa.list_(pa.string()))], names=["doc_id", "n_words", "n_hit", "spans", "items"])


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")


def _broadcast(benchmark: DataFrame, window: int, gram: int, index_bytes: int):
    """The broadcast index, or None if the items' text is over ``index_bytes``."""
    items = _items(benchmark)
    # 64 bytes stand for the id and offsets of an item
    if (items.agg(F.sum(F.octet_length("text") + F.coalesce(F.octet_length("item_id"), F.lit(0)) + 64)).first()[0] or 0) > index_bytes:
        return None
    got = items.toArrow()
    return benchmark.sparkSession.sparkContext.broadcast(Index(got["item_id"].to_pylist(), got["text"], window, gram))


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """(doc_id, n_words, n_hit, spans of hit words, sorted distinct ids of the items with an occurring window)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = _broadcast(benchmark, window, gram, index_bytes)
    if known is None:
        return _by_join(docs, _items(benchmark), window, gram)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield _judge(part, known.value)

    return docs.mapInArrow(run, _HITS)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """The rows of ``docs``, all columns, without a hit word.

    Beyond ``index_bytes`` the rows are numbered, written to the shared folder
    and taken out by their number: ids, null or repeated, decide nothing.
    """
    known = _broadcast(benchmark, window, gram, index_bytes)
    if known is None:
        spark, row, path = docs.sparkSession, free_name(docs, "_row"), work_path(docs.sparkSession, "numbered")
        docs.withColumn(row, F.monotonically_increasing_id()).write.parquet(path)
        held = spark.read.parquet(path)
        texts = held.select(F.col(row).alias("doc_id"), F.col("text").cast("string").alias("text"))
        hit = _by_join(texts, _items(benchmark), window, gram).where("n_hit > 0").select(F.col("doc_id").alias("_hit"))
        return held.join(hit, held[row] == hit["_hit"], "left_anti").select(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                w, h = words_of(part.column("text"))
                mask = known.value.hits(w, h)[0]
                yield part.filter(pa.array(np.diff(np.r_[0, np.cumsum(mask)][w.ptr]) == 0))

    return docs.mapInArrow(run, docs.schema)


# ------------------------------------------------ benchmarks beyond the broadcast limit

def _send_documents(window: int, gram: int, lengths: tuple[int, ...], n_buckets: int):
    def run(rows: pa.Table) -> pa.Table:
        w, h = words_of(rows["text"])
        keys = [winnow(w, h, window, gram)[1]]
        for k in lengths:
            g = grams(h, k)
            keys.append(g[w.fits(k)[: len(g)]])
        key = np.unique(np.concatenate(keys))
        b = int(rows["_b"][0].as_py())
        got = [(i, b, key[x:y].tobytes()) for i, x, y in cuts(bucket_of(key, n_buckets))]
        return pa.table([pa.array([g[j] for g in got], t) for j, t in enumerate((pa.int32(), pa.int32(), pa.binary()))], names=["bucket", "_b", "keys"])

    return run


def _send_items(window: int, gram: int, n_buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", BLOCK_BYTES // 8):
                for row in range(part.num_rows):
                    one = part.slice(row, 1)
                    key = np.unique(Index([None], one.column("text"), window, gram).keys())
                    n = len(key)
                    if n:
                        yield pa.record_batch([pa.array(bucket_of(key, n_buckets), pa.int32()), pa.array(key.view(np.int64)), pa.array(one.column("no").to_pylist() * n, pa.int64())], names=["bucket", "key", "no"])

    return run


def _answer(docs: pa.Table, items: pa.Table) -> pa.Table:
    """To each block: the numbers of the items that share a key with it."""
    blocks_, numbers = [], []
    if docs.num_rows and items.num_rows:
        key, no = items["key"].to_numpy().view(U64), items["no"].to_numpy()
        order = np.argsort(key, kind="stable")
        key, no = key[order], no[order]
        one, start = np.unique(key, return_index=True)
        size = np.diff(np.r_[start, len(key)])
        for b, blob in zip(docs["_b"].to_pylist(), docs["keys"], strict=True):
            at = member(np.frombuffer(blob.as_py(), U64), one)
            at = at[at >= 0]
            got = np.unique(no[ranges(start[at], size[at])])
            blocks_ += [b] * len(got)
            numbers.append(got)
    return pa.table([pa.array(blocks_, pa.int32()), pa.array(np.concatenate(numbers) if numbers else [], pa.int64())], names=["_b", "no"])


def _by_join(docs: DataFrame, items: DataFrame, window: int, gram: int) -> DataFrame:
    spark = docs.sparkSession
    items = items.withColumn("no", F.xxhash64("item_id", "text")).dropDuplicates(["item_id", "text"])
    lengths = _short_lengths(items, window)
    base, n = blocks(docs)
    n_buckets = max(n, int(spark.conf.get("spark.sql.shuffle.partitions")))
    sent = base.groupBy("_b").applyInArrow(_send_documents(window, gram, lengths, n_buckets), "bucket int, _b int, keys binary")
    keys = items.select("no", "text").mapInArrow(_send_items(window, gram, n_buckets), "bucket int, key long, no long")
    wanted = sent.groupBy("bucket").cogroup(keys.groupBy("bucket")).applyInArrow(_answer, "_b int, no long").distinct()

    def run(rows: pa.Table, got: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return pa.Table.from_batches([], schema=_judge(pa.table({"doc_id": pa.array([], pa.int64()), "text": pa.array([], pa.string())}), None).schema)
        index = Index(got["item_id"].to_pylist(), got["text"], window, gram) if got.num_rows else None
        return pa.Table.from_batches([_judge(rows, index)])

    near = wanted.join(items, "no").select("_b", "item_id", "text")
    return base.groupBy("_b").cogroup(near.groupBy("_b")).applyInArrow(run, _HITS)


def _short_lengths(items: DataFrame, window: int) -> tuple[int, ...]:
    """Word counts below ``window`` that items have (``window`` - 1 values at most)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = np.unique(words_of(batch.column("text"))[0].count)
            yield pa.record_batch([pa.array(n[(n > 0) & (n < window)], pa.int64())], names=["n"])

    return tuple(sorted(r["n"] for r in items.select("text").mapInArrow(run, "n long").distinct().collect()))
