"""Helpers shared by the operators: tables, word positions and hashes in numpy, blocks of documents.

Texts reach Python as Arrow string columns. The helpers look at the UTF-8
bytes of a whole batch at once: a 256-entry table says which byte values
belong to a word, word borders are found by comparing neighbours, and the
hash of every word (or of every run of k words) comes from one prefix sum.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.session import shared_dir

#: Text bytes that one block of documents is aimed at.
BLOCK_BYTES = 4 << 20

#: Text bytes that one slice of an Arrow batch is aimed at; numpy needs some fifty times as much for a moment.
SLICE_BYTES = 1 << 20

#: Text bytes (or values) that are hashed at a time: their powers and sums are all that hashing holds beside its result.
HASH_BYTES = 1 << 18

U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one (spark.checkpoint.dir)."""
    return f"{shared_dir(spark)}/kestrel-llm/{name}-{uuid.uuid4().hex[:12]}"


def free_name(docs: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``docs`` is called so (case aside)."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def ascii_lower(col):
    """A-Z to a-z and nothing else."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---------------------------------------------------------------- words

#: Words are what stands between ASCII white space.
SPACE_WORDS = np.ones(256, bool)
SPACE_WORDS[[0x20, *range(0x09, 0x0E)]] = False

#: Words of digits, a-z and everything beyond ASCII (for lower-cased texts).
ALNUM_WORDS = np.zeros(256, bool)
ALNUM_WORDS[0x30:0x3A] = ALNUM_WORDS[0x61:0x7B] = True
ALNUM_WORDS[0x80:] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def text_bytes(col) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, n + 1 offsets) of an Arrow string array; a null text is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks() if col.num_chunks != 1 else col.chunk(0)
        if isinstance(col, pa.ChunkedArray):  # empty
            col = pa.array([], col.type)
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    kind = np.int64 if wide else np.int32
    _, offs, data = col.buffers()
    if len(col) == 0 or offs is None:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    off = np.frombuffer(offs, kind)[col.offset: col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]: off[-1]], off - off[0]


def slices(batch: pa.RecordBatch | pa.Table, column: str, most: int = SLICE_BYTES):
    """Zero-copy row slices of at most ``most`` text bytes (one row at least)."""
    n = batch.num_rows
    if not n:
        return
    _, off = text_bytes(batch.column(column))
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(off, off[at] + most, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


class Words:
    """Word borders of a batch: ``start``, ``end`` into ``data``; words of text i are ``ptr[i]:ptr[i+1]``."""

    def __init__(self, data: np.ndarray, off: np.ndarray, kind: np.ndarray):
        self.data, self.off = data, off
        inside = kind[data]
        full = off[:-1] < off[1:]
        before = np.empty(len(data), bool)
        before[:1] = False
        before[1:] = inside[:-1]
        before[off[:-1][full]] = False
        self.start = np.flatnonzero(inside & ~before)
        before[:-1] = inside[1:]
        before[-1:] = False
        before[off[1:][full] - 1] = False
        self.end = np.flatnonzero(inside & ~before) + 1
        self.ptr = np.searchsorted(self.start, off)
        self.count = np.diff(self.ptr)

    @property
    def n(self) -> int:
        return len(self.start)

    def doc(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(len(self.count)), self.count)

    def fits(self, k: int) -> np.ndarray:
        """Whether k words from here on stay in the same text."""
        return np.arange(self.n) + k <= np.repeat(self.ptr[1:], self.count)

    def hashes(self, seed: int = 0, keep: bool = True) -> np.ndarray:
        """64-bit hash of each word's bytes, worked out over ``HASH_BYTES`` of whole words (one word at least) at a time."""
        out = np.empty(self.n, U64)
        at = 0
        while at < self.n:
            first = self.start[at]
            to = max(at + 1, int(np.searchsorted(self.end, first + HASH_BYTES, "right")))
            start, end, data = self.start[at:to] - first, self.end[at:to] - first, self.data[first: self.end[to - 1]]
            table_, up, down = powers(len(data), seed, keep)
            total = np.zeros(len(data) + 1, U64)
            value = table_[data]
            value *= up[: len(value)]
            np.cumsum(value, out=total[1:])
            out[at:to] = mix((total[end] - total[start]) * down[start] + (end - start).astype(U64))
            at = to
        return out


_POWERS: dict[int, tuple] = {}
#: Powers that a worker keeps for each seed (16 bytes each).
KEPT_POWERS = 8 << 20


def powers(n: int, seed: int, keep: bool = True):
    """A random value for each byte; powers of an odd number and of its inverse modulo 2**64.

    They are kept for later calls, unless ``keep`` is false or they are over ``KEPT_POWERS``.
    """
    got = _POWERS.get(seed)
    if got is None or len(got[1]) < n:
        rng = np.random.default_rng(0x5EED + seed)
        values = rng.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
        p = int(rng.integers(2**62, 2**63)) * 2 + 1
        size = max(n, 1 << 16)
        up, down = np.full(size, U64(p), U64), np.full(size, U64(pow(p, -1, 2**64)), U64)
        up[0] = down[0] = 1
        got = values, np.cumprod(up), np.cumprod(down)
        if keep and size <= KEPT_POWERS:
            _POWERS[seed] = got
    return got


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def grams(h: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hash of the k values from each place on (len(h) - k + 1 of them), whatever k costs the same."""
    out = np.empty(max(0, len(h) - k + 1), U64)
    step = max(k, HASH_BYTES)
    for at in range(0, len(out), step):
        part = h[at: at + step + k - 1]
        m = len(part) - k + 1
        _, up, down = powers(len(part) + 1, 100 + seed)
        total = np.zeros(len(part) + 1, U64)
        np.cumsum(part * up[: len(part)], out=total[1:])
        out[at: at + m] = mix((total[k:] - total[:m]) * down[:m] + U64(k))
    return out


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of the w values from each place on (len(x) - w + 1 of them)."""
    have, out = 1, x
    while have < w:
        step = min(have, w - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def member(x: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Place of each x in the sorted ``keys``, or -1."""
    if not len(keys) or not len(x):
        return np.full(len(x), -1)
    at = np.searchsorted(keys, x)
    at[at == len(keys)] = 0
    return np.where(keys[at] == x, at, -1)


def ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, ... count[0] of them, then those of start[1], and so on."""
    total = int(count.sum())
    if not total:
        return np.zeros(0, np.int64)
    first = np.cumsum(count) - count
    return np.arange(total) + np.repeat(start - first, count)


# ---------------------------------------------------------------- blocks

def blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, int]:
    """(doc_id, text, _b) dealt out by block, and the number of blocks.

    A block is a set of documents chosen by a hash of the id, of about
    ``block_bytes`` of text, so their number grows with the input and no block
    does. All rows of an id meet in one block. Every use of the returned frame
    has the same exchange, which Spark runs once in a query.
    """
    size = docs.agg(F.sum(F.octet_length(text_col)).alias("n")).first()["n"] or 0
    n = max(1, -(-int(size) // block_bytes))
    out = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    tasks = max(1, min(n, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 4))
    return out.withColumn("_b", block_of(F.col("doc_id"), n)).repartition(tasks, "_b"), n


def block_of(col, n: int):
    return F.pmod(F.xxhash64(col), F.lit(n)).cast("int")


def bucket_of(key: np.ndarray, n: int) -> np.ndarray:
    """Bucket of a 64-bit key, in the order of the keys."""
    return (((key >> U64(32)) * U64(n)) >> U64(32)).astype(np.int64)


def cuts(sorted_buckets: np.ndarray):
    """(bucket, from, to) for each run of equal values."""
    if not len(sorted_buckets):
        return
    edge = np.flatnonzero(np.diff(sorted_buckets)) + 1
    for a, b in zip(np.r_[0, edge], np.r_[edge, len(sorted_buckets)], strict=True):
        yield int(sorted_buckets[a]), int(a), int(b)
