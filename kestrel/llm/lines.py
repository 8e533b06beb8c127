"""Line dedup by a fixed-depth template tree (operator 4).

A line is parsed into its words; a word with a digit in it is a variable field
and reads ``<*>``. The tree has four levels whatever the line: the root, the
number of words, the leading ``depth`` words, and a leaf whose template keeps
three quarters of the rest of the line and generalises the fourth into
variable fields. So a line hangs in four leaves, one for each quarter that may
vary; two lines share a template if, digits aside, they differ within one
quarter only and agree in their leading words.

A template recurs if rows of ``min_docs`` documents or more have it. A line
with a recurring template is dropped, except in the document with the
smallest id among those that have it; short lines (under ``min_words``
words) say too little for a quarter of them to vary.

With ``whole_docs`` every line with a word in it hangs in one leaf more, that of
all its words (digits aside), whatever its length; that template recurs if rows
of ``whole_docs`` documents have it. Without it short lines stay.

Blocks of documents send each template once (hash, smallest id, documents); a
template that a third of all documents have is one row of each block. The
buckets answer with the recurring ones, and each block drops its lines. The
templates need no clustering pass over a leaf, so no leaf is ever gathered.

Defined cases: null texts stay null with no lines; a row with a null doc_id
counts as a document but is never the one that keeps its line (if no row has
an id, every line goes); rows that share a doc_id each count; a document whose
lines all go has an empty text; kept lines stay unchanged, in their order,
joined by line feeds; a text without a recurring line is returned byte for
byte; empty tables give empty results; other columns are carried through,
whatever they are called (helper columns take names that are free).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import BLOCK_BYTES, SPACE_WORDS, U64, Words, bucket_of, cuts, free_name, member, mix, powers, text_bytes

DEPTH = 2
MIN_WORDS = 8
MIN_DOCS = 3
WHOLE_DOCS = 2

_NONE = np.iinfo(np.int64).max
_FIELD = U64(0xF1E1DF1E1D)
_WHOLE = U64(0x9E3779B97F4A7C15)
_DIGIT = np.zeros(256, np.uint8)
_DIGIT[0x30:0x3A] = 1
# whether a key is of a whole line is in its lowest bit
_KEY = np.dtype([("key", "<u8"), ("doc", "<i8"), ("n", "<i4")])


class _Lines:
    """Lines of a set of texts and their template keys: ``keys[i]`` is one of line ``line[i]``."""

    def __init__(self, column, depth: int, min_words: int, whole: bool):
        self.data, self.off = text_bytes(column)
        feed = np.flatnonzero(self.data == 0x0A)
        n = len(self.off) - 1
        # a text has one line more than line feeds; an empty one has one empty line
        owner = np.searchsorted(self.off, feed, "right") - 1
        begin, end = np.r_[self.off[:-1], feed + 1], np.r_[feed, self.off[1:]]
        text = np.r_[np.arange(n), owner]
        order = np.lexsort((begin, text))
        self.begin, self.text = begin[order], text[order]
        last = np.r_[self.text[1:] != self.text[:-1], True] if n else np.zeros(0, bool)
        self.end = np.empty(len(order), np.int64)
        self.end[last] = self.off[1:]
        self.end[~last] = self.begin[1:][~last[:-1]] - 1
        w = Words(self.data, self.off, SPACE_WORDS)
        h = w.hashes(keep=False)  # two looks at a block are too few to hold its powers for
        digits = np.zeros(len(self.data) + 1, np.int64 if len(self.data) >> 31 else np.int32)
        np.cumsum(_DIGIT[self.data], out=digits[1:])
        h = np.where(digits[w.end] > digits[w.start], _FIELD, h)
        first = np.searchsorted(w.start, self.begin)
        size = np.searchsorted(w.start, self.end) - first
        long = np.flatnonzero(size >= max(min_words, depth + 4))
        a, m = first[long], size[long]
        _, up, down = powers(len(h) + 1, 200)
        total = np.zeros(len(h) + 1, U64)
        np.cumsum(h * up[: len(h)], out=total[1:])

        def span(x, y):
            return (total[y] - total[x]) * down[x]

        rest = m - depth
        cut = [a + depth + rest * q // 4 for q in range(5)]
        root = mix(span(a, a + depth) + m.astype(U64))
        quarter = [mix(span(cut[q], cut[q + 1]) + U64(q + 1)) for q in range(4)]
        keys = [mix(root + U64(q) + sum(quarter[p] * U64(2 * p + 3) for p in range(4) if p != q)) for q in range(4)]
        self.line, self.whole = np.tile(long, 4), np.zeros(4 * len(long), bool)
        if whole:
            some = np.flatnonzero(size > 0)
            a, m = first[some], size[some]
            keys.append(mix(span(a, a + m) + m.astype(U64) * _WHOLE))
            self.line, self.whole = np.r_[self.line, some], np.r_[self.whole, np.ones(len(some), bool)]
        self.keys = (np.concatenate(keys) & ~U64(1)) | self.whole.astype(U64)


def _ids(column) -> np.ndarray:
    return np.asarray(column.fill_null(_NONE)).astype(np.int64)


def _send(depth: int, min_words: int, whole: bool, n_buckets: int, block: str):
    def run(rows: pa.Table) -> pa.Table:
        lines = _Lines(rows["text"], depth, min_words, whole)
        row, key = lines.text[lines.line], lines.keys
        order = np.lexsort((row, key))
        key, row = key[order], row[order]
        once = np.r_[True, (key[1:] != key[:-1]) | (row[1:] != row[:-1])] if len(key) else np.zeros(0, bool)
        key, doc = key[once], _ids(rows["doc_id"])[row[once]]
        head = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, int)
        out = np.zeros(len(head), _KEY)
        if len(head):
            out["key"], out["doc"], out["n"] = key[head], np.minimum.reduceat(doc, head), np.diff(np.r_[head, len(key)])
        b = int(rows[block][0].as_py())
        got = [(i, b, out[x:y].tobytes()) for i, x, y in cuts(bucket_of(out["key"], n_buckets))]
        return pa.table([pa.array([g[j] for g in got], t) for j, t in enumerate((pa.int32(), pa.int32(), pa.binary()))], names=["bucket", "_b", "keys"])

    return run


def _answer(min_docs: int, whole_docs: int):
    def run(rows: pa.Table) -> pa.Table:
        blobs = [np.frombuffer(x.as_py(), _KEY) for x in rows["keys"]]
        all_ = np.concatenate(blobs)
        order = np.argsort(all_["key"], kind="stable")
        key = all_["key"][order]
        head = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        n, least = np.add.reduceat(all_["n"][order].astype(np.int64), head), np.minimum.reduceat(all_["doc"][order], head)
        key = key[head]
        recurs = n >= np.where(key & U64(1), whole_docs, min_docs)
        key, least = key[recurs], least[recurs]
        out = []
        for b, blob in zip(rows["_b"].to_pylist(), blobs, strict=True):
            at = member(blob["key"], key)
            at = at[at >= 0]
            if len(at):
                back = np.zeros(len(at), _KEY)
                back["key"], back["doc"] = key[at], least[at]
                out.append((b, back.tobytes()))
        return pa.table([pa.array([g[j] for g in out], t) for j, t in enumerate((pa.int32(), pa.binary()))], names=["_b", "keys"])

    return run


def _drop(depth: int, min_words: int, whole: bool, schema: pa.Schema, counts: tuple[str, str]):
    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return schema.empty_table()
        lines = _Lines(rows["text"], depth, min_words, whole)
        n = rows.num_rows
        total = np.bincount(lines.text, minlength=n)
        gone = np.zeros(len(lines.text), bool)
        if answers.num_rows and len(lines.keys):
            known = np.concatenate([np.frombuffer(x.as_py(), _KEY) for x in answers["keys"]])
            known = known[np.argsort(known["key"], kind="stable")]
            at = member(lines.keys, known["key"])
            doc = _ids(rows["doc_id"])[lines.text[lines.line]]
            gone[lines.line[(at >= 0) & ((known["doc"][at] < doc) | (doc == _NONE))]] = True
        dropped = np.bincount(lines.text[gone], minlength=n)
        text = rows["text"].combine_chunks()
        if gone.any():
            new, raw, ptr = text.to_pylist(), lines.data.tobytes(), np.searchsorted(lines.text, np.arange(n + 1))
            for i in np.flatnonzero(dropped).tolist():
                new[i] = b"\n".join(raw[lines.begin[j]: lines.end[j]] for j in range(ptr[i], ptr[i + 1]) if not gone[j]).decode()
            text = pa.array(new, pa.string())
        null = ~np.asarray(rows["text"].combine_chunks().is_valid())
        found = {"text": text, counts[0]: pa.array(np.where(null, 0, total), pa.int64()), counts[1]: pa.array(dropped, pa.int64())}
        return pa.table([found[f.name] if f.name in found else rows[f.name] for f in schema], schema=schema)

    return run


def dedup_lines(docs: DataFrame, depth: int = DEPTH, min_words: int = MIN_WORDS, min_docs: int = MIN_DOCS, block_bytes: int = BLOCK_BYTES,
                counts: tuple[str, str] = ("_n_lines", "_n_dropped"), whole_docs: int | None = None) -> DataFrame:
    """All columns of ``docs`` with recurring lines taken out of ``text``, then the two ``counts``: lines, and lines dropped.

    The names of ``counts`` must be free in ``docs``. ``whole_docs``: documents
    from which on a line recurs by all its words; None: quarters only.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    taken = {c.lower() for c in docs.columns} & {c.lower() for c in counts}
    if taken:
        raise ValueError(f"columns {sorted(taken)} are there already: name the counts otherwise")
    out = docs.withColumn(counts[0], F.lit(0).cast("long")).withColumn(counts[1], F.lit(0).cast("long"))
    schema = pa.schema([pa.field(f.name, f.type) for f in to_arrow_schema(out.schema)])
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    n = max(1, -(-int(size) // block_bytes))
    n_buckets = max(1, n // 4)
    whole = whole_docs is not None
    tasks = max(1, min(n, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 4))
    block = free_name(docs, "_b")
    # rows without an id are spread by their text
    base = docs.withColumn(block, F.pmod(F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id")), F.lit(n)).cast("int")).repartition(tasks, block)
    by = base.groupBy(block)
    sent = by.applyInArrow(_send(depth, min_words, whole, n_buckets, block), "bucket int, _b int, keys binary")
    back = sent.groupBy("bucket").applyInArrow(_answer(min_docs, whole_docs or 0), "_b int, keys binary")
    return by.cogroup(back.groupBy("_b")).applyInArrow(_drop(depth, min_words, whole, schema, counts), out.schema)
