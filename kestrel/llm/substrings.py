"""Substring dedup by De Bruijn compaction (operator 2).

Words are the text's tokens. A window of ``k`` words is an edge of the De
Bruijn graph, from the node of its first k-1 words to that of its last k-1.
A word goes if a window covers it whose word sequence also starts in a
document with a smaller id.

One Spark plan over documents dealt out in blocks (``common.blocks``):

1. *Shared anchors.* Equal windows have equal minimizers (the least hash of
   the short word runs inside). Each block sends its distinct minimizers; the
   buckets answer with those of two documents or more. Every other window is
   unique and is not looked at again.
2. *Edges.* Each block sends the first occurrence of each of its candidate
   windows: 96 bits of hash, and one (document, place, length) for each run of
   windows with one minimizer. The bucket of the minimizer finds the first
   source of each edge and answers with paths: runs of edges whose sources
   follow one another too. A path ends where the graph branches away from
   its source.
3. *Compaction.* Each block joins its paths end to start into spans with
   coordinates (document, place, source document, source place, length), copies
   inside the block included.
4. *Verification.* Each distinct span goes to the block of its source with a
   digest of its words, and is compared with the words at those coordinates.
   A difference would need a hash collision over 96 bits; it ends the job with
   an error and is never passed over.

A hot passage is sent once by each block that has it, never once for each
document. Blocks are bounded in bytes; a bucket gets what one part in
``buckets`` of all anchors makes. Nothing comes to the driver but the total
text size.

Defined cases: a null text has no words; rows with one doc_id count as one
document (laid end to end in the order of their texts, no window crosses two
rows) and each returns its own row; rows with a null doc_id lose nothing and
are nobody's source; texts shorter than ``k`` words stay whole; an empty table
gives an empty result; other columns of the input are not looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import (SPACE_WORDS, U64, Words, block_of, blocks, bucket_of, cuts, grams, member, mix, ranges,
                                sliding_min, text_bytes)

WINDOW = 13
ANCHOR = 5

_ROW = np.dtype([("doc", "<i8"), ("at", "<i4"), ("n", "<i4")])
_EDGE = np.dtype([("hi", "<u8"), ("lo", "<u4")])
_PATH = np.dtype([("doc", "<i8"), ("src", "<i8"), ("at", "<i4"), ("src_at", "<i4"), ("n", "<i4")])


class _Block:
    """The texts of one block in a fixed order, with their windows."""

    def __init__(self, rows: pa.Table, k: int):
        rows = rows.select(["doc_id", "text"])
        rows = rows.take(pc.sort_indices(rows, sort_keys=[("doc_id", "ascending"), ("text", "ascending")]))
        self.k, self.ids = k, rows["doc_id"].combine_chunks()
        self.text = rows["text"].combine_chunks()
        self.known = np.asarray(self.ids.is_valid())
        self.id = np.asarray(self.ids.fill_null(np.iinfo(np.int64).max))
        self.words = w = Words(*text_bytes(self.text), SPACE_WORDS)
        first = np.r_[True, self.id[1:] != self.id[:-1]] if len(self.id) else np.zeros(0, bool)
        base = np.maximum.accumulate(np.where(first, w.ptr[:-1], 0)) if len(first) else w.ptr[:-1]
        row = w.doc()
        self.row, self.doc, self.at = row, self.id[row], np.arange(w.n) - base[row]
        self.base = base
        self.whole = w.fits(k) & self.known[row]

    def anchors(self, m: int) -> np.ndarray:
        """The minimizer of each window (of the first n - k + 1 places, whole or not), mixed: least hashes are small, and would crowd the first buckets."""
        return mix(sliding_min(grams(self.words.hashes(), m), self.k - m + 1)) if self.words.n >= self.k else np.zeros(0, U64)

    def edges(self) -> np.ndarray:
        out = np.zeros(max(0, self.words.n - self.k + 1), _EDGE)
        out["hi"] = grams(self.words.hashes(), self.k)
        out["lo"] = grams(self.words.hashes(1), self.k, 1) >> U64(32)
        return out

    def digest(self, start: int, n: int) -> bytes:
        w = self.words
        return hashlib.blake2b(b" ".join(w.data[w.start[start]: w.end[start + n - 1]].tobytes().split()), digest_size=16).digest()


def _first(edge: np.ndarray, doc: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each place the index of the first (doc, at) with the same edge."""
    order = np.lexsort((at, doc, edge["lo"], edge["hi"]))
    e = edge[order]
    new = np.r_[True, (e["hi"][1:] != e["hi"][:-1]) | (e["lo"][1:] != e["lo"][:-1])] if len(e) else np.zeros(0, bool)
    head = np.maximum.accumulate(np.where(new, np.arange(len(e)), 0)) if len(e) else np.zeros(0, int)
    out = np.empty(len(e), np.int64)
    out[order] = order[head]
    return out


_BLOB = "bucket int, _b int, keys binary, flags binary"


def _send_anchors(k: int, m: int, n_buckets: int):
    def run(rows: pa.Table) -> pa.Table:
        b = int(rows["_b"][0].as_py())
        blk = _Block(rows, k)
        low = blk.anchors(m)
        at = np.flatnonzero(blk.whole[: len(low)])
        key, doc = low[at], blk.doc[at]
        if len(at):
            keep = np.r_[True, (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])]
            key, doc = key[keep], doc[keep]
        order = np.argsort(key, kind="stable")
        key, doc = key[order], doc[order]
        head = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, int)
        key1 = key[head]
        many = np.minimum.reduceat(doc, head) != np.maximum.reduceat(doc, head) if len(head) else np.zeros(0, bool)
        out = [(i, b, key1[x:y].tobytes(), many[x:y].tobytes()) for i, x, y in cuts(bucket_of(key1, n_buckets))]
        return _rows(out, (pa.int32(), pa.int32(), pa.binary(), pa.binary()), ("bucket", "_b", "keys", "flags"))

    return run


def _rows(rows: list[tuple], kinds: tuple, names: tuple) -> pa.Table:
    cols = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.table([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=list(names))


def _answer_anchors(rows: pa.Table) -> pa.Table:
    """To each block: which of its keys are in two documents or more."""
    keys = [np.frombuffer(x.as_py(), U64) for x in rows["keys"]]
    flag = np.concatenate([np.frombuffer(x.as_py(), bool) for x in rows["flags"]])
    key = np.concatenate(keys)
    order = np.argsort(key, kind="stable")
    s = key[order]
    head = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
    shared = (np.diff(np.r_[head, len(s)]) > 1) | np.logical_or.reduceat(flag[order], head)
    hit = np.empty(len(s), bool)
    hit[order] = np.repeat(shared, np.diff(np.r_[head, len(s)]))
    out, at = [], 0
    for b, x in zip(rows["_b"].to_pylist(), keys, strict=True):
        mine = x[hit[at: at + len(x)]]
        at += len(x)
        if len(mine):
            out.append((b, mine.tobytes()))
    return _rows(out, (pa.int32(), pa.binary()), ("_b", "keys"))


def _send_edges(k: int, m: int, n_buckets: int):
    kinds, names = (pa.int32(), pa.int32(), pa.binary(), pa.binary()), ("bucket", "_b", "runs", "edges")

    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        if not rows.num_rows or not answers.num_rows:
            return _rows([], kinds, names)
        b = int(rows["_b"][0].as_py())
        blk = _Block(rows, k)
        low = blk.anchors(m)
        keys = np.sort(np.concatenate([np.frombuffer(x.as_py(), U64) for x in answers["keys"]]))
        at = np.flatnonzero(blk.whole[: len(low)])
        at = at[member(low[at], keys) >= 0]
        edge = blk.edges()[at]
        own = _first(edge, blk.doc[at], blk.at[at]) == np.arange(len(at))
        at, edge = at[own], edge[own]
        low, doc = low[at], blk.doc[at]
        bucket = bucket_of(low, n_buckets)
        order = np.argsort(bucket, kind="stable")
        at, edge, low, doc, bucket = at[order], edge[order], low[order], doc[order], bucket[order]
        out = []
        for i, x, y in cuts(bucket):
            a, d, mm = at[x:y], doc[x:y], low[x:y]
            head = np.flatnonzero(np.r_[True, (a[1:] != a[:-1] + 1) | (mm[1:] != mm[:-1]) | (d[1:] != d[:-1])])
            runs = np.zeros(len(head), _ROW)
            runs["doc"], runs["at"], runs["n"] = d[head], blk.at[a[head]], np.diff(np.r_[head, y - x])
            out.append((i, b, runs.tobytes(), edge[x:y].tobytes()))
        return _rows(out, kinds, names)

    return run


def _answer_edges(rows: pa.Table) -> pa.Table:
    """To each block: paths, runs of its edges whose first sources are in a smaller document, one after another."""
    runs = [np.frombuffer(x.as_py(), _ROW) for x in rows["runs"]]
    edge = np.concatenate([np.frombuffer(x.as_py(), _EDGE) for x in rows["edges"]])
    run = np.concatenate(runs)
    piece = np.repeat(np.arange(len(run)), run["n"])
    doc, at = run["doc"][piece], ranges(run["at"].astype(np.int64), run["n"].astype(np.int64))
    src = _first(edge, doc, at)
    hit = np.flatnonzero(doc[src] < doc)
    doc, at, piece, s_doc, s_at = doc[hit], at[hit], piece[hit], doc[src[hit]], at[src[hit]]
    if not len(hit):
        return _rows([], (pa.int32(), pa.binary()), ("_b", "paths"))
    head = np.flatnonzero(np.r_[True, (piece[1:] != piece[:-1]) | (at[1:] != at[:-1] + 1) | (s_doc[1:] != s_doc[:-1]) | (s_at[1:] != s_at[:-1] + 1)])
    path = np.zeros(len(head), _PATH)
    path["doc"], path["at"], path["src"], path["src_at"], path["n"] = doc[head], at[head], s_doc[head], s_at[head], np.diff(np.r_[head, len(hit)])
    block = np.repeat(np.arange(len(runs)), [len(r) for r in runs])[piece[head]]
    ids = rows["_b"].to_pylist()
    return _rows([(ids[i], path[x:y].tobytes()) for i, x, y in cuts(block)], (pa.int32(), pa.binary()), ("_b", "paths"))


def _sources(blk: _Block, answers: pa.Table, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window, source document, source place) of every window that goes, from the paths and from copies inside the block."""
    at = np.flatnonzero(blk.whole[: max(0, blk.words.n - blk.k + 1)])
    edge = blk.edges()[at]
    first = _first(edge, blk.doc[at], blk.at[at])
    s_doc, s_at = blk.doc[at][first], blk.at[at][first]
    blobs = [x.as_py() for x in answers["paths"]] if answers.num_rows else []
    if blobs and len(at):
        path = np.concatenate([np.frombuffer(x, _PATH) for x in blobs])
        # places in this block of the windows that the paths name
        base = blk.base[np.searchsorted(blk.id, path["doc"])]
        where = ranges(base + path["at"], path["n"].astype(np.int64))
        got = np.full(blk.words.n, -1)
        got[where] = np.arange(len(where))
        from_doc = np.repeat(path["src"], path["n"])
        from_at = ranges(path["src_at"].astype(np.int64), path["n"].astype(np.int64))
        via = got[at[first]]
        s_doc = np.where(via >= 0, from_doc[via], s_doc)
        s_at = np.where(via >= 0, from_at[via], s_at)
    gone = s_doc < blk.doc[at]
    return at[gone], s_doc[gone], s_at[gone]


def _covered(blk: _Block, at: np.ndarray) -> np.ndarray:
    """Words covered by the windows that start at the given places."""
    step = np.zeros(blk.words.n + blk.k, np.int32)
    np.add.at(step, at, 1)
    np.add.at(step, at + blk.k, -1)
    return np.cumsum(step)[: blk.words.n] > 0


def _compact(blk: _Block, at: np.ndarray, s_doc: np.ndarray, s_at: np.ndarray):
    """Paths joined end to start: (first word, words, source document, source place)."""
    if not len(at):
        return (np.zeros(0, np.int64),) * 4
    head = np.flatnonzero(np.r_[True, (at[1:] != at[:-1] + 1) | (blk.row[at[1:]] != blk.row[at[:-1]]) | (s_doc[1:] != s_doc[:-1]) | (s_at[1:] != s_at[:-1] + 1)])
    return at[head], np.diff(np.r_[head, len(at)]) + blk.k - 1, s_doc[head], s_at[head]


_KEPT = "doc_id long, n_words long, n_removed long, kept string"
_SPAN = "src_doc long, src_at int, n int, digest binary"


def _keep(k: int, m: int, digest: bool):
    last = pa.string()

    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        kinds, names = (pa.int64(), pa.int64(), pa.int64(), last), ("doc_id", "n_words", "n_removed", "kept")
        if not rows.num_rows:
            return _rows([], kinds, names)
        blk = _Block(rows, k)
        w = blk.words
        gone = _covered(blk, _sources(blk, answers, m)[0])
        out = []
        removed = np.diff(np.r_[0, np.cumsum(gone)][w.ptr])
        for i in range(len(w.count)):
            a, b = w.ptr[i], w.ptr[i + 1]
            words = w.data[w.start[a]: w.end[b - 1]].tobytes().split() if b > a else []
            if removed[i]:
                words = [words[j] for j in np.flatnonzero(~gone[a:b])]
            text = b" ".join(words)
            out.append(hashlib.sha256(text).hexdigest() if digest else text.decode())
        return pa.table([blk.ids, pa.array(w.count, pa.int64()), pa.array(removed, pa.int64()), pa.array(out, last)], names=list(names))

    return run


def _ask(k: int, m: int):
    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        kinds, names = (pa.int64(), pa.int32(), pa.int32(), pa.binary()), ("src_doc", "src_at", "n", "digest")
        if not rows.num_rows:
            return _rows([], kinds, names)
        blk = _Block(rows, k)
        asked = {(int(d), int(p), int(n), blk.digest(a, n)) for a, n, d, p in zip(*_compact(blk, *_sources(blk, answers, m)), strict=True)}
        return _rows(sorted(asked), kinds, names)

    return run


def _verify(k: int):
    def run(rows: pa.Table, asked: pa.Table) -> pa.Table:
        if asked.num_rows:
            blk = _Block(rows, k)
            base = dict(zip(blk.id.tolist()[::-1], blk.base.tolist()[::-1], strict=True))
            for d, p, n, told in zip(*(asked[c].to_pylist() for c in ("src_doc", "src_at", "n", "digest")), strict=True):
                if blk.digest(base[d] + p, n) != told:
                    raise ValueError(f"a span of {n} words is not what stands at word {p} of document {d}: hash collision")
        return _rows([], (pa.int64(), pa.int64(), pa.int64(), pa.string()), ("doc_id", "n_words", "n_removed", "kept"))

    return run


def dedup_substrings(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, digest: bool = False, block_bytes: int | None = None) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): kept words joined by one space, or their SHA-256 with ``digest``."""
    if not 1 <= anchor <= window:
        raise ValueError("anchor must be between 1 and window")
    base, n = blocks(docs, **({"block_bytes": block_bytes} if block_bytes else {}))
    n_buckets = max(1, n // 4)
    by = base.groupBy("_b")
    anchors = by.applyInArrow(_send_anchors(window, anchor, n_buckets), _BLOB)
    shared = anchors.groupBy("bucket").applyInArrow(_answer_anchors, "_b int, keys binary")
    edges = by.cogroup(shared.groupBy("_b")).applyInArrow(_send_edges(window, anchor, n_buckets), "bucket int, _b int, runs binary, edges binary")
    paths = edges.groupBy("bucket").applyInArrow(_answer_edges, "_b int, paths binary").groupBy("_b")
    kept = by.cogroup(paths).applyInArrow(_keep(window, anchor, digest), _KEPT)
    asked = by.cogroup(paths).applyInArrow(_ask(window, anchor), _SPAN).distinct().withColumn("_b", block_of(F.col("src_doc"), n))
    return kept.unionAll(by.cogroup(asked.groupBy("_b")).applyInArrow(_verify(window), _KEPT))


def spans(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """The distinct repeated spans: (src_doc, src_at, n words, digest of the words)."""
    base, n = blocks(docs)
    by = base.groupBy("_b")
    n_buckets = max(1, n // 4)
    shared = by.applyInArrow(_send_anchors(window, anchor, n_buckets), _BLOB).groupBy("bucket").applyInArrow(_answer_anchors, "_b int, keys binary")
    edges = by.cogroup(shared.groupBy("_b")).applyInArrow(_send_edges(window, anchor, n_buckets), "bucket int, _b int, runs binary, edges binary")
    paths = edges.groupBy("bucket").applyInArrow(_answer_edges, "_b int, paths binary")
    return by.cogroup(paths.groupBy("_b")).applyInArrow(_ask(window, anchor), _SPAN).distinct()
