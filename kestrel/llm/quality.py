"""Quality score by a generalised additive model with pairwise interactions (operator 8).

Features are counts and shares of a whole text's bytes, words and lines. The
model adds one lookup table per feature and one per chosen pair of features.
Tables are learned by cyclic boosting: features take turns, each turn fits a
shallow tree over the feature's bins to the gradient of the logistic loss and
adds a small part of it to the table; then the pairs whose 2-D bins hold most
of what is left take turns the same way. Scoring adds up table entries for all
texts of a batch at once.

The model is fitted on a bounded sample, the ``sample`` labelled rows with the
least hash of their id; only their features come to the driver. Scoring is one
pass without a shuffle. The model is a few kilobytes.

Defined cases: null and empty texts have all features zero and a score like
any text; labels with a null doc_id or value teach nothing; repeated labels of
a document each teach; without labels, or with one value only, the score is
the (smoothed) share of good labels; empty tables give empty results; repeated
rows each return a row; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import SPACE_WORDS, U64, Words, slices, text_bytes

SAMPLE = 20_000
FEATURES = ("log_words", "word_length", "upper", "digit", "punctuation", "beyond_ascii", "log_lines", "words_a_line",
            "different_words", "top_word", "repeated_word", "different_pairs", "different_lines", "bare_marks", "marked_ends", "log_longest")

_KIND = np.zeros((5, 256), np.uint8)
_KIND[0, 0x41:0x5B] = _KIND[1, 0x30:0x3A] = _KIND[3, 0x80:] = 1
_KIND[2, 0x21:0x30] = _KIND[2, 0x3A:0x41] = _KIND[2, 0x5B:0x61] = _KIND[2, 0x7B:0x7F] = 1
_KIND[4, 0x0A] = 1
_LINES = np.ones(256, bool)
_LINES[0x0A] = False


def _sums(x: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    return np.diff(np.r_[0, np.cumsum(x, dtype=np.int64)][ptr])


def _different(text: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Different values and the largest count of one value, by text."""
    key = np.sort((text.astype(U64) << U64(44)) | (h >> U64(20)))
    new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, int)
    of = (key[new] >> U64(44)).astype(np.int64)
    most = np.zeros(n, np.int64)
    np.maximum.at(most, of, np.diff(np.r_[new, len(key)]))
    return np.bincount(of, minlength=n), most


def features(column) -> np.ndarray:
    """len(column) x len(FEATURES)."""
    data, off = text_bytes(column)
    n, size = len(off) - 1, np.diff(off)
    w = Words(data, off, SPACE_WORDS)
    words, h, text = w.count, w.hashes(), w.doc()
    upper, digit, marks, wide, breaks = (_sums(_KIND[i][data], off) for i in range(5))
    length = w.end - w.start
    different, top = _different(text, h, n)
    again = _sums(np.r_[False, (h[1:] == h[:-1]) & (text[1:] == text[:-1])] if len(h) else np.zeros(0), w.ptr)
    pair = np.flatnonzero(text[1:] == text[:-1])
    pairs = _different(text[pair], h[pair] * U64(3) + h[pair + 1], n)[0] if len(h) else np.zeros(n)
    lines = Words(data, off, _LINES)
    line_different = _different(lines.doc(), lines.hashes(2), n)[0]
    last = _KIND[2][data[w.end - 1]] if len(h) else np.zeros(0)
    bare = (length == 1) & (last > 0) if len(h) else np.zeros(0)
    longest = np.zeros(n)
    np.maximum.at(longest, text, length)
    share = lambda x, of: x / np.maximum(of, 1)
    return np.column_stack([
        np.log1p(words), share(_sums(length, w.ptr), words), share(upper, size), share(digit, size), share(marks, size), share(wide, size),
        np.log1p(lines.count), share(words, lines.count), share(different, words), share(top, words), share(again, words),
        share(pairs, words), share(line_different, lines.count), share(_sums(bare, w.ptr), words), share(_sums(last, w.ptr), words), np.log1p(longest),
    ]) if n else np.zeros((0, len(FEATURES)))


@dataclass
class Gam:
    start: float
    edges: list  # of each feature's bins
    tables: list  # of each feature
    pairs: list  # (feature, feature, table over coarse bins)
    coarse: list  # coarse bin of each bin

    def score(self, x: np.ndarray) -> np.ndarray:
        bins = [np.searchsorted(e, x[:, i], "right") for i, e in enumerate(self.edges)]
        z = np.full(len(x), self.start)
        for i, t in enumerate(self.tables):
            z += t[bins[i]]
        for i, j, t in self.pairs:
            z += t[self.coarse[i][bins[i]], self.coarse[j][bins[j]]]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _gain(g, h):
    return g * g / (h + 1.0)


def _tree(g: np.ndarray, h: np.ndarray, splits: int) -> np.ndarray:
    """Step of each bin: a tree of ``splits`` cuts over the bins' order, each the best one left."""
    cuts = [0, len(g)]
    cg, ch = np.r_[0, np.cumsum(g)], np.r_[0, np.cumsum(h)]
    for _ in range(splits):
        best = (1e-9, None)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            at = np.arange(a + 1, b)
            if len(at):
                up = _gain(cg[at] - cg[a], ch[at] - ch[a]) + _gain(cg[b] - cg[at], ch[b] - ch[at]) - _gain(cg[b] - cg[a], ch[b] - ch[a])
                if up.max() > best[0]:
                    best = (up.max(), int(at[up.argmax()]))
        if best[1] is None:
            break
        cuts = sorted([*cuts, best[1]])
    out = np.empty(len(g))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        out[a:b] = (cg[b] - cg[a]) / (ch[b] - ch[a] + 1.0)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """(gain, step of each cell): one cut of the first feature, one of the second on either side; or the other way round."""
    best = (0.0, np.zeros_like(g))
    for turn in (False, True):
        a, b = (g.T, h.T) if turn else (g, h)
        for cut in range(1, len(a)):
            out, up = np.empty_like(a), 0.0
            for s in (slice(0, cut), slice(cut, None)):
                gs, hs = a[s].sum(0), b[s].sum(0)
                cg, ch = np.cumsum(gs)[:-1], np.cumsum(hs)[:-1]
                both = _gain(cg, ch) + _gain(gs.sum() - cg, hs.sum() - ch)
                k = int(both.argmax())
                up += both[k]
                out[s, : k + 1] = cg[k] / (ch[k] + 1.0)
                out[s, k + 1:] = (gs.sum() - cg[k]) / (hs.sum() - ch[k] + 1.0)
            if up > best[0]:
                best = (up, out.T.copy() if turn else out)
    return best


def train(x: np.ndarray, y: np.ndarray, bins: int = 32, coarse_bins: int = 8, rounds: int = 150, pair_rounds: int = 40, n_pairs: int = 6, rate: float = 0.15) -> Gam:
    """Cyclic boosting of feature tables, then of the tables of the strongest pairs."""
    share = (y.sum() + 1) / (len(y) + 2)
    start = float(np.log(share / (1 - share)))
    m = x.shape[1]
    edges = [np.unique(np.quantile(x[:, i], np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.zeros(0) for i in range(m)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    coarse = [np.arange(len(t)) * min(coarse_bins, len(t)) // len(t) for t in tables]
    model = Gam(start, edges, tables, [], coarse)
    if len(np.unique(y)) < 2:
        return model
    b = [np.searchsorted(e, x[:, i], "right") for i, e in enumerate(edges)]
    z = np.full(len(y), start)

    def slopes():
        p = 1 / (1 + np.exp(-z))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for i in range(m):
            g, h = slopes()
            step = rate * _tree(np.bincount(b[i], g, len(tables[i])), np.bincount(b[i], h, len(tables[i])), 3)
            tables[i] += step
            z += step[b[i]]
    c = [coarse[i][b[i]] for i in range(m)]
    shape = [int(k.max()) + 1 for k in coarse]

    def cells(i, j):
        g, h = slopes()
        at, size = c[i] * shape[j] + c[j], shape[i] * shape[j]
        return _pair_tree(np.bincount(at, g, size).reshape(shape[i], -1), np.bincount(at, h, size).reshape(shape[i], -1))

    ranked = sorted(((cells(i, j)[0], i, j) for i, j in combinations(range(m), 2) if min(shape[i], shape[j]) > 1), key=lambda r: (-r[0], r[1:]))
    model.pairs = [(i, j, np.zeros((shape[i], shape[j]))) for _, i, j in ranked[:n_pairs]]
    for _ in range(pair_rounds):
        for i, j, t in model.pairs:
            step = rate * cells(i, j)[1]
            t += step
            z += step[c[i], c[j]]
    return model


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Gam:
    """Learn from the texts of the documents that ``labels`` (doc_id, label) names."""
    known = labels.select(F.col("doc_id").cast("long").alias("id"), F.col(label).cast("int").alias("y")).where("id is not null and y is not null")
    chosen = known.distinct().orderBy(F.xxhash64("id"), "id", "y").limit(sample)  # at most ``sample`` rows of 12 bytes
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.join(F.broadcast(chosen), F.col("doc_id") == F.col("id")).select("doc_id", "y", "text")
    rows = rows.groupBy("doc_id", "y").agg(F.min("text").alias("text"))  # one text for each label, however many rows an id has

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                x = features(part.column("text"))
                yield pa.record_batch([part.column("doc_id"), part.column("y"), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))], names=["doc_id", "y", "x"])

    got = sorted(rows.mapInArrow(run, "doc_id long, y int, x array<double>").collect(), key=lambda r: (r["doc_id"], r["y"]))
    x = np.array([r["x"] for r in got]).reshape(len(got), len(FEATURES))
    return train(x, np.array([float(r["y"] > 0) for r in got]))


def score(docs: DataFrame, model: Gam) -> DataFrame:
    """(doc_id, score), one row for each row; score is near 1 where label 1 is likely."""
    known = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield pa.record_batch([part.column("doc_id"), pa.array(known.value.score(features(part.column("text"))))], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, score double")
