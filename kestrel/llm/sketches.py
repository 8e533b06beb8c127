"""Document fingerprints as invertible Bloom lookup sketches (operator 6).

A text is cut into paragraphs: at line feeds and, so that long lines do not
stand or fall as a whole, after words whose own hash says so (one in
``CUT``). Each paragraph's 64-bit digest (with its number among equal
paragraphs of the text) goes into one cell of each of three sub-tables; a cell
holds a count, the exclusive-or of the digests and of their check values.

The sketch of one version minus that of another holds the differing paragraphs
only. Peeling takes cells with one digest, takes that digest out of its other
cells, and goes on; what it takes out are the differing digests. If cells are
left over the difference was too large for the sketch, and both versions are
sketched again with four times the cells, until it works out. Likeness is the
share of common paragraphs among all, by those counts.

All texts of a batch are sketched and peeled together in numpy. For neighbours
in id order, documents are dealt out by id ranges (bounds are true ids, found
by an approximate quantile over the ids) and streamed in order; the first
document of a range is also sent to the end of the range before. Each text is
shuffled once.

Defined cases: a null text is empty; an empty text has an empty sketch, two
empty texts are alike (1.0); rows with one doc_id follow one another in the
order of their texts; a row with a null doc_id stands outside the order (its
next document is empty, and it is nobody's next); a single document is its own
next; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import BLOCK_BYTES, SPACE_WORDS, U64, Words, mix, slices, text_bytes

CELLS = 6  # of each of the three sub-tables of a fingerprint
CUT = 6
GROW = 4
_ROWS = 1024


class Paragraphs:
    """Digests of the paragraphs of a batch of texts: ``key``, and the text of each."""

    def __init__(self, column):
        data, off = text_bytes(column)
        w = Words(data, off, SPACE_WORDS)
        h, text = w.hashes(), w.doc()
        self.n = len(off) - 1
        if not len(h):
            self.key, self.text, self.count = np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(self.n, np.int64)
            return
        feeds = np.r_[0, np.cumsum(data == 0x0A)]
        new = np.r_[True, (text[1:] != text[:-1]) | (feeds[w.start[1:]] > feeds[w.end[:-1]]) | (h[:-1] % U64(CUT) == 0)]
        head = np.flatnonzero(new)
        place = np.arange(len(h)) - np.repeat(head, np.diff(np.r_[head, len(h)]))
        digest = mix(np.add.reduceat(mix(h + place.astype(U64) * U64(0x9E3779B97F4A7C15)), head))
        text = text[head]
        # equal paragraphs of a text are told apart by their number
        order = np.lexsort((digest, text))
        t, d = text[order], digest[order]
        first = np.flatnonzero(np.r_[True, (t[1:] != t[:-1]) | (d[1:] != d[:-1])])
        again = np.arange(len(t)) - np.repeat(first, np.diff(np.r_[first, len(t)]))
        self.key, self.text = mix(d + again.astype(U64) * U64(0xD1B54A32D192ED03)), t
        self.count = np.bincount(t, minlength=self.n)

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(keys, numbers within ``rows``) of some texts."""
        to = np.full(self.n, -1)
        to[rows] = np.arange(len(rows))
        at = to[self.text]
        return self.key[at >= 0], at[at >= 0]


def _check(key: np.ndarray) -> np.ndarray:
    return (mix(key ^ U64(0xC0FFEE)) >> U64(32)).astype(np.uint32)


def _places(key: np.ndarray, owner: np.ndarray, cells: int) -> list[np.ndarray]:
    return [owner * (3 * cells) + j * cells + (mix(key + U64(j + 1)) % U64(cells)).astype(np.int64) for j in range(3)]


class Sketch:
    """``n`` sketches side by side."""

    def __init__(self, n: int, cells: int):
        self.n, self.cells = n, cells
        self.count, self.key, self.check = np.zeros(n * 3 * cells, np.int32), np.zeros(n * 3 * cells, U64), np.zeros(n * 3 * cells, np.uint32)

    def add(self, key: np.ndarray, owner: np.ndarray, sign) -> Sketch:
        check = _check(key)
        for p in _places(key, owner, self.cells):
            np.add.at(self.count, p, sign)
            np.bitwise_xor.at(self.key, p, key)
            np.bitwise_xor.at(self.check, p, check)
        return self

    def minus(self, other: Sketch) -> Sketch:
        out = Sketch(self.n, self.cells)
        out.count, out.key, out.check = self.count - other.count, self.key ^ other.key, self.check ^ other.check
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(owner, digest, sign) of each recovered digest, and which sketches came out empty. Uses up the sketch."""
        owners, keys, signs = [], [], []
        look = np.arange(len(self.count))
        while len(look):
            pure = look[(np.abs(self.count[look]) == 1) & (_check(self.key[look]) == self.check[look])]
            key, owner = self.key[pure], pure // (3 * self.cells)
            places = _places(key, owner, self.cells)
            # of the cells that hold the same single digest the first one speaks
            single = np.zeros(len(self.count), bool)
            single[pure] = True
            first = np.full(len(pure), -1)
            for p in places[::-1]:
                first = np.where(single[p] & (self.key[p] == key), p, first)
            mine = first == pure
            pure, key, owner = pure[mine], key[mine], owner[mine]
            if not len(pure):
                break
            sign = self.count[pure].copy()
            owners.append(owner)
            keys.append(key)
            signs.append(sign)
            self.add(key, owner, -sign)
            look = np.unique(np.concatenate([p[mine] for p in places]))
        left = (self.count != 0) | (self.key != 0) | (self.check != 0)
        done = ~left.reshape(self.n, 3 * self.cells).any(1) if self.n else np.zeros(0, bool)
        if not owners:
            return np.zeros(0, np.int64), np.zeros(0, U64), np.zeros(0, np.int32), done
        return np.concatenate(owners), np.concatenate(keys), np.concatenate(signs), done

    def strings(self) -> list[str]:
        """Each sketch as base64 of its counts (2 bytes each), digests (8) and check values (4), little-endian."""
        cells = np.zeros((self.n, 3 * self.cells), np.dtype([("n", "<u2"), ("key", "<u8"), ("check", "<u4")]))
        shape = (self.n, 3 * self.cells)
        cells["n"], cells["key"], cells["check"] = self.count.reshape(shape) & 0xFFFF, self.key.reshape(shape), self.check.reshape(shape)
        return [base64.b64encode(row.tobytes()).decode() for row in cells]


def sketch(p: Paragraphs, cells: int = CELLS, rows: np.ndarray | None = None) -> Sketch:
    rows = np.arange(p.n) if rows is None else rows
    return Sketch(len(rows), cells).add(*p.take(rows), 1)


def differences(a: Paragraphs, rows_a: np.ndarray, b: Paragraphs, rows_b: np.ndarray, cells: int = CELLS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pair, digest, sign) of every differing paragraph of text rows_a[i] and text rows_b[i]; sign 1: only in a."""
    todo, found = np.arange(len(rows_a)), []
    while len(todo):
        failed = []
        # a bounded number of cells at a time
        for some in np.array_split(todo, max(1, len(todo) * 3 * cells // 400_000)):
            left, right = sketch(a, cells, rows_a[some]), _sketch_with_repeats(b, cells, rows_b[some])
            pair, key, sign, done = left.minus(right).peel()
            good = done[pair]
            found.append((some[pair[good]], key[good], sign[good]))
            failed.append(some[~done])
        todo, cells = np.concatenate(failed), cells * GROW
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, U64), np.zeros(0, np.int32)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _sketch_with_repeats(p: Paragraphs, cells: int, rows: np.ndarray) -> Sketch:
    if len(np.unique(rows)) == len(rows):
        return sketch(p, cells, rows)
    one, back = np.unique(rows, return_inverse=True)
    s, out = sketch(p, cells, one), Sketch(len(rows), cells)
    for name in ("count", "key", "check"):
        setattr(out, name, getattr(s, name).reshape(len(one), -1)[back].ravel())
    return out


def likeness(a: Paragraphs, rows_a: np.ndarray, b: Paragraphs, rows_b: np.ndarray) -> np.ndarray:
    """Common paragraphs among all paragraphs of each pair, from what peeling recovers."""
    pair = differences(a, rows_a, b, rows_b)[0]
    apart = np.bincount(pair, minlength=len(rows_a))
    total = a.count[rows_a] + b.count[rows_b]
    common = (total - apart) / 2
    return np.where(total == 0, 1.0, common / np.maximum(total - common, 1))


def diff_versions(rows: DataFrame, left: str, right: str, key: str) -> DataFrame:
    """(key, only_left, only_right): digests of the paragraphs that just one of two text columns has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "l", BLOCK_BYTES // 4):
                a, b = Paragraphs(part.column("l")), Paragraphs(part.column("r"))
                all_ = np.arange(part.num_rows)
                pair, digest, sign = differences(a, all_, b, all_)
                out = []
                for s in (1, -1):
                    lists = [[] for _ in all_]
                    for i, d in sorted(zip(pair[sign == s].tolist(), digest[sign == s].view(np.int64).tolist(), strict=True)):
                        lists[i].append(d)
                    out.append(pa.array(lists, pa.list_(pa.int64())))
                yield pa.record_batch([part.column("k"), *out], names=["key", "only_left", "only_right"])

    picked = rows.select(F.col(key).cast("long").alias("k"), F.coalesce(F.col(left).cast("string"), F.lit("")).alias("l"), F.coalesce(F.col(right).cast("string"), F.lit("")).alias("r"))
    return picked.mapInArrow(run, "key long, only_left array<long>, only_right array<long>")


# ---------------------------------------------------------------- documents and their neighbours

_OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compared(ids: list, texts: list[str], following: list[str]) -> pa.RecordBatch:
    """The result rows of ``texts``, each with the text that follows it."""
    edited = []
    for t, f in zip(texts, following, strict=True):
        q = len(t) // 4
        edited.append(t[: len(t) - q] + f[:q])
    own, new, nxt = (Paragraphs(pa.array(x, pa.large_string())) for x in (texts, edited, following))
    rows = np.arange(len(texts))
    return pa.record_batch([
        pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited]),
        pa.array(sketch(own).strings()), pa.array(sketch(new).strings()),
        pa.array(likeness(own, rows, new, rows)), pa.array(likeness(own, rows, nxt, rows)),
    ], names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order (p, role, doc_id, text); a row's next one is the row after it in its range."""
    held = None  # the last row, as long as its next is not known
    for batch in batches:
        for part in slices(batch, "text", BLOCK_BYTES // 4):
            for a in range(0, part.num_rows, _ROWS):
                piece = part.slice(a, _ROWS)
                p, role, ids, texts = (piece.column(c).to_pylist() for c in ("p", "role", "doc_id", "text"))
                if held is not None:
                    p, role, ids, texts = [held[0], *p], [0, *role], [held[1], *ids], [held[2], *texts]
                own = [i for i in range(len(p) - 1) if role[i] == 0]
                if any(p[i] != p[i + 1] for i in own):
                    raise RuntimeError("a range of documents ended without the first one of the next")
                held = (p[-1], ids[-1], texts[-1]) if role[-1] == 0 else None
                if own:
                    yield _compared([ids[i] for i in own], [texts[i] for i in own], [texts[i + 1] for i in own])
    if held is not None:
        raise RuntimeError("a range of documents ended without the first one of the next")


def fingerprint_documents(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likenesses."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    got = rows.agg(F.min("doc_id").alias("least"), F.sum(F.octet_length("text")).alias("size")).first()
    ranges_ = max(1, -(-int(got["size"] or 0) // block_bytes))
    bounds = np.zeros(0, np.int64)
    if got["least"] is not None and ranges_ > 1:
        shares = [i / ranges_ for i in range(1, ranges_)]
        found = rows.select("doc_id").agg(F.percentile_approx("doc_id", shares, max(10_000, 20 * ranges_)).alias("b")).first()["b"]
        bounds = np.unique([b for b in found if b > got["least"]]).astype(np.int64)
    least, last = got["least"], len(bounds)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            p = np.searchsorted(bounds, ids, "right")
            yield _tagged(batch, p, 0)
            first = np.flatnonzero((p > 0) & (ids == np.r_[bounds, 0][p - 1]))
            if len(first):
                yield _tagged(batch.take(pa.array(first)), p[first] - 1, 1)
            first = np.flatnonzero(ids == least)
            if len(first):
                yield _tagged(batch.take(pa.array(first)), np.full(len(first), last), 1)

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", BLOCK_BYTES // 4):
                for a in range(0, part.num_rows, _ROWS):
                    texts = part.slice(a, _ROWS).column("text").to_pylist()
                    yield _compared([None] * len(texts), texts, [""] * len(texts))

    dealt = rows.where("doc_id is not null").mapInArrow(deal, "p int, role int, doc_id long, text string")
    tasks = max(1, min(last + 1, 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    ordered = dealt.repartition(tasks, "p").sortWithinPartitions("p", "role", "doc_id", "text")
    return ordered.mapInArrow(_stream, _OUT).unionAll(rows.where("doc_id is null").mapInArrow(alone, _OUT))


def _tagged(batch: pa.RecordBatch, p: np.ndarray, role: int) -> pa.RecordBatch:
    return pa.record_batch([pa.array(p, pa.int32()), pa.array(np.full(len(p), role), pa.int32()), batch.column("doc_id"), batch.column("text")], names=["p", "role", "doc_id", "text"])
