"""Token counts of whole texts without writing ids (operator 12).

A text is cut into pre-tokens inside the task that reads it, and the tokens of
a text are the sum of the lengths of its pre-tokens. Lengths come from two
tiers, and no pre-token is ever shuffled:

1. a compact open-addressing hash table of frequent pre-tokens (at most
   ``TABLE`` of up to 16 bytes, 17 bytes a slot, 2.2 MB in all), broadcast once
   and looked up for a whole batch in numpy. The key is the pre-token itself,
   zero-padded, so a hit is exact;
2. what the table misses goes to a memory of the Python worker (two generations
   of ``CACHE`` entries, kept from task to task) and, if that misses too, once
   through the tokenizers library.

Which pre-tokens are frequent is counted in a sample of about ``SAMPLE_ROWS``
rows, taken all over the table by a hash of the row's number; tasks count and
send only their most frequent ones. The sample decides the speed alone: any
table, an empty one too, gives the same counts.

Cuts. The tokenizer drops white space and splits letters, single digits and
other signs from one another (``PATTERN``). The numpy cut is made at ASCII
white space and between two ASCII characters that the pattern always parts; it
is never made next to a character beyond ASCII or a control character, nor
inside a run of signs, nor after an apostrophe. A piece may so hold several
pre-tokens; the library splits it further. A text with the string of an added
token is counted whole by the library, and so is every text if the tokenizer
is not of this kind.

Defined cases: null and empty texts have 0 bytes and 0 tokens; null and
repeated ids are rows like any other (one row out for each row in); an empty
table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import json
import os
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import LOWER, U64, slices, text_bytes

#: Frequent pre-tokens kept in the broadcast table, and its slots.
TABLE, SLOTS_LOG2 = 1 << 16, 17
#: Rows looked at for the table, and the most pre-tokens that one task sends.
SAMPLE_ROWS, SENT = 8192, 4096
#: Entries of one generation of a worker's memory (of up to LONG bytes; longer pieces are not remembered).
CACHE, LONG = 400_000, 64

# What the tokenizer file must say for the cut below to be right.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZERS = ["NFC", "Replace", "Lowercase"]

SPACE, LETTER, DIGIT, SIGN, APOSTROPHE, OTHER = range(6)
KIND = np.full(256, OTHER, np.uint8)
KIND[0x21:0x7F] = SIGN
KIND[[0x20, *range(0x09, 0x0E)]] = SPACE
KIND[0x30:0x3A] = DIGIT
KIND[0x41:0x5B] = KIND[0x61:0x7B] = LETTER
KIND[0x27] = APOSTROPHE
#: Whether a piece starts between two neighbours of these kinds.
CUT = np.zeros((6, 6), bool)
CUT[SPACE] = True
CUT[LETTER, [DIGIT, SIGN, APOSTROPHE]] = True
CUT[DIGIT, [LETTER, DIGIT, SIGN, APOSTROPHE]] = True
CUT[SIGN, [LETTER, DIGIT]] = True
CUT[APOSTROPHE, DIGIT] = True
CUT[:, SPACE] = True

#: Masks that keep the first n of eight bytes.
_MASK = np.array([(1 << (8 * n)) - 1 for n in range(9)], U64)


class Pieces:
    """Pieces of a batch of texts: ``start`` and ``end`` into ``data`` (A-Z folded); those of text i are ``ptr[i]:ptr[i + 1]``."""

    def __init__(self, raw: np.ndarray, off: np.ndarray):
        self.data = LOWER[raw]
        kind = KIND[raw]
        full = off[:-1] < off[1:]
        new = np.ones(len(raw), bool)
        if len(raw):
            new[1:] = CUT.ravel()[kind[:-1] * np.uint8(6) + kind[1:]]
        new[off[:-1][full]] = True
        ends = np.flatnonzero(new)
        starts, ends = ends, np.r_[ends[1:], len(raw)]
        word = kind[starts] != SPACE
        self.start, self.end = starts[word], ends[word]
        self.ptr = np.searchsorted(self.start, off)

    def keys(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first eight bytes, next eight bytes, whether the piece is its key)."""
        padded = np.zeros(len(self.data) + 16, np.uint8)
        padded[: len(self.data)] = self.data
        eight = np.ndarray(len(self.data) + 9, "<u8", padded, strides=(1,))
        size = self.end - self.start
        low = eight[self.start] & _MASK[np.minimum(size, 8)]
        high = eight[np.minimum(self.start + 8, len(self.data) + 8)] & _MASK[np.clip(size - 8, 0, 8)]
        return low, high, (size <= 16) & (self.data[self.end - 1] != 0) if len(size) else np.zeros(0, bool)

    def bytes_of(self, which: np.ndarray) -> list[bytes]:
        raw = self.data.tobytes()
        return [raw[a:b] for a, b in zip(self.start[which].tolist(), self.end[which].tolist(), strict=True)]

    def sums(self, value: np.ndarray) -> np.ndarray:
        """Sum of the pieces' values for each text."""
        total = np.r_[0, np.cumsum(value, dtype=np.int64)]
        return total[self.ptr[1:]] - total[self.ptr[:-1]]


class LengthTable:
    """Token counts by pre-token of at most 16 bytes: open addressing, linear probing, looked up in batches."""

    def __init__(self, lengths: dict[bytes, int], slots_log2: int = SLOTS_LOG2):
        if len(lengths) > 1 << (slots_log2 - 1):
            raise ValueError("a table is at most half full")
        n = 1 << slots_log2
        self.shift, self.wrap = U64(64 - slots_log2), n - 1
        self.low, self.high, self.value = np.zeros(n, U64), np.zeros(n, U64), np.zeros(n, np.uint8)
        for piece, length in lengths.items():
            if not 0 < len(piece) <= 16 or piece[-1] == 0 or not 0 < length < 256:
                raise ValueError(f"not a table entry: {piece!r}, {length}")
            low, high = (U64(int.from_bytes(piece[a: a + 8], "little")) for a in (0, 8))
            at = int(self.slot(np.array([low]), np.array([high]))[0])
            while self.value[at]:
                at = (at + 1) & self.wrap
            self.low[at], self.high[at], self.value[at] = low, high, length

    def slot(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return (((low ^ (high * U64(0xC2B2AE3D27D4EB4F))) * U64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def look_up(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The lengths, 0 where the table has none."""
        out = np.zeros(len(low), np.int64)
        left, at = np.arange(len(low)), self.slot(low, high)
        while len(left):
            value = self.value[at]
            same = (self.low[at] == low[left]) & (self.high[at] == high[left]) & (value > 0)
            out[left[same]] = value[same]
            on = ~same & (value > 0)
            left, at = left[on], (at[on] + 1) & self.wrap
        return out


class Counts:
    """Token counts of pieces by the tokenizers library, remembered in two generations."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        self.added = [t["content"].encode() for t in made.get("added_tokens") or []]
        before, normal = made.get("pre_tokenizer") or {}, made.get("normalizer") or {}
        split = (before.get("pretokenizers") or [{}])[0]
        self.cuts = (
            [n["type"] for n in normal.get("normalizers") or []] == NORMALIZERS and [p["type"] for p in before.get("pretokenizers") or []] == ["Split", "ByteLevel"]
            and split["pattern"] == {"Regex": PATTERN} and split["behavior"] == "Removed" and split["invert"] and not before["pretokenizers"][1]["add_prefix_space"]
            and not before["pretokenizers"][1]["use_regex"] and made["model"]["type"] == "BPE" and not made["model"].get("dropout")
        )
        self.young: dict[bytes, int] = {}
        self.old: dict[bytes, int] = {}

    def whole(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def of(self, pieces: list[bytes]) -> np.ndarray:
        young, old, fresh = self.young, self.old, {}
        out = [young.get(p) or old.get(p) for p in pieces]
        new = {p for p, n in zip(pieces, out, strict=True) if n is None}
        if new:
            new = list(new)
            fresh = dict(zip(new, self.whole([p.decode("utf-8", "replace") for p in new]), strict=True))
            out = [fresh[p] if n is None else n for p, n in zip(pieces, out, strict=True)]
        if len(young) > CACHE:
            self.old, self.young = young, {}
            young = self.young
        # a piece without a token (white space beyond ASCII) is asked again, which is rare
        young.update((p, n) for p, n in fresh.items() if n and len(p) <= LONG)
        return np.array(out, np.int64)


_COUNTS: dict[str, Counts] = {}


def counts_of(path: str) -> Counts:
    """The library and the memory of this Python worker, kept from task to task."""
    if path not in _COUNTS:
        _COUNTS[path] = Counts(path)
    return _COUNTS[path]


def count_batch(column, counts: Counts, table: LengthTable | None) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes, tokens) of each text of an Arrow string column."""
    raw, off = text_bytes(column)
    size = np.diff(off)
    n = np.zeros(len(size), np.int64)
    if counts.cuts:
        whole = [i for t in counts.added if t in (all_ := raw.tobytes()) for i in range(len(size)) if t in all_[off[i]: off[i + 1]]]
        whole = np.unique(np.array(whole, np.int64))
        pieces = Pieces(raw, off)
        low, high, fits = pieces.keys()
        value = table.look_up(low, high) * fits if table is not None else np.zeros(len(low), np.int64)
        missed = value == 0
        for i in whole.tolist():
            missed[pieces.ptr[i]: pieces.ptr[i + 1]] = False
        missed = np.flatnonzero(missed)
        value[missed] = counts.of(pieces.bytes_of(missed))
        n = pieces.sums(value)
    else:
        whole = np.arange(len(size))
    if len(whole):
        n[whole] = counts.whole([raw[off[i]: off[i + 1]].tobytes().decode("utf-8", "replace") for i in whole.tolist()])
    return size, n


def sample_pieces(docs: DataFrame, text_col: str = "text", rows: int = SAMPLE_ROWS, keep: int = TABLE, kind: type = Pieces) -> list[bytes]:
    """The most frequent pieces (of up to 16 bytes) of a sample of about ``rows`` rows from all over the table."""
    n = docs.count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for piece in slices(batch, "text"):
                p = kind(*text_bytes(piece.column("text")))
                seen.update(p.bytes_of(np.flatnonzero(p.keys()[2])))
                if len(seen) > 4 * SENT:
                    seen = Counter(dict(seen.most_common(2 * SENT)))
        most = [(p, k) for p, k in seen.most_common(SENT) if k > 1]
        yield pa.record_batch([pa.array([p for p, _ in most], pa.binary()), pa.array([k for _, k in most], pa.int64())], names=["piece", "n"])

    picked = docs.select(F.col(text_col).cast("string").alias("text"), F.xxhash64(F.monotonically_increasing_id()).alias("row"))
    picked = picked.where(F.pmod("row", F.lit(max(n, 1))) < rows).select("text")
    total: Counter = Counter()
    for r in picked.mapInArrow(run, "piece binary, n long").collect():
        total[bytes(r["piece"])] += r["n"]
    return [p for p, _ in sorted(total.items(), key=lambda x: (-x[1], x[0]))[:keep]]


def frequent(docs: DataFrame, tokenizer_path: str, text_col: str = "text", rows: int = SAMPLE_ROWS, keep: int = TABLE) -> dict[bytes, int]:
    """Token counts of the most frequent pre-tokens of the sample."""
    counts = Counts(tokenizer_path)
    if not counts.cuts:
        return {}
    best = sample_pieces(docs, text_col, rows, keep)
    return {p: k for p, k in zip(best, counts.of(best).tolist(), strict=True) if 0 < k < 256}


def count_tokens(docs: DataFrame, tokenizer_path: str, text_col: str = "text", lengths: dict[bytes, int] | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row; ``lengths`` are those of the table (default: of the frequent pre-tokens)."""
    if lengths is None:
        lengths = frequent(docs, tokenizer_path, text_col)
    table = docs.sparkSession.sparkContext.broadcast(LengthTable(lengths))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                size, n = count_batch(piece.column("text"), counts_of(tokenizer_path), table.value)
                yield pa.record_batch([piece.column("doc_id"), pa.array(size, pa.int64()), pa.array(n, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
