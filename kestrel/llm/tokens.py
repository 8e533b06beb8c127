"""Token ids in fixed-width bit-packed blocks (operator 10).

Documents are sorted by id over range partitions; each partition encodes its
texts, appends the end id to each document, and packs the ids into blocks of
about ``BLOCK_TOKENS``. Every id takes the least number of bits that holds the
vocabulary.

A block is, little-endian: the magic ``KTB1``; width (1 byte); documents (4);
tokens (8); for each document its id (8) and a byte that is 1 if it has one;
the documents' end offsets in tokens (8 each); the packed ids, id i at bits
i * width to (i + 1) * width, lowest bit first. So any document of a block is
at a place that two offsets give, and numpy unpacks any run of ids at once.

Blocks are the rows of a Parquet table (part, block, n_docs, n_tokens,
payload), so that any file system Spark knows holds them and its commit
protocol covers lost executors. ``part`` follows the id ranges, ``block`` the
order inside one.

Encoding: a text is cut before each single space that a non-space follows, and
between two ASCII characters that are letter and sign, letter and digit or sign
and digit. A byte-level pre-tokeniser starts a piece there in any case, so the
parts' ids one after another are the text's ids. Frequent parts, of a bounded
sample, come to the workers as one broadcast list and are looked up in numpy by
their bytes; any other part goes through the tokenizers library once and is
remembered by the worker for as long as it is met. Texts that contain an added
token, and tokenizers of another kind, are encoded whole.

Defined cases: null and empty texts are the end id alone; null ids sort first;
rows with one doc_id follow one another in the order of their texts; an empty
table gives an empty file set and result; other columns are not looked at.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kestrel.llm.common import BLOCK_BYTES, ranges, slices, text_bytes
from kestrel.llm.token_counts import LengthTable, Pieces, sample_pieces

BLOCK_TOKENS = 1 << 20
END = 0
MAGIC = b"KTB1"
_HEAD = struct.Struct("<4sBIQ")


def pack(ids: np.ndarray, width: int) -> bytes:
    """Ids at ``width`` bits each, lowest bit first."""
    ids = ids.astype("<u4")
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = np.unpackbits(ids.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :width]
    return np.packbits(bits.ravel(), bitorder="little").tobytes()


def unpack(data, width: int, start: int, n: int) -> np.ndarray:
    """``n`` ids from the ``start``-th on."""
    raw = np.frombuffer(data, np.uint8)
    if width in (8, 16, 32):
        return raw[start * width // 8: (start + n) * width // 8].view(f"<u{width // 8}").astype("<u4")
    a, b = start * width // 8, -(-(start + n) * width // 8)
    bits = np.unpackbits(raw[a:b], bitorder="little")[start * width - 8 * a:][: n * width].reshape(n, width)
    wide = np.zeros((n, 32), np.uint8)
    wide[:, :width] = bits
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").ravel()


def write_block(doc_ids: list, counts: np.ndarray, ids: np.ndarray, width: int) -> bytes:
    known = np.array([d is not None for d in doc_ids], np.uint8)
    numbers = np.array([d or 0 for d in doc_ids], "<i8")
    return b"".join([_HEAD.pack(MAGIC, width, len(doc_ids), len(ids)), numbers.tobytes(), known.tobytes(), np.cumsum(counts).astype("<u8").tobytes(), pack(ids, width)])


class Block:
    """Random access to a written block."""

    def __init__(self, payload: bytes):
        magic, self.width, self.n_docs, self.n_tokens = _HEAD.unpack_from(payload)
        if magic != MAGIC:
            raise ValueError("not a token block")
        at = _HEAD.size
        numbers = np.frombuffer(payload, "<i8", self.n_docs, at)
        known = np.frombuffer(payload, np.uint8, self.n_docs, at + 8 * self.n_docs)
        self.doc_ids = [d if k else None for d, k in zip(numbers.tolist(), known.tolist(), strict=True)]
        self.ends = np.frombuffer(payload, "<u8", self.n_docs, at + 9 * self.n_docs).astype(np.int64)
        self.data = memoryview(payload)[at + 17 * self.n_docs:]

    def ids(self, start: int = 0, n: int | None = None) -> np.ndarray:
        return unpack(self.data, self.width, start, self.n_tokens - start if n is None else n)

    def document(self, i: int) -> np.ndarray:
        start = int(self.ends[i - 1]) if i else 0
        return self.ids(start, int(self.ends[i]) - start)


# Kinds of bytes for the cut; white space, control characters and bytes beyond ASCII have no kind.
_LETTER, _DIGIT, _SIGN, _APOSTROPHE, _OTHER = range(5)
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[0x21:0x7F] = _SIGN
_KIND[0x30:0x3A] = _DIGIT
_KIND[0x41:0x5B] = _KIND[0x61:0x7B] = _LETTER
_KIND[0x27] = _APOSTROPHE
_CUT = np.zeros((5, 5), bool)
_CUT[_LETTER, [_DIGIT, _SIGN, _APOSTROPHE]] = True
_CUT[_DIGIT, [_LETTER, _SIGN, _APOSTROPHE]] = True
_CUT[_SIGN, [_LETTER, _DIGIT]] = True
_CUT[_APOSTROPHE, _DIGIT] = True
#: Bytes that no white space character starts with.
_NO_SPACE = np.zeros(256, bool)
_NO_SPACE[0x21:0x7F] = True
_NO_SPACE[0xC3:] = True
_NO_SPACE[[0xE1, 0xE2, 0xE3]] = False


class Parts(Pieces):
    """Parts of a batch of texts that a byte-level pre-tokeniser never joins; a text in ``whole`` is one part."""

    def __init__(self, raw: np.ndarray, off: np.ndarray, whole: Iterable[int] = ()):
        self.data = raw
        kind = _KIND[raw]
        new = np.ones(len(raw), bool)
        if len(raw):
            new[1:] = _CUT.ravel()[kind[:-1] * np.uint8(5) + kind[1:]]
            new[:-1] |= (raw[:-1] == 0x20) & _NO_SPACE[raw[1:]]
        full = off[:-1] < off[1:]
        last = off[1:][full] - 1
        new[last] = _CUT.ravel()[kind[last - 1] * np.uint8(5) + kind[last]]  # what follows the last byte is another text
        for i in whole:
            new[off[i]: off[i + 1]] = False
        new[off[:-1][full]] = True
        self.start = np.flatnonzero(new)
        self.end = np.r_[self.start[1:], len(raw)][: len(self.start)]
        self.ptr = np.searchsorted(self.start, off)


class PlaceTable(LengthTable):
    """Places 1, 2, … of parts, by the same look-up as lengths."""

    def __init__(self, parts: list[bytes]):
        super().__init__({})
        self.value = self.value.astype(np.int32)
        raw = np.frombuffer(b"".join(parts), np.uint8)
        off = np.r_[0, np.cumsum([len(p) for p in parts])].astype(np.int64)
        asked = Parts(raw, off, range(len(parts)))
        low, high, fits = asked.keys()
        if not fits.all() or len(parts) > len(self.value) // 2:
            raise ValueError("parts of 1 to 16 bytes, and at most half as many as slots")
        for i, at in enumerate(self.slot(low, high).tolist()):
            while self.value[at]:
                at = (at + 1) & self.wrap
            self.low[at], self.high[at], self.value[at] = low[i], high[i], i + 1


class Encoder:
    """Ids of texts by the tokenizers library, each different part of a text encoded once.

    Places of frequent parts come from a table looked up in numpy; those of the
    others from a memory of two generations: a part not met again while ``KEEP``
    others were is forgotten, and its ids with it.
    """

    #: Parts remembered in a generation, of up to LONG bytes; parts that one call of the library takes.
    KEEP, LONG, JOINED = 300_000, 64, 256

    def __init__(self, path: str, frequent: list[bytes] = ()):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        self.added = [t["content"].encode() for t in made.get("added_tokens") or []]
        before = made.get("pre_tokenizer") or {}
        self.parts = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space") and not made.get("normalizer")
        self.width = max(1, int(self.tokenizer.get_vocab_size(with_added_tokens=True) - 1).bit_length())
        self.table = PlaceTable(list(frequent) if self.parts else [])
        # place 0 is that of no ids
        self.flat, self.size = np.zeros(0, np.uint32), np.zeros(1, np.int64)
        self.first = np.zeros(1, np.int64)
        self.young: dict[bytes, int] = {}
        self.old: dict[bytes, int] = {}
        feed = self._ids(["\n"])[0] if self.parts else []
        self.line_feed = feed[0] if len(feed) == 1 else None
        if self.parts and frequent:
            at = self._add(list(frequent))
            # the table counts its parts from 1 on in their order
            self.first[1:], self.size[1:] = self.first[at], self.size[at]
        self.fixed = len(self.size)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _add(self, parts: list[bytes]) -> np.ndarray:
        """The library's ids of parts go to the end; the place of each.

        A call costs more than a short part's ids, so parts without white space
        (but a space they may start with) go ``JOINED`` at a time, with a line feed
        between them. A line feed before other characters is a piece of its own and
        has one id, which no such part contains, so the ids are cut there.
        """
        texts = [p.decode("utf-8", "replace") for p in parts]
        plain = [i for i, t in enumerate(texts) if t.split() == [t[1:] if t[:1] == " " else t]] if self.line_feed is not None else []
        order, flats, sizes = [], [], []
        runs = [plain[a: a + self.JOINED] for a in range(0, len(plain), self.JOINED)]
        for run, ids in zip(runs, self._ids(["\n".join([texts[i] for i in run]) for run in runs]), strict=True):
            ids = np.array([*ids, self.line_feed], np.uint32)
            cut = np.flatnonzero(ids == self.line_feed)
            if len(cut) == len(run):
                order += run
                flats.append(ids[ids != self.line_feed])
                sizes.append(np.diff(np.r_[-1, cut]) - 1)
        done = set(order)
        alone = [i for i in range(len(texts)) if i not in done]
        got = self._ids([texts[i] for i in alone])
        flats.append(np.fromiter(chain.from_iterable(got), np.uint32))
        sizes.append(np.fromiter(map(len, got), np.int64, len(got)))
        place = np.empty(len(parts), np.int64)
        place[order + alone] = len(self.size) + np.arange(len(parts))
        size, flat = np.concatenate(sizes), np.concatenate(flats)
        self.first = np.r_[self.first, len(self.flat) + np.cumsum(size) - size]
        self.size, self.flat = np.r_[self.size, size], np.r_[self.flat, flat]
        return place

    def _forget(self) -> None:
        """The young become old; parts not met again since the last time go."""
        kept = list(self.young)
        place = np.r_[np.arange(self.fixed), np.fromiter(self.young.values(), np.int64, len(kept))].astype(np.int64)
        size = self.size[place]
        self.flat = self.flat[ranges(self.first[place], size)]
        self.first, self.size = np.cumsum(size) - size, size
        self.old, self.young = dict(zip(kept, range(self.fixed, self.fixed + len(kept)), strict=True)), {}

    def _places(self, parts: list[bytes]) -> np.ndarray:
        """Of parts that the table does not have."""
        young, old = self.young, self.old
        out = np.fromiter(map(young.get, parts, repeat(-1)), np.int64, len(parts))
        left = np.flatnonzero(out < 0).tolist()
        unseen: dict[bytes, int] = {}
        number = []
        for i in left:
            p = parts[i]
            at = old.get(p)
            if at is None:
                number.append(unseen.setdefault(p, len(unseen)))
            else:
                young[p] = out[i] = at
                number.append(-1)
        if unseen:
            place = self._add(list(unseen))
            number = np.array(number)
            new = number >= 0
            out[np.array(left)[new]] = place[number[new]]
            young.update((p, at) for p, at in zip(unseen, place.tolist(), strict=True) if len(p) <= self.LONG)
        return out

    def encode(self, column) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts of an Arrow string column, end id after each; number of ids of each text, end id included)."""
        if len(self.young) > self.KEEP or len(self.size) > self.fixed + 4 * self.KEEP:
            self._forget()
        raw, off = text_bytes(column)
        n = len(off) - 1
        if self.parts:
            all_ = raw.tobytes() if self.added else b""
            whole = {i for t in self.added if t in all_ for i in range(n) if t in all_[off[i]: off[i + 1]]}
        else:
            whole = set(range(n))
        parts = Parts(raw, off, whole)
        low, high, fits = parts.keys()
        place = self.table.look_up(low, high) * fits
        missed = np.flatnonzero(place == 0)
        place[missed] = self._places(parts.bytes_of(missed))
        size = self.size[place]
        ids = self.flat[ranges(self.first[place], size)]
        counts = parts.sums(size)
        return np.insert(ids, np.cumsum(counts), END), counts + 1


_ENCODERS: dict[tuple, Encoder] = {}


def encoder_of(path: str, frequent: Broadcast | None = None) -> Encoder:
    """The encoder of this Python worker, kept from task to task."""
    key = path, frequent and frequent.value[0]
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(path, frequent.value[1] if frequent else ())
    return _ENCODERS[key]


def write_tokens(docs: DataFrame, tokenizer_path: str, path: str, block_tokens: int = BLOCK_TOKENS, block_bytes: int = BLOCK_BYTES) -> None:
    """Encode all texts and write them to ``path`` in ascending order of doc_id."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # at most TABLE parts of up to 16 bytes
    frequent = docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, sample_pieces(rows, kind=Parts)))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-int(size) // (4 * block_bytes)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, number = None, 0
        part_no = TaskContext.get().partitionId()
        held: tuple[list, list, list] = ([], [], [])  # document ids, counts, ids

        def block():
            nonlocal number, held
            ids = np.concatenate(held[2])
            payload = write_block(held[0], np.concatenate(held[1]), ids, encoder.width)
            out = pa.record_batch([pa.array([part_no], pa.int32()), pa.array([number], pa.int32()), pa.array([len(held[0])], pa.int64()), pa.array([len(ids)], pa.int64()), pa.array([payload], pa.binary())], names=["part", "block", "n_docs", "n_tokens", "payload"])
            number, held = number + 1, ([], [], [])
            return out

        for batch in batches:
            for piece in slices(batch, "text", block_bytes // 2):
                encoder = encoder_of(tokenizer_path, frequent)
                ids, counts = encoder.encode(piece.column("text"))
                held[0].extend(piece.column("doc_id").to_pylist())
                held[1].append(counts)
                held[2].append(ids)
                if sum(map(len, held[2])) >= block_tokens:
                    yield block()
        if held[0]:
            yield block()

    ordered = rows.repartitionByRange(parts, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    ordered.mapInArrow(run, "part int, block int, n_docs long, n_tokens long, payload binary").write.option("compression", "zstd").parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the written blocks alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, number, payload in zip(batch.column("part").to_pylist(), batch.column("block").to_pylist(), batch.column("payload"), strict=True):
                b = Block(payload.as_py())
                ids, first = b.ids(), np.r_[0, b.ends[:-1]]
                crc = [zlib.crc32(ids[x:y]) for x, y in zip(first.tolist(), b.ends.tolist(), strict=True)]
                n = b.n_docs
                yield pa.record_batch([pa.array([part] * n, pa.int32()), pa.array([number] * n, pa.int32()), pa.array(b.doc_ids, pa.int64()), pa.array(first, pa.int64()), pa.array(b.ends - first, pa.int64()), pa.array(crc, pa.int64())], names=["part", "block", "doc_id", "inside", "n_tokens", "ids_crc32"])

    blocks = spark.read.schema("part int, block int, n_docs long, n_tokens long, payload binary").parquet(path)
    # starts: running sums inside a part, and over the parts (one row for each write task)
    sizes = blocks.select("part", "block", "n_tokens")
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("block")) - F.col("n_tokens")
    before = F.sum("all").over(Window.orderBy("part")) - F.col("all")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("all")).select("part", before.alias("before"))
    starts = sizes.withColumn("at", inside).join(parts, "part").select("part", "block", (F.col("at") + F.col("before")).alias("block_start"))
    rows = blocks.select("part", "block", "payload").mapInArrow(run, "part int, block int, doc_id long, inside long, n_tokens long, ids_crc32 long")
    return rows.join(starts, ["part", "block"]).select("doc_id", (F.col("block_start") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
