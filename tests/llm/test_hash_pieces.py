"""Operator 2 in bounded memory: a block is hashed in pieces that do not show in the values, and the buckets are even."""

import tracemalloc

import numpy as np
import pyarrow as pa

from kestrel.llm import common
from kestrel.llm.common import SPACE_WORDS, Words, grams, text_bytes


def cut(texts):
    return Words(*text_bytes(pa.array(texts, pa.string())), SPACE_WORDS)


def test_a_large_block_is_hashed_in_small_memory():
    w = cut(["some words of an average length and so on " * 50] * 2000)  # 4.3 MB, a block of operator 2
    tracemalloc.start()
    kept = [w.hashes(), w.hashes(71)]
    grams(kept[0], 13, 71)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 3 * kept[0].nbytes + 80 * common.HASH_BYTES


def test_pieces_do_not_show(monkeypatch):
    texts = ["a bc def", "", None, "  x" * 30, "ein sehr" + "-langes" * 40 + " Wort", "中文 😀 zwei", "a bc def"]
    w = cut(texts)
    words = [x for t in texts for x in (t or "").split()]
    whole = [(w.hashes(s), grams(w.hashes(s), 3, s), grams(w.hashes(s), 50, s)) for s in (0, 1)]
    for size in (1, 7, 64):
        monkeypatch.setattr(common, "HASH_BYTES", size)
        for s, seen in enumerate(whole):
            h = w.hashes(s)
            for a, b in zip(seen, (h, grams(h, 3, s), grams(h, 50, s)), strict=True):
                assert a.dtype == b.dtype and np.array_equal(a, b)
            assert len({*h.tolist()}) == len({*words}) and len(h) == len(words)
    assert len(cut([]).hashes()) == len(cut([None, " "]).hashes()) == len(grams(h, len(h) + 1)) == 0


def test_buckets_of_anchors_are_even():
    from kestrel.llm.substrings import _Block

    rng = np.random.default_rng(3)
    rows = pa.table({"doc_id": range(50), "text": [" ".join(map(str, rng.integers(0, 1 << 40, 1000))) for _ in range(50)]})
    size = np.bincount(common.bucket_of(_Block(rows, 13).anchors(5), 32), minlength=32)
    assert size.max() < 1.5 * size.mean()
