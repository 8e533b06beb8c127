"""Token counts against the library on whole texts, whatever the table holds."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

P = pytest.importorskip("public_tokenizers")
PATH = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    return lambda texts: [len(e.ids) for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def noise(n, seed=1):
    rng = random.Random(seed)
    signs = list("aAbsStTmd'’ \t\n\x0b\x0c\x1c\x85\xa0\x00\x7f019.,-_|<>!é̸́İßſKç中😀ﬁ२½Ⅷ 　") + ["<|endoftext|>", "<|ENDOFTEXT|>", "'s", "'ll", "'RE", "<|startoftext|>"]
    return ["".join(rng.choice(signs) for _ in range(rng.randrange(40))) for _ in range(n)] + ["", None]


def test_cuts_are_where_the_tokenizer_parts(library):
    from kestrel.llm.token_counts import Counts, LengthTable, count_batch

    counts = Counts(PATH)
    assert counts.cuts
    known = {p: counts.whole([p.decode()])[0] for p in (b"a", b"b", b"sst", b"0", b"'", b"abcdefghijklmnop")}
    texts = noise(20_000)
    want = library(texts)
    for table in (None, LengthTable({}), LengthTable(known), LengthTable(known, 4)):
        size, n = count_batch(pa.array(texts), counts, table)
        assert n.tolist() == want and size.tolist() == [len((t or "").encode()) for t in texts]


def test_table_finds_what_it_holds_and_nothing_else():
    import numpy as np

    from kestrel.llm.token_counts import LengthTable, Pieces

    rng = random.Random(2)
    words = {bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 17))): rng.randrange(1, 9) for _ in range(3000)}
    table = LengthTable(words, 13)
    asked = list(words) + [bytes(rng.choice(b"abcd") for _ in range(rng.randrange(1, 17))) for _ in range(3000)]
    raw = b" ".join(asked)
    p = Pieces(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    low, high, fits = p.keys()
    assert fits.all() and p.bytes_of(np.arange(len(low))) == asked
    assert table.look_up(low, high).tolist() == [words.get(w, 0) for w in asked]
    for wrong in ({b"": 1}, {b"a\0": 1}, {b"a" * 17: 1}, {b"a": 0}, {b"a": 256}):
        with pytest.raises(ValueError):
            LengthTable(wrong)
    with pytest.raises(ValueError):
        LengthTable(words, 11)


def test_memory_is_bounded_and_changes_nothing(library, monkeypatch):
    from kestrel.llm import token_counts as T

    monkeypatch.setattr(T, "CACHE", 50)
    counts, texts = T.Counts(PATH), noise(3000, 3)
    for i in range(0, len(texts), 100):
        assert T.count_batch(pa.array(texts[i: i + 100]), counts, None)[1].tolist() == library(texts[i: i + 100])
        assert all(len(p) <= T.LONG for p in counts.young)
    assert len(counts.old) < 3000


def test_rows_and_odd_cases(spark, odd, none, library):
    from kestrel.llm.token_counts import count_tokens, frequent

    assert count_tokens(none, PATH).count() == 0 and frequent(none, PATH) == {}
    rows = odd.select("doc_id", "text").collect()
    want = sorted((r["doc_id"] or -1, len((r["text"] or "").encode()), n) for r, n in zip(rows, library([r["text"] for r in rows]), strict=True))
    for lengths in (None, {}):
        got = count_tokens(odd.withColumnRenamed("fp", "n_tokens"), PATH, lengths=lengths)
        assert got.columns == ["doc_id", "n_bytes", "n_tokens"]
        assert sorted((r["doc_id"] or -1, r["n_bytes"], r["n_tokens"]) for r in got.collect()) == want


def test_frequent_pieces_have_their_lengths(spark, library):
    from kestrel.llm.token_counts import frequent

    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("The cat's 12 hats "), F.col("id").cast("string")).alias("text"))
    got = frequent(docs, PATH)
    assert {b"the", b"cat", b"'s", b"1", b"2", b"hats"} <= set(got) and got == dict(zip(got, library([p.decode() for p in got]), strict=True))
    assert len(frequent(docs, PATH, keep=3)) == 3


def test_query_equals_the_library(spark, library):
    from kestrel.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = {r["doc_id"]: (len((r["text"] or "").encode()), n, n > 2048) for r, n in zip(docs, library([r["text"] for r in docs]), strict=True)}
    got = QUERIES["op12_token_counts"](spark, sf).collect()
    assert len(got) == len(docs) and {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in got} == want
