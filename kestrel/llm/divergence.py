"""Which sources of a language write unlike the rest of it, and in which terms (operator 13).

Counting. A task cuts its texts into terms in numpy, counts them for each
(lang, source) group it meets, and sends one row for each group and term; Spark
adds these up. A language keeps the terms of at least ``min_docs`` of its
documents; only those go on, written once to the shared folder.

Part ``pair``: for every two groups of a language the sum of f over all kept
terms. The terms of a language are dealt into chunks of about ``CELLS``
(term, source) cells; a task lays a chunk out as a dense matrix, as absent terms
count too, adds up one column against the others, and sends one number for each
pair of sources. No rows are made for pairs of occurrences.

Part ``term``: the ``k`` terms of a group with the greatest f. f rises with the
group's count and falls with the language's, and ties go to the earlier term
in UTF-8. So a term that k others dominate (count not lower, count in the
language not higher, earlier in UTF-8) cannot be among the k. Each task keeps
the k-skyband of the terms it reads for each group, those fewer than k others
dominate; a second round merges the bands of a group into one, which is exact
since a dropped term stays dominated; only what is left is valued and ranked.
Terms with p <= q are left out before: whatever dominates a term with p > q has
p > q itself, so they would push nothing else out.

All arithmetic is on whole numbers. Defined cases: null text, lang or source is
''; every row is a document, repeated rows and ids too; a group without terms
gets its pairs; a language without kept terms has pairs of value 0; a
language of one source has no pair; an empty table gives an empty result; other
columns, whatever their names, are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.common import LOWER, Words, slices, text_bytes, work_path

MIN_DOCS, TOP = 10, 10
#: (term, source) cells that one matrix is aimed at.
CELLS = 1 << 17
#: Rows that a counting task holds before it adds equal ones up and sends what is left, and those of a skyband task.
HELD, BAND_ROWS = 1 << 18, 1 << 17
SCALE = 1_000_000_000

#: Terms are runs of a-z and of everything beyond ASCII (for lower-cased texts).
TERMS = np.zeros(256, bool)
TERMS[0x61:0x7B] = True
TERMS[0x80:] = True


def count_terms(batch: pa.RecordBatch, group: np.ndarray) -> pa.Table:
    """(g, term, n, docs) of a batch whose texts belong to the numbered groups: occurrences and documents."""
    raw, off = text_bytes(batch.column("text"))
    folded = LOWER[raw]
    words = Words(folded, off, TERMS)
    size = words.end - words.start
    ends = np.zeros(words.n + 1, np.int64)
    np.cumsum(size, out=ends[1:])
    texts = pa.LargeStringArray.from_buffers(words.n, pa.py_buffer(ends), pa.py_buffer(folded[TERMS[folded]]))
    coded = texts.dictionary_encode()
    terms = max(1, len(coded.dictionary))
    in_doc, n = np.unique(words.doc() * terms + coded.indices.to_numpy(), return_counts=True)
    key = group[in_doc // terms] * terms + in_doc % terms
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    return pa.table({
        "g": pa.array(key[first] // terms, pa.int64()), "term": coded.dictionary.take(pa.array(key[first] % terms)),
        "n": pa.array(np.add.reduceat(n, first) if len(first) else n, pa.int64()), "docs": pa.array(np.diff(np.r_[first, len(key)]), pa.int64()),
    })


def _group_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs), equal ones added up within the task; a row with term '' for each group met."""
    number: dict[tuple[str, str], int] = {}
    told = 0
    held: list[pa.Table] = []

    def merged() -> pa.Table:
        all_ = pa.concat_tables(held).combine_chunks().group_by(["g", "term"], use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
        return pa.table({"g": all_["g"], "term": all_["term"], "n": all_["n_sum"], "docs": all_["docs_sum"]})

    def send(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        nonlocal told
        groups = list(number)
        new = len(groups) - told
        rows = pa.concat_tables([rows, pa.table({"g": pa.array(range(told, len(groups)), pa.int64()), "term": pa.array([""] * new, pa.large_string()), "n": pa.array([0] * new, pa.int64()), "docs": pa.array([0] * new, pa.int64())})])
        told = len(groups)
        names = [pa.array([g[i] for g in groups], pa.string()) for i in (0, 1)]
        for part in rows.combine_chunks().to_batches(max_chunksize=1 << 16):
            g = part.column("g")
            yield pa.record_batch([names[0].take(g), names[1].take(g), part.column("term").cast(pa.string()), part.column("n"), part.column("docs")], names=["lang", "source", "term", "n", "docs"])

    for batch in batches:
        for piece in slices(batch, "text"):
            pairs = zip(piece.column("lang").to_pylist(), piece.column("source").to_pylist(), strict=True)
            group = np.array([number.setdefault(p, len(number)) for p in pairs], np.int64)
            held.append(count_terms(piece, group))
            if sum(map(len, held)) > HELD:
                held = [merged()]
                if len(held[0]) > HELD // 2:
                    rows, held = held[0], []
                    yield from send(rows)
    if held:
        yield from send(merged())


def kept_counts(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, source, term, n, lang_n, lead): counts of the kept terms; term '' for each group; ``lead`` marks one row of each kept term."""
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    parts = rows.mapInArrow(_group_counts, "lang string, source string, term string, n long, docs long")
    counts = parts.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    # at most one row for each source meets here
    of_term = Window.partitionBy("lang", "term")
    counts = counts.select("lang", "source", "term", "n", F.sum("n").over(of_term).alias("lang_n"), F.sum("docs").over(of_term).alias("docs"),
                           ((F.row_number().over(of_term.orderBy("source")) == 1) & (F.col("term") != "")).alias("lead"))
    return counts.where((F.col("docs") >= min_docs) | (F.col("term") == "")).drop("docs")


def group_sizes(kept: DataFrame) -> DataFrame:
    """(lang, source, total, lang_total, terms, sources, place): one row for each group; ``place`` counts a language's sources from 0."""
    of_lang = Window.partitionBy("lang")
    out = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.sum(F.col("lead").cast("long")).alias("own"))
    return out.select("lang", "source", "total", F.sum("total").over(of_lang).alias("lang_total"), F.sum("own").over(of_lang).alias("terms"),
                      F.count(F.lit(1)).over(of_lang).alias("sources"), (F.row_number().over(of_lang.orderBy("source")) - 1).alias("place"))


# ---------------------------------------------------------------- pairs

def share(n: np.ndarray, size) -> np.ndarray:
    """1 + floor(10**9 * (n + 2) / size) in whole numbers: long division by thousands, so nothing overflows while size < 9 * 10**15."""
    rest, out = n + 2, np.zeros(np.broadcast(n, size).shape, np.int64)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // size
        rest = rest % size
    return out + 1


def pair_sums(term: np.ndarray, place: np.ndarray, n: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Matrix over sources: f summed over the numbered terms; (term, place, n) are the counts over 0, ``size`` is each source's divisor."""
    s, v = len(size), int(term.max()) + 1 if len(term) else 0
    out = np.zeros((s, s), np.int64)
    if not v:
        return out
    p = np.tile(share(np.zeros(s, np.int64), size), (v, 1))
    p[term, place] = share(n, size[place])
    p = np.ascontiguousarray(p.T)
    for a in range(s - 1):
        d = p[a + 1:] - p[a]
        out[a, a + 1:] = (d * d // (p[a + 1:] + p[a])).sum(axis=1)
    return out + out.T


def _pairs_of_chunk(counts: pa.Table, groups: pa.Table) -> pa.Table:
    if not len(groups):  # a language of one source
        return pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())]).empty_table()
    place = groups.column("place").to_numpy()
    order = np.argsort(place)
    size = (groups.column("total").to_numpy() + 2 * groups.column("terms").to_numpy())[order]
    coded = counts.column("term").combine_chunks().dictionary_encode() if len(counts) else None
    term = coded.indices.to_numpy() if coded is not None else np.zeros(0, np.int64)
    sums = pair_sums(term, counts.column("place").to_numpy(), counts.column("n").to_numpy(), size)
    a, b = np.nonzero(~np.eye(len(size), dtype=bool))
    source = groups.column("source").combine_chunks().take(pa.array(order))
    lang = groups.column("lang").combine_chunks()[0].as_py()
    return pa.table({"lang": pa.array([lang] * len(a), pa.string()), "source": source.take(pa.array(a)), "item": source.take(pa.array(b)), "value": pa.array(sums[a, b], pa.int64())})


def pair_part(kept: DataFrame, groups: DataFrame, cells: int = CELLS) -> DataFrame:
    chunks = F.greatest(F.lit(1), F.ceil(F.col("terms") * F.col("sources") / F.lit(cells))).cast("int")
    groups = groups.withColumn("chunks", chunks)
    again = groups.select(*[F.col(c).alias(c) for c in groups.columns])  # columns of their own for the other side
    left = kept.where("term != ''").join(again, ["lang", "source"]).select(
        "lang", F.pmod(F.xxhash64("term"), "chunks").cast("int").alias("chunk"), "term", "place", "n")
    right = groups.where("sources > 1").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    sums = left.groupBy("lang", "chunk").cogroup(right.groupBy("lang", "chunk")).applyInArrow(
        _pairs_of_chunk, "lang string, source string, item string, value long")
    out = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return out.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank"))


# ---------------------------------------------------------------- terms

def skyband(n: np.ndarray, lang_n: np.ndarray, rank: np.ndarray, k: int, block: int = 128) -> np.ndarray:
    """Places of the entries that fewer than k others dominate: n not lower, lang_n not higher, rank lower.

    Entries are looked at with n falling, so whatever dominates one comes before
    it, and only members need comparing: what dominates a dropped entry's victim
    is dominated itself by k members.
    """
    order = np.lexsort((rank, lang_n, -n))
    low, at = lang_n[order], rank[order]
    members: list[int] = []
    m_low, m_at = np.zeros(0, low.dtype), np.zeros(0, at.dtype)
    for i in range(0, len(order), block):
        a, b = low[i: i + block], at[i: i + block]
        above = ((m_low[None, :] <= a[:, None]) & (m_at[None, :] < b[:, None])).sum(axis=1)
        left = np.flatnonzero(above < k)
        a, b, above = a[left], b[left], above[left]
        over = np.ascontiguousarray(((a[None, :] <= a[:, None]) & (b[None, :] < b[:, None])).T)  # row j: whom j dominates, if it comes before
        new: list[int] = []
        for j in range(len(left)):
            if above[j] < k:
                new.append(j)
                above[j + 1:] += over[j, j + 1:]
        members += (i + left[new]).tolist()
        m_low, m_at = np.r_[m_low, a[new]], np.r_[m_at, b[new]]
    return order[members]


def _bands(k: int, rows_held: int = BAND_ROWS):
    """Keeps the k-skyband of each group of the rows that a task reads; a band is a partial result, whoever merges it."""

    def narrowed(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        rank = np.empty(len(rows), np.int64)
        rank[pc.sort_indices(rows.column("term").cast(pa.binary()), sort_keys=[("", "ascending")]).to_numpy()] = np.arange(len(rows))
        lang, source = (rows.column(c).combine_chunks().dictionary_encode() for c in ("lang", "source"))
        g = lang.indices.to_numpy().astype(np.int64) * max(1, len(source.dictionary)) + source.indices.to_numpy()
        n, lang_n = rows.column("n").to_numpy(), rows.column("lang_n").to_numpy()
        order = np.argsort(g, kind="stable")
        edge = np.r_[0, np.flatnonzero(np.diff(g[order])) + 1, len(order)]
        keep = [order[a:b][skyband(n[order[a:b]], lang_n[order[a:b]], rank[order[a:b]], k)] for a, b in zip(edge[:-1], edge[1:], strict=True) if b > a]
        return rows.take(pa.array(np.concatenate(keep) if keep else np.zeros(0, np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            if sum(map(len, held)) > rows_held:
                held = [narrowed(pa.concat_tables(held))]
                if len(held[0]) > rows_held // 2:  # bands of very many groups: sent on as they are, merged later
                    yield from held.pop().to_batches(max_chunksize=1 << 16)
        if held:
            yield from narrowed(pa.concat_tables(held)).to_batches(max_chunksize=1 << 16)

    return run


def term_part(kept: DataFrame, groups: DataFrame, k: int = TOP) -> DataFrame:
    def p(n, total):
        part = F.expr(f"(cast({n} + 2 as decimal(20,0)) * cast({SCALE} as decimal(10,0))) div cast({total} + 2 * terms as decimal(20,0))")
        return part + 1

    sizes = groups.select("lang", "source", "total", "lang_total", "terms")
    rows = kept.where("term != '' and n > 0").join(sizes, ["lang", "source"]).withColumn("p", p("n", "total")).withColumn("q", p("lang_n", "lang_total"))
    # whatever dominates a term with p > q has p > q itself, so the others count for nothing
    rows = rows.where("p > q").select("lang", "source", "term", "n", "lang_n", "p", "q")
    schema = "lang string, source string, term string, n long, lang_n long, p long, q long"
    bands = rows.mapInArrow(_bands(k), schema)
    # the bands of a group meet in one task, which holds no more than it keeps
    bands = bands.repartition("lang", "source").mapInArrow(_bands(k), schema)
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term"))
    valued = bands.withColumn("value", F.expr("((p - q) * (p - q)) div (p + q)")).withColumn("rank", rank).where(F.col("rank") <= k)
    return valued.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, k: int = TOP, cells: int = CELLS) -> DataFrame:
    """(lang, source, part, item, value, rank) of both parts."""
    spark, base = docs.sparkSession, work_path(docs.sparkSession, "divergence")
    kept_counts(docs, min_docs).write.parquet(f"{base}/kept")
    kept = spark.read.parquet(f"{base}/kept")
    group_sizes(kept).write.parquet(f"{base}/groups")
    groups = spark.read.parquet(f"{base}/groups")
    return pair_part(kept, groups, cells).unionByName(term_part(kept, groups, k))
