"""Language identification by nearest centroid (operator 5).

A text is a vector of its byte pairs and triples (ASCII lower-cased, ASCII
non-letters as one space), hashed into ``DIMS`` places: log counts times
inverse document frequency, scaled to length one. Each language has up to
``clusters`` centroids from spherical k-means (k-means++ seeds; the texts of a
cluster of under ``OUTLIERS`` of the sample are set aside); a text gets the
language of the centroid with the largest cosine. It is rejected if that cosine
is below ``margin`` times the low quantile (``QUANTILE``) of the cosines that
training texts of the language have which were held out of its centroids (every
fourth of the sample), or if it has no letter. So neither an empty text
nor a few strange ones under a label open the limit.

The model is fitted on a bounded sample: per language the ``sample`` rows with
the least hash of their id among those with a letter, whole texts. Vectors are made and clustered on the
executors, one group of at most ``sample`` vectors per language; the driver
gets the centroids. Prediction is one pass without a shuffle; the model
(languages x clusters x DIMS floats) is broadcast.

Defined cases: a null text or one without a letter is ``und`` with score 0 and
rejected, and no training row; with no training row everything is ``und``; equal cosines go to the
language that sorts first; empty tables give empty results; repeated rows each
return a row; clashing extra columns are carried through untouched
(``keep_identified``) or not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.common import BLOCK_BYTES, LOWER, free_name, slices, text_bytes

DIMS = 4096
CLUSTERS = 4
SAMPLE = 400
MARGIN = 0.5
QUANTILE = 0.05
OUTLIERS = 0.02
UNKNOWN = "und"
_ROWS = 512

_CLEAN = LOWER.copy()
_CLEAN[: 0x41] = _CLEAN[0x5B: 0x61] = _CLEAN[0x7B: 0x80] = 0x20


def counts(column) -> np.ndarray:
    """Hashed n-gram counts, a row of DIMS for each text."""
    data, off = text_bytes(column)
    n = len(off) - 1
    out = np.zeros(n * DIMS, np.float32)
    b = _CLEAN[data].astype(np.uint32)
    text = np.repeat(np.arange(n), np.diff(off))
    two = (b[:-1] << np.uint32(8)) | b[1:]
    three = (two[:-1] << np.uint32(8)) | b[2:]
    for code, salt in ((two, 0x9E3779B1), (three, 0x85EBCA6B)):
        size = len(code)
        if size <= 0:
            continue
        reach = len(b) - size
        same = text[:size] == text[reach:]
        place = (code * np.uint32(salt)) >> np.uint32(20)
        out += np.bincount(text[:size][same] * DIMS + place[same], minlength=n * DIMS).astype(np.float32)
    return out.reshape(n, DIMS)


def _unit(x: np.ndarray) -> np.ndarray:
    size = np.sqrt((x * x).sum(1, keepdims=True))
    return x / np.where(size == 0, 1, size)


def vectors(tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return _unit(np.log1p(tf) * idf)


@dataclass
class LanguageModel:
    idf: np.ndarray
    centroids: np.ndarray
    languages: list = field(default_factory=list)  # of each centroid
    least: np.ndarray = None  # least cosine that a centroid takes

    def predict(self, column) -> tuple[list, np.ndarray, np.ndarray]:
        """(language, cosine, whether the cosine is within reach) of each text."""
        lang, score, near = [], [], []
        n = len(column)
        for a in range(0, n, _ROWS):
            x = vectors(counts(column.slice(a, _ROWS)), self.idf)
            if not self.languages:
                lang += [UNKNOWN] * len(x)
                score.append(np.zeros(len(x)))
                near.append(np.zeros(len(x), bool))
                continue
            cos = np.clip((x @ self.centroids.T).astype(np.float64), 0, 1)
            best = cos.argmax(1)
            top = cos[np.arange(len(x)), best]
            lang += [self.languages[i] for i in best.tolist()]
            score.append(top)
            near.append((top > 0) & (top >= self.least[best]))
        return lang, np.concatenate(score or [np.zeros(0)]), np.concatenate(near or [np.zeros(0, bool)])


def _seeds(x: np.ndarray, k: int) -> list[int]:
    """k-means++ from a fixed random state: far texts are likely seeds, no single one is a sure seed."""
    rng = np.random.default_rng(5)
    seed = [int((x @ _unit(x.sum(0, keepdims=True))[0]).argmax())]
    while len(seed) < min(k, len(x)):
        far = np.clip(1 - (x @ x[seed].T).max(1), 0, None).astype(np.float64)
        far[far < 1e-6] = 0
        if not far.any():
            break
        seed.append(int(rng.choice(len(x), p=far / far.sum())))
    return seed


def _cluster(x: np.ndarray, k: int, rounds: int = 20) -> np.ndarray:
    """Centroids of spherical k-means.

    The texts of a cluster with a share of under ``OUTLIERS`` are set aside and
    the rest is clustered anew, as long as nine tenths of the texts stay.
    """
    texts = len(x)
    while True:
        c = x[_seeds(x, k)]
        for _ in range(rounds):
            own = (x @ c.T).argmax(1)
            c = _unit(np.stack([x[own == i].sum(0) if (own == i).any() else c[i] for i in range(len(c))]))
        own = (x @ c.T).argmax(1)
        stays = np.bincount(own, minlength=len(c))[own] >= OUTLIERS * texts
        if stays.all() or stays.sum() < 0.9 * texts:
            break
        x = x[stays]
    return c[[i for i in range(len(c)) if (own == i).any()]]


def _learn(x: np.ndarray, k: int) -> tuple[np.ndarray, float]:
    """(centroids, low quantile of the cosines of texts held out of them: every fourth, or all if they are too few)."""
    held = np.arange(len(x)) % 4 == 3
    if len(x) < 8:
        held[:] = False
    c = _cluster(x[~held], k)
    return c, float(np.quantile(((x[held] if held.any() else x) @ c.T).max(1), QUANTILE))


def fit(docs: DataFrame, label: str = "lang", clusters: int = CLUSTERS, sample: int = SAMPLE, margin: float = MARGIN) -> LanguageModel:
    """Learn from ``text`` and the non-null ``label`` of the given rows."""
    from kestrel.session import shared_dir

    shared_dir(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    # a text without a letter or of one byte has no vector to learn from, and must not take a place in the sample
    rows = rows.where("lang is not null and text is not null and doc_id is not null").where(F.col("text").rlike(r"\p{L}") & (F.octet_length("text") > 1))
    # the least hashes of a frequent language are looked for below four times the hash that ``sample`` rows should reach
    ids = rows.select("doc_id", "lang", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)).alias("hash"))
    # ids are counted and not rows: one id may have very many
    often = ids.groupBy("lang").agg((F.lit(4.0 * sample * (1 << 40)) / F.approx_count_distinct("doc_id")).alias("below"))
    low = ids.join(F.broadcast(often), "lang").where(F.col("hash") <= F.col("below")).distinct()  # one row for each language
    order = Window.partitionBy("lang").orderBy("hash", "doc_id")
    chosen = low.withColumn("n", F.row_number().over(order)).where(F.col("n") <= sample)
    # ``sample`` ids for each language at most
    chosen = chosen.select(F.col("doc_id").alias("id"), F.col("lang").alias("of")).distinct()
    picked = rows.join(F.broadcast(chosen), (F.col("doc_id") == F.col("id")) & (F.col("lang") == F.col("of"))).select("lang", "doc_id", "text")
    picked = picked.groupBy("lang", "doc_id").agg(F.min("text").alias("text"))  # one text for each id

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", BLOCK_BYTES // 4):
                for a in range(0, part.num_rows, _ROWS):
                    piece = part.slice(a, _ROWS)
                    tf = counts(piece.column("text"))
                    yield pa.record_batch([piece.column("lang"), piece.column("doc_id"), pa.array([t.astype("<f4").tobytes() for t in tf], pa.binary())], names=["lang", "doc_id", "tf"])

    counted = picked.mapInArrow(count, "lang string, doc_id long, tf binary").checkpoint()

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(DIMS, np.int64), 0
        for batch in batches:
            for x in batch.column("tf"):
                total += np.frombuffer(x.as_py(), "<f4") > 0
                n += 1
        yield pa.record_batch([pa.array([total.tobytes()], pa.binary()), pa.array([n], pa.int64())], names=["seen", "n"])

    got = counted.select("tf").mapInArrow(seen, "seen binary, n long").collect()
    n = sum(r["n"] for r in got)
    df = sum((np.frombuffer(bytes(r["seen"]), np.int64) for r in got), np.zeros(DIMS, np.int64))
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)

    def group(rows_: pa.Table) -> pa.Table:
        rows_ = rows_.take(np.argsort(rows_["doc_id"].to_numpy(), kind="stable"))
        x = vectors(np.stack([np.frombuffer(v.as_py(), "<f4") for v in rows_["tf"]]), idf)
        c, least = _learn(x, clusters)
        return pa.table({"lang": pa.array([rows_["lang"][0].as_py()] * len(c), pa.string()), "centroid": pa.array([v.astype("<f4").tobytes() for v in c], pa.binary()), "least": pa.array([least] * len(c), pa.float64())})

    made = sorted(counted.groupBy("lang").applyInArrow(group, "lang string, centroid binary, least double").collect(), key=lambda r: (r["lang"], bytes(r["centroid"])))
    centroids = np.stack([np.frombuffer(bytes(r["centroid"]), "<f4") for r in made]) if made else np.zeros((0, DIMS), np.float32)
    return LanguageModel(idf, centroids, [r["lang"] for r in made], np.array([r["least"] for r in made]) * margin)


def _marked(docs: DataFrame, letter: str) -> DataFrame:
    return docs.withColumn(letter, F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, lang_pred, score, rejected), one row for each row."""
    known = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                letter = part.column("_letter").to_numpy(zero_copy_only=False)
                lang, score, near = known.value.predict(part.column("text"))
                lang = [x if ok else UNKNOWN for x, ok in zip(lang, letter, strict=True)]
                yield pa.record_batch([part.column("doc_id"), pa.array(lang, pa.string()), pa.array(np.where(letter, score, 0.0)), pa.array(~(near & letter))], names=["doc_id", "lang_pred", "score", "rejected"])

    rows = _marked(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), "_letter")
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")


def keep_identified(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The rows of ``docs``, all columns, that are not rejected."""
    known = docs.sparkSession.sparkContext.broadcast(model)
    mark = free_name(docs, "_letter")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                letter = part.column(mark).to_numpy(zero_copy_only=False)
                yield part.drop_columns([mark]).filter(pa.array(known.value.predict(part.column("text"))[2] & letter))

    return _marked(docs, mark).mapInArrow(run, docs.schema)
