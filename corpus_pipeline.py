"""Corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``. All but the last
return the columns of ``documents``.

1. language id: documents whose language is rejected go;
2. line dedup: recurring template lines are taken out of the texts (``n_chars``
   follows the text); a document without a line left stays, with an empty text;
3. SimHash near-dedup: one document of each group stays, the one whose id
   names the group (of several rows with that id the first by source, language,
   text); rows without an id stay;
4. benchmark decontamination: documents with a hit word go;
5. best-fit packing: one row for each piece of each document.

Null texts: stage 1 rejects them. Empty tables stay empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kestrel.llm import decontaminate, languages, lines, packing, simhash
from kestrel.llm.common import free_name, table, work_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return languages.keep_identified(docs, languages.fit(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = lines.dedup_lines(docs, whole_docs=lines.WHOLE_DOCS, counts=(free_name(docs, "_n_lines"), free_name(docs, "_n_dropped")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicates(docs)
    # one row for each group: its least document id
    kept = groups.select(F.col("component_id").alias("_kept")).where("_kept is not null").distinct()
    found = docs.join(kept, docs["doc_id"] == kept["_kept"], "left_semi")
    # rows that share an id are as many as the table repeats that id
    order = Window.partitionBy("doc_id").orderBy(*(F.col(c) for c in docs.columns if c != "doc_id"))
    rank = free_name(docs, "_rank")
    one = found.withColumn(rank, F.row_number().over(order)).where(F.col(rank) == 1).drop(rank)
    return one.unionByName(docs.where("doc_id is null"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: The stages are not SQL (clustering, sketches of bits, sequential packing); tests hold each against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; what lies between is written below the shared folder."""
    docs = table(spark, sf_dir, "documents")
    base = work_path(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{i}-{name}")
        docs = spark.read.parquet(f"{base}/{i}-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
