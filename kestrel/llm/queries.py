"""One query for each operator, bound to the given tables, and the oracle SQL where SQL can state it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kestrel.llm.substrings import dedup_substrings

    return dedup_substrings(table(spark, sf_dir, "documents"), digest=True).withColumnRenamed("kept", "kept_sha256")


ORACLE["op2_substring_dedup"] = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
word AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w),
win AS (SELECT doc_id, i, list_aggregate(ws[i:i + 12], 'string_agg', ' ') AS s
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w)),
start AS (SELECT s, min(doc_id) AS first_doc FROM win GROUP BY s),
gone AS (SELECT DISTINCT doc_id, i + o AS p
         FROM win JOIN start USING (s), (SELECT unnest(range(0, 13)) AS o) WHERE first_doc < doc_id),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n
         FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id
"""


@query
def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kestrel.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kestrel.llm.decontaminate import find_contamination

    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


_FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE["op3_benchmark_decontamination"] = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_FOLD}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all({_FOLD}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
size AS (SELECT DISTINCT least(10, len(ws)) AS n FROM b WHERE len(ws) > 0),
item AS (SELECT DISTINCT item_id, least(10, len(ws)) AS n, list_aggregate(ws[i:i + least(10, len(ws)) - 1], 'string_agg', ' ') AS s
         FROM (SELECT item_id, ws, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS i FROM b WHERE len(ws) > 0)),
win AS (SELECT doc_id, n, i, list_aggregate(ws[i:i + n - 1], 'string_agg', ' ') AS s
        FROM (SELECT doc_id, n, ws, unnest(range(1, len(ws) - n + 2)) AS i FROM d, size WHERE len(ws) >= n)),
meet AS (SELECT doc_id, n, i, item_id FROM win JOIN item USING (n, s)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM meet) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM meet WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON d.doc_id = hit.doc_id LEFT JOIN found ON d.doc_id = found.doc_id
"""


def _remainder(n: int):
    """crc32 of doc_id as text, modulo n."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


@query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kestrel.llm.languages import fit, identify

    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(_remainder(4) == 2, F.lit(False)).alias("held_out")
    return identify(docs, fit(docs.where(_remainder(4) != 2))).select("doc_id", held, "lang_pred", "score", "rejected")


@query
def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kestrel.llm.quality import fit, score

    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels").where(_remainder(5) != 0))
    held = F.coalesce(_remainder(5) == 0, F.lit(False)).alias("held_out")
    return score(docs, model).select("doc_id", held, "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kestrel.llm.lines import WHOLE_DOCS, dedup_lines

    out = dedup_lines(table(spark, sf_dir, "documents"), whole_docs=WHOLE_DOCS)
    return out.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), "text")


#: The (host, path) rules of the query.
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


@query
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kestrel.llm.urls import judge

    # a page is a bad example if the document of the same number is of low quality or toxic
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("block"))
    return judge(table(spark, sf_dir, "pages"), labels, URL_RULES)


@query
def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kestrel.llm.sketches import fingerprint_documents

    return fingerprint_documents(table(spark, sf_dir, "documents"))


@query
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kestrel.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"))


@query
def op10_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from kestrel.llm.common import work_path
    from kestrel.llm.tokens import read_tokens, write_tokens

    path = work_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), path)
    return read_tokens(spark, path)


@query
def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from kestrel.llm.token_counts import count_tokens

    out = count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return out.withColumn("over_limit", F.col("n_tokens") > 2048)


@query
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kestrel.llm.divergence import audit

    return audit(table(spark, sf_dir, "documents"))


ORACLE["op13_source_divergence"] = rf"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all({_FOLD}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
w AS (SELECT row, lang, source, unnest(ws) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS lang_n FROM w GROUP BY lang, term HAVING count(DISTINCT row) >= 10),
l AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY lang, source, term),
s AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY lang, source),
g AS (SELECT DISTINCT lang, source FROM d),
cell AS (SELECT g.lang, g.source, kept.term, coalesce(n, 0) AS n,
                1 + (1000000000::HUGEINT * (coalesce(n, 0) + 2)) // (coalesce(total, 0) + 2 * v)::HUGEINT AS p,
                1 + (1000000000::HUGEINT * (lang_n + 2)) // (lang_total + 2 * v)::HUGEINT AS q
         FROM g JOIN kept ON g.lang = kept.lang JOIN l ON g.lang = l.lang
         LEFT JOIN s ON g.lang = s.lang AND g.source = s.source
         LEFT JOIN c ON g.lang = c.lang AND g.source = c.source AND kept.term = c.term),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
      FROM cell a JOIN cell b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
part AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
         FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
         LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
         UNION ALL
         SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // (p + q) AS BIGINT) FROM cell WHERE n > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM part)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""


@query
def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kestrel.llm.conversation_trie import trie

    return trie(table(spark, sf_dir, "conversations"))


# crc32 of a decimal number, bit by bit over its characters
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST({c} AS VARCHAR), ''), lambda s: ascii(s)::BIGINT)),
          lambda x, y: list_reduce(list_prepend(xor(x, y), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda u, v: CASE WHEN u & 1 = 1 THEN xor(u >> 1, 3988292384) ELSE u >> 1 END)))"""
ORACLE["op11_conversation_trie"] = f"""
WITH o AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS d
           FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, max(d) AS turns, {_CRC.format(c="c")} % 9 AS h, c - c % 5 AS base FROM o GROUP BY c),
fam AS (SELECT own.c, own.h, own.base, least(own.h, coalesce(b.turns, 0)) AS taken FROM own LEFT JOIN own b ON b.c = own.base),
t AS (SELECT o.c, d - h + taken AS d, role, text FROM o JOIN fam ON o.c = fam.c WHERE d > h
      UNION ALL SELECT fam.c, d, role, text FROM fam JOIN o ON o.c = fam.base AND d <= h),
turn AS (SELECT c, d, strlen(text) AS bytes, sha256(strlen(role) || ':' || role || text) AS s FROM t),
seq AS (SELECT c, d, bytes, string_agg(s, '') OVER (PARTITION BY c ORDER BY d) AS s FROM turn UNION ALL SELECT c, 0, 0, '' FROM own),
member AS (SELECT c, d, bytes, sha256(s) AS s, max(d) OVER (PARTITION BY c) AS len FROM seq),
node AS (SELECT s, d, min(c) AS rep, count(*) AS n, max(bytes) AS bytes, max(len) AS deepest, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (len = d) AS ends
         FROM member GROUP BY s, d),
up AS (SELECT DISTINCT m.s, m.d, p.s AS above FROM member m JOIN member p ON p.c = m.c AND p.d = m.d - 1),
kids AS (SELECT above AS s, d - 1 AS d, count(*) AS n FROM up GROUP BY above, d),
below AS (SELECT DISTINCT m.s, m.d, v.s AS under, v.d AS under_d FROM member m JOIN member v ON v.c = m.c AND v.d >= m.d),
tree AS (SELECT below.s, below.d, sum((v.n - 1) * v.bytes) AS saved, count(*) FILTER (v.deepest = v.d) AS leaves
         FROM below JOIN node v ON v.s = under AND v.d = under_d GROUP BY below.s, below.d)
SELECT node.rep AS conv_id, node.d AS depth, parent.rep AS parent_conv_id, node.n AS n_convs, coalesce(kids.n, 0) AS n_children,
       leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(node.ends, '')) AS ends_sha256
FROM node JOIN tree ON node.s = tree.s AND node.d = tree.d LEFT JOIN kids ON node.s = kids.s AND node.d = kids.d
LEFT JOIN up ON node.s = up.s AND node.d = up.d LEFT JOIN node parent ON parent.s = up.above AND parent.d = node.d - 1
"""
