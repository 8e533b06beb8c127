"""URL filter by mined association rules (operator 1); DataFrame and SQL functions only.

A url becomes a set of tokens: its scheme, the labels of its host, the
segments of its path (runs of digits read ``0``) and its query keys. Spark's
FP-growth mines the token sets of labelled pages, each with its label as one
more item. Rules "tokens -> block" are kept by support, confidence and lift;
a rule that contains a shorter kept rule decides nothing new and is pruned.

Matching goes through an inverted index: each rule stands under its rarest
token only, distinct token sets (far fewer than pages) meet the rules of their
own tokens, and containment of the whole rule decides. The verdict of a token
set then goes back to its pages.

Given (host, path) rules come first: a rule fits its host and all subdomains if
the url's path starts with the rule's path; the longest wins.

Defined cases: host and path are empty for a null url or one without ``://``;
such a url has only the tokens it has (a null one none) and is allowed unless a
mined rule fits; a page with several labels is blocked if one of them says so;
labels or pages with a null id teach nothing; without labels nothing is mined;
repeated pages each return a row; an empty table gives an empty result; other
columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import ascii_lower
from kestrel.session import shared_dir

MIN_SUPPORT = 0.002
MIN_CONFIDENCE = 0.6
MIN_LIFT = 1.5
#: Pages that a rule must have been seen on, however small the table.
MIN_PAGES = 10
BLOCK = "=block"

_PARTS = r"(?s)^(.*?)://([^/?#]*)([^?#]*)(?:\?([^#]*))?"


def host_and_path(url):
    """(host, path) columns of a url column."""
    found = F.coalesce(url, F.lit(""))
    return ascii_lower(F.regexp_extract(found, _PARTS, 2)), F.regexp_extract(found, _PARTS, 3)


def tokens(url):
    """Sorted distinct tokens of a url column."""
    found = F.coalesce(url, F.lit(""))

    def parts(text, at, mark):
        return F.transform(F.filter(F.split(text, at), lambda x: x != ""), lambda x: F.concat(F.lit(mark), x))

    scheme = parts(ascii_lower(F.regexp_extract(found, _PARTS, 1)), "\\+", "s:")  # "git+ssh" are two
    host, path = host_and_path(url)
    folded = F.regexp_replace(ascii_lower(path), "[0-9]+", "0")
    query = F.regexp_replace(F.regexp_extract(found, _PARTS, 4), "=[^&]*", "")
    return F.array_sort(F.array_distinct(F.concat(scheme, parts(host, "\\.", "h:"), parts(folded, "/", "p:"), parts(query, "&", "q:"))))


def given_rule(host, path, rules: list[tuple[str, str]]):
    """The longest fitting (``verdict``, ``host/path``) rule of a short list, as (rule, verdict) columns."""
    rule = verdict = F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # the longest is the outermost condition
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def mine(pages: DataFrame, labels: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, min_lift: float = MIN_LIFT, min_pages: int = MIN_PAGES) -> DataFrame:
    """(antecedent, rare, confidence, support, lift): kept rules that say block.

    ``labels`` has (page_id, block boolean). ``rare`` is the token the rule is indexed under.
    """
    from pyspark.ml.fpm import FPGrowth

    shared_dir(pages.sparkSession)
    told = labels.where("page_id is not null").groupBy("page_id").agg(F.max(F.coalesce("block", F.lit(False))).alias("block"))
    sets = pages.where("page_id is not null").join(told, "page_id").select(
        F.concat(tokens(F.col("url")), F.when(F.col("block"), F.array(F.lit(BLOCK))).otherwise(F.array().cast("array<string>"))).alias("items"))
    sets = sets.checkpoint()  # read several times by the mining
    min_support = min(1.0, max(min_support, min_pages / max(1, sets.count())))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(sets)
    rules = model.associationRules.where((F.col("consequent")[0] == BLOCK) & (F.col("lift") >= min_lift))
    rules = rules.select(F.array_sort("antecedent").alias("antecedent"), "confidence", "support", "lift").checkpoint()
    often = model.freqItemsets.where(F.size("items") == 1).select(F.col("items")[0].alias("token"), "freq")
    seen = rules.select("antecedent", F.explode("antecedent").alias("token")).join(often, "token")
    seen = seen.groupBy("antecedent").agg(F.min_by("token", F.struct("freq", "token")).alias("rare"))
    rules = rules.join(seen, "antecedent").checkpoint()
    small = rules.select(F.col("antecedent").alias("inner"), F.col("rare").alias("token"))
    wider = rules.select("antecedent", F.explode("antecedent").alias("token")).join(small, "token")
    wider = wider.where((F.size("inner") < F.size("antecedent")) & (F.size(F.array_except("inner", "antecedent")) == 0))
    return rules.join(wider.select("antecedent").distinct(), "antecedent", "left_anti")


def match(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """(tokens, mined): the best rule contained in each distinct token set that contains one."""
    keyed = rules.select(F.col("rare").alias("token"), "antecedent", "confidence")
    met = sets.select("tokens").distinct().select("tokens", F.explode("tokens").alias("token")).join(keyed, "token")
    met = met.where(F.size(F.array_except("antecedent", "tokens")) == 0)
    order = F.struct("confidence", F.concat_ws(" ", "antecedent"))
    return met.groupBy("tokens").agg(F.concat_ws(" ", F.max_by("antecedent", order)).alias("mined"))


def judge(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str]], min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, min_lift: float = MIN_LIFT, min_pages: int = MIN_PAGES) -> DataFrame:
    """(page_id, host, path, rule, verdict, mined), one row for each page."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    kept = mine(pages, labels, min_support, min_confidence, min_lift, min_pages)
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"), tokens(F.col("url")).alias("tokens"))
    # checkpointed, so that the join can split a token set that very many pages have
    mined = match(rows, kept).checkpoint()
    rule, verdict = given_rule(F.col("host"), F.col("path"), rules)
    out = rows.join(mined, "tokens", "left")
    return out.select("page_id", "host", "path", rule.alias("rule"),
                      F.coalesce(verdict, F.when(F.col("mined").isNotNull(), "block").otherwise("allow")).alias("verdict"), "mined")
