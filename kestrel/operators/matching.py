"""Address standardisation, identity matching, reject routing and surrogate
keys (UDF-04, JON-05, HSH-02, PIP-07 .. PIP-10).

Every step is a keyed join or a map-side combined aggregate. Lookup tables
are joined as they are; Spark (with AQE) decides per join whether a side is
small enough to broadcast, from its real size at run time, so nothing here
broadcasts a table whose size grows with the data.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator, Sequence
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from kestrel.operators.windows import join_back, latest_per_key
from kestrel.session import shared_dir
from kestrel.sources.readers import read_if_there

INPUT_FIELDS = ("input_street", "input_secondary", "input_zip", "input_city", "input_state")
STD_FIELDS = ("std_delivery_line_1", "std_delivery_line_2", "std_zipcode", "std_city", "std_state")
MASTER_FIELDS = ("standard_delivery_line_1", "standard_delivery_line_2", "standard_zipcode",
                 "standard_city", "standard_state")

# Offline rule set of the default standardiser (our own; the reference calls a
# remote address service). Street-type word at the end of the
# first delivery line -> its long form.
STREET_SUFFIXES = (("ST", "STREET"), ("AVE", "AVENUE"), ("RD", "ROAD"), ("BLVD", "BOULEVARD"),
                   ("DR", "DRIVE"), ("LN", "LANE"))
ZIP_PATTERN = "^[0-9]{5}$"

#: Rows that the batch standardiser hands back at a time.
ROWS_BACK = 10_000

REASON_NON_STANDARDIZED = "NON_STANDARDIZED_ADDRESS"
REASON_NON_MATCHED = "NON_MATCHED_ADDRESS"
REASON_PARTIAL = "PARTIAL"
REASON_STANDARDIZER_ERROR = "STANDARDIZER_ERROR"


def prepare_input(df: DataFrame, address: str, city: str, state: str, zipcode: str) -> DataFrame:
    """The standardiser's input fields: ``lower(trim(x))``, null -> ''
    (STR-02, CND-04). Other columns of ``df`` are kept."""
    def norm(c: str) -> Column:
        return F.coalesce(F.lower(F.trim(F.col(c))), F.lit(""))
    return df.select(*[c for c in df.columns if c not in (address, city, state, zipcode)],
                     F.lower(F.trim(F.col(address))).alias("input_street"), F.lit("").alias("input_secondary"),
                     norm(zipcode).alias("input_zip"), norm(city).alias("input_city"),
                     norm(state).alias("input_state"))


def _nullif_empty(c: Column) -> Column:
    return F.when(c != "", c)


def standardize_columns(df: DataFrame) -> DataFrame:
    """UDF-04, default rule set as column expressions (JVM side, codegen):
    collapse blanks, upper case, long street type; a 5-digit zip; an empty
    street means "no candidate" and nulls every standard field."""
    street = F.upper(F.regexp_replace(F.trim(F.col("input_street")), r"\s+", " "))
    for short, long in STREET_SUFFIXES:
        street = F.regexp_replace(street, f" {short}$", f" {long}")
    has = F.coalesce(F.trim(F.col("input_street")), F.lit("")) != ""
    std = {
        "std_delivery_line_1": _nullif_empty(street),
        "std_delivery_line_2": _nullif_empty(F.upper(F.trim(F.col("input_secondary")))),
        "std_zipcode": F.when(F.trim(F.col("input_zip")).rlike(ZIP_PATTERN), F.trim(F.col("input_zip"))),
        "std_city": _nullif_empty(F.upper(F.trim(F.col("input_city")))),
        "std_state": _nullif_empty(F.upper(F.trim(F.col("input_state")))),
    }
    return df.select("*", *[F.when(has, e).alias(k) for k, e in std.items()],
                     F.lit(None).cast("string").alias("std_error"))


_LONG_FORM = dict(STREET_SUFFIXES)
_BLANKS = re.compile(r"\s+")
_ZIP = re.compile(ZIP_PATTERN[1:-1])


def rules_standardizer(batch: pd.DataFrame) -> pd.DataFrame:
    """The same rule set for one batch of input fields (pandas), usable as
    the ``standardizer`` of :func:`standardize_batches`. A call is too short for
    pandas' string methods, so it works on plain strings."""
    out = []
    for street, *rest in zip(*(batch[c].tolist() for c in INPUT_FIELDS), strict=True):
        line1 = _text(street)
        if not line1:
            out.append((None,) * len(STD_FIELDS))
            continue
        line1 = _BLANKS.sub(" ", line1).upper()
        head, blank, last = line1.rpartition(" ")
        line1 = f"{head} {_LONG_FORM.get(last, last)}" if blank else line1
        line2, zipcode, city, state = map(_text, rest)
        out.append((line1, line2.upper() or None, zipcode if _ZIP.fullmatch(zipcode) else None, city.upper() or None, state.upper() or None))
    return pd.DataFrame(out, columns=list(STD_FIELDS), dtype=object)


def _text(x) -> str:
    return x.strip(" ") if isinstance(x, str) else ""


def _calls(batches: Iterator[pd.DataFrame], size: int) -> Iterator[pd.DataFrame]:
    """The rows of a partition in frames of ``size``, whatever its Arrow batches are; the last one may be shorter."""
    held: list[pd.DataFrame] = []
    n = 0
    for pdf in batches:
        held.append(pdf)
        n += len(pdf)
        if n >= size:
            rows = pd.concat(held, ignore_index=True)
            whole = n - n % size
            for lo in range(0, whole, size):
                yield rows.iloc[lo:lo + size].reset_index(drop=True)
            held, n = [rows.iloc[whole:]], n - whole
    if n:
        yield pd.concat(held, ignore_index=True)


def _replies(standardizer: Callable[[pd.DataFrame], pd.DataFrame], rows: pd.DataFrame) -> pd.DataFrame:
    """One call: the standard fields and ``std_error`` for each row."""
    try:
        res = standardizer(rows[list(INPUT_FIELDS)])
        if len(res) != len(rows):
            raise ValueError(f"{len(res)} replies to {len(rows)} addresses")
        res = res[list(STD_FIELDS)].reset_index(drop=True).astype(object)
        res["std_error"] = None
    except Exception:  # noqa: BLE001 - any failure of the service call
        res = pd.DataFrame({c: [None] * len(rows) for c in STD_FIELDS})
        res["std_error"] = REASON_STANDARDIZER_ERROR
    return res


def standardize_batches(df: DataFrame, standardizer: Callable[[pd.DataFrame], pd.DataFrame] = rules_standardizer,
                        batch_size: int = 100) -> DataFrame:
    """UDF-04 with a pluggable batch standardiser (e.g. a client of an
    address service that takes ``batch_size`` addresses per call).

    Rows are dealt out first, as a table of few files would be read by few tasks;
    AQE leaves a small table in one. ``mapInPandas`` streams each partition and
    cuts it into calls of ``batch_size`` rows across its Arrow batches, so only a
    partition's last call is not full; rows go back with the replies of many calls at
    a time. A call that raises or answers with another number of rows marks its rows
    with ``std_error`` (they become rejects, Q30) instead of losing them.
    """
    fields = list(df.schema.fields) + [StructField(c, StringType()) for c in STD_FIELDS] + \
        [StructField("std_error", StringType())]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        calls = ((rows, _replies(standardizer, rows)) for rows in _calls(batches, batch_size))
        while some := list(islice(calls, max(1, ROWS_BACK // batch_size))):
            rows, replies = (pd.concat(x, ignore_index=True) for x in zip(*some, strict=True))
            yield pd.concat([rows, replies.where(replies.notna(), None)], axis=1)

    return df.hint("rebalance").mapInPandas(run, StructType(fields))


def standardize_lookup(df: DataFrame, store: str, standardizer: Callable[[pd.DataFrame], pd.DataFrame] = rules_standardizer,
                       batch_size: int = 100) -> DataFrame:
    """UDF-04 as a lookup that fills itself: ``standardize_batches`` with the replies kept in the Parquet table ``store``.

    An address is the five input fields, as ``prepare_input`` normalises them
    (null is ''). Only addresses that the store does not know are sent, each of
    them once, in full calls; the replies are written first and then added to the
    store, so nothing below asks the service again. Failed calls are not kept:
    their rows carry ``std_error``, and the next run sends them anew. All rows of an
    address take its one reply by an equi join, so a frequent address costs one
    row on the reply side and Spark splits it on the other.
    """
    spark = df.sparkSession
    key = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in INPUT_FIELDS]
    asked = df.select(*key).distinct()
    reply = ", ".join(f"{c} string" for c in (*INPUT_FIELDS, *STD_FIELDS))
    known = read_if_there(spark, store, reply)
    unknown = asked if known is None else asked.join(known, list(INPUT_FIELDS), "left_anti")
    sent = f"{shared_dir(spark)}/kestrel/replies-{uuid.uuid4().hex[:12]}"
    standardize_batches(unknown, standardizer, batch_size).write.parquet(sent)
    fresh = spark.read.schema(f"{reply}, std_error string").parquet(sent)
    fresh.where("std_error is null").drop("std_error").write.mode("append").parquet(store)
    # two runs at a time can both have added an address
    have = spark.read.schema(reply).parquet(store).join(asked, list(INPUT_FIELDS), "left_semi").dropDuplicates(list(INPUT_FIELDS))
    have = have.withColumn("std_error", F.lit(None).cast("string"))
    failed = fresh.where("std_error is not null").join(have, list(INPUT_FIELDS), "left_anti")
    lookup = have.unionByName(failed).select(*[F.col(c).alias(f"_k_{c}") for c in INPUT_FIELDS], *STD_FIELDS, "std_error")
    cond = F.lit(True)
    for c in INPUT_FIELDS:
        cond = cond & (F.coalesce(F.col(c), F.lit("")) == F.col(f"_k_{c}"))
    return df.join(lookup, cond, "left").drop(*[f"_k_{c}" for c in INPUT_FIELDS])


#: The columns that an address file fills and an id file leaves empty (PIP-09).
LAYOUT_COLUMNS = ("city", "state", "zip")


def by_layout(df: DataFrame, file: str = "file_name", columns: Sequence[str] = LAYOUT_COLUMNS) -> tuple[DataFrame, DataFrame]:
    """PIP-09: (rows of address files, rows of id files), told by the columns that a
    file fills: all of ``columns``, or none, when ``address`` holds an id. A file with
    some of them filled stops the job, and its name is in the error.

    One small table, a row for each file, decides; rows meet it by an equi join.
    """
    filled = sum(F.max((F.length(F.trim(F.coalesce(F.col(c), F.lit("")))) > 0).cast("int")) for c in columns)
    layout = df.groupBy(file).agg(filled.alias("_filled"))
    odd = layout.where(~F.col("_filled").isin(0, len(columns))).orderBy(file).limit(10).collect()
    if odd:
        raise ValueError(f"invalid number of fields in {[r[file] for r in odd]}")
    rows = join_back(df, layout, [file])
    return rows.where(F.col("_filled") > 0).drop("_filled"), rows.where(F.col("_filled") == 0).drop("_filled")


def route_rejects(std: DataFrame) -> DataFrame:
    """PIP-08 (+Q14, Q30): one pass that gives every standardised row a
    reason or none. All four key standard fields present -> valid (null
    reason); all four absent -> NON_STANDARDIZED_ADDRESS; some -> PARTIAL;
    a failed standardiser call -> STANDARDIZER_ERROR."""
    key = ["std_delivery_line_1", "std_zipcode", "std_city", "std_state"]
    all_null = F.lit(True)
    any_null = F.lit(False)
    for c in key:
        all_null = all_null & F.col(c).isNull()
        any_null = any_null | F.col(c).isNull()
    reason = (F.when(F.col("std_error").isNotNull(), F.col("std_error"))
              .when(all_null, F.lit(REASON_NON_STANDARDIZED))
              .when(any_null, F.lit(REASON_PARTIAL)))
    return std.withColumn("reason", reason)


def address_key(cols: Sequence[str]) -> list[Column]:
    """JON-05: ``COALESCE(trim(x), '')`` per field, as plain key columns so
    the join stays an equi join (hash / sort-merge), not a nested loop."""
    return [F.coalesce(F.trim(F.col(c)), F.lit("")).alias(f"_k{i}") for i, c in enumerate(cols)]


def match_addresses(valid: DataFrame, master: DataFrame, decrypt: Callable[[Column], Column]) -> DataFrame:
    """JON-05 + HSH-02: left join standardised rows to the address master on
    the five normalised fields; ``uhid`` = decrypted id, '-1' when unmatched."""
    a = valid.select("*", *address_key(STD_FIELDS))
    b = master.select(*address_key(MASTER_FIELDS), "enc_uhid")
    keys = [f"_k{i}" for i in range(5)]
    j = a.join(b, keys, "left")
    return j.withColumn("uhid", F.coalesce(decrypt(F.col("enc_uhid")), F.lit("-1"))).drop(*keys, "enc_uhid")


def identity_chain(uhids: DataFrame, nu_map: DataFrame, inward: DataFrame, ap_map: DataFrame,
                   isp_map: DataFrame) -> DataFrame:
    """PIP-07: id -> partner id (default 0) -> active partner id (0) ->
    customer id (0) -> latest IP of that customer id (0).

    ``uhids`` holds the distinct ids with their context columns. The latest
    IP per customer id is a ``max_by`` aggregate (one row per key, combined
    map-side) before it is joined, so a customer id with a huge history
    costs one row in the join. Misses become '0' at the end only: until then
    they have no key, match nothing, and are spread over the tasks by their
    own id (:func:`_left_by_key`).
    """
    a = uhids.join(nu_map.select("uhid", "nu_uhid"), "uhid", "left")
    active = inward.filter(F.col("dsp_flag") == "Y").select(F.col("custid")).distinct()
    b = _left_by_key(a, "nu_uhid", active, "custid").withColumn("nu_uhid", F.col("custid")).drop("custid")
    c = b.join(ap_map.select("uhid", "cuhid"), "uhid", "left")
    latest = latest_per_key(isp_map, "cuhid", ["dtm_last_modified", "ip_addr"], ["ip_addr"])
    d = _left_by_key(c, "cuhid", latest.withColumnRenamed("cuhid", "_known"), "_known").drop("_known")
    for name in ("nu_uhid", "cuhid", "ip_addr"):
        d = d.withColumn(name, F.coalesce(F.col(name), F.lit("0")))
    return d


def _left_by_key(left: DataFrame, key: str, right: DataFrame, right_key: str) -> DataFrame:
    """Left join whose keyless rows meet in no one task: in place of the null
    key they carry a text made of their id, and the condition lets no row
    without a key match."""
    placed = left.withColumn("_at", F.coalesce(F.col(key), F.concat_ws("", F.lit("\u0000"), F.col("uhid"))))
    return placed.join(right, (placed["_at"] == right[right_key]) & placed[key].isNotNull(), "left").drop("_at")


def assign_surrogate_keys(incoming: DataFrame, key_table: DataFrame, keys: Sequence[str],
                          id_col: str = "segment_id") -> DataFrame:
    """PIP-10 for many keys at once: a key already in ``key_table`` keeps its
    id; new keys get max(id) + 1, + 2, ... in key order (first id 1).

    The new keys are numbered without a single-partition window: they are
    range-partitioned and sorted by key, numbered inside each partition,
    and shifted by the row counts of the partitions before them (a table
    with one row per partition).
    """
    keys = list(keys)
    inc = incoming.select(*keys).distinct()
    known = inc.join(key_table.select(*keys, id_col), keys, "inner").withColumn("is_new", F.lit(False))
    new = inc.join(key_table.select(*keys), keys, "left_anti")
    top = key_table.select(F.coalesce(F.max(id_col), F.lit(0)).cast("bigint")).scalar()  # scalar subquery
    numbered = dense_number(new, keys, "_n")
    fresh = numbered.select(*keys, (top + F.col("_n")).alias(id_col), F.lit(True).alias("is_new"))
    return known.select(*keys, F.col(id_col).cast("bigint").alias(id_col), "is_new").unionByName(fresh)


def dense_number(df: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """Number the (distinct) rows of ``df`` 1..n in key order, in parallel.

    The range-partitioned, numbered rows are checkpointed to the shared
    checkpoint folder before they are counted: both uses then read the
    same rows, even if a lost executor makes Spark recompute a stage with
    other range bounds.
    """
    keys = list(keys)
    shared_dir(df.sparkSession)
    r = (df.repartitionByRange(*keys).sortWithinPartitions(*keys)
         .withColumn("_p", F.spark_partition_id())
         .withColumn("_i", F.monotonically_increasing_id()))
    r = r.withColumn("_local", F.col("_i") - F.shiftleft(F.col("_p").cast("bigint"), 33)).checkpoint(eager=True)
    counts = r.groupBy("_p").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_p", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"))
    # ``offsets`` has one row per partition of ``r``: bounded by the partition count.
    return (r.join(F.broadcast(offsets), "_p")
            .withColumn(out, (F.col("_off") + F.col("_local") + 1).cast("bigint"))
            .drop("_p", "_i", "_local", "_off"))
