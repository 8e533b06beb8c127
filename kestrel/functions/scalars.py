"""Column -> Column helpers (STR / DAT / MTH / ARR / HSH).

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen; none of them calls Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Money is summed exactly: doubles become decimal(18,2) before any sum, the
# sum is exact whatever the order of addition, and only the final value is
# turned back into a double.
MONEY = "decimal(18,2)"


def money(c) -> Column:
    return F.col(c).cast(MONEY) if isinstance(c, str) else c.cast(MONEY)


def money_sum(c) -> Column:
    """Exact sum of a 2-decimal money column (decimal(28,2))."""
    return F.sum(money(c))


def exact(c: Column, kind, value_type: str | None = None) -> Column:
    """A measure as a decimal, so that sums do not hang on their order.

    ``value_type`` names the decimal. Without it a decimal column keeps its
    own type, whole numbers become decimal(28,0), and floating point numbers
    decimal(28,10): 18 digits before the point, 10 after it.
    """
    if value_type is None:
        name = kind.simpleString()
        if name.startswith("decimal"):
            return c
        value_type = "decimal(28,0)" if name in ("tinyint", "smallint", "int", "bigint") else "decimal(28,10)"
    return c.cast(value_type)


def epoch_seconds(ts) -> Column:
    """Whole seconds since the epoch of a timestamp or timestamp_ntz column.

    ``unix_timestamp`` reads timestamp_ntz as wall-clock time in the session
    zone, which is UTC in every session of ours.
    """
    return F.unix_timestamp(F.col(ts) if isinstance(ts, str) else ts)


def to_ltz(ts) -> Column:
    """timestamp_ntz -> timestamp (needed by watermarks and a few functions)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.to_timestamp(c)


# STR-01: the characters removed from names (the blank is one of them).
# Fixed value, must equal the reference's literal.
CLEAN_NAME_CHARS = ", !)('"


def clean_name(c) -> Column:
    """STR-01: delete the characters of CLEAN_NAME_CHARS."""
    return F.translate(F.col(c) if isinstance(c, str) else c, CLEAN_NAME_CHARS, "")


def lower_trim(c) -> Column:
    """STR-02."""
    return F.lower(F.trim(F.col(c) if isinstance(c, str) else c))


def nth_part(c, sep: str, n: int) -> Column:
    """STR-05 / ARR-06: n-th (1-based) field of a delimited string."""
    return F.split_part(F.col(c) if isinstance(c, str) else c, F.lit(sep), F.lit(n))


def date_from_epoch_ms(c) -> Column:
    """DAT-01: epoch milliseconds -> date (UTC)."""
    return F.to_date(F.timestamp_millis(F.col(c) if isinstance(c, str) else c))


def iso_duration_minutes(c, count_days: bool = True) -> Column:
    """DAT-08 / UDF-01: ISO-8601 duration text ('PT1H30M', 'P1DT2H') -> whole minutes.

    Parsed with regexp_extract, so no Python runs. ``count_days=False``
    reproduces ``timedelta.seconds``, which drops whole days (Q19).
    """
    col = F.col(c) if isinstance(c, str) else c

    def part(pattern: str) -> Column:
        v = F.regexp_extract(col, pattern, 1)
        return F.when(v == "", F.lit(0)).otherwise(v.cast("bigint"))

    days = part(r"P(?:[^T]*?)(\d+)D")
    hours = part(r"T(?:[^H]*?)(\d+)H")
    minutes = part(r"T(?:.*?H)?(\d+)M")
    seconds = part(r"T(?:.*?[HM])?(\d+)S")
    secs = hours * 3600 + minutes * 60 + seconds
    if count_days:
        secs = secs + days * 86400
    return secs


def hash_ip(c, salt: str = "") -> Column:
    """HSH-01: one-way hash of an ip text (sha-256 hex of salt + ip)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.sha2(F.concat(F.lit(salt), col), 256)


def encrypt_id(c, key: str) -> Column:
    """HSH-02: reversible id cipher (AES-GCM), base64 text."""
    col = F.col(c) if isinstance(c, str) else c
    return F.base64(F.aes_encrypt(col.cast("string"), F.lit(key)))


def decrypt_id(c, key: str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.aes_decrypt(F.unbase64(col), F.lit(key)).cast("string")


# STR-09: combined access-log layout. Fixed values, equal to the reference's
# field list and field patterns: ip (optional dotted quad), client, user,
# [datetime] with its brackets, "request", status (3 digits), bytes,
# "referer", "agent"; fields are separated by single blanks.
LOG_FIELDS = ("ip", "client", "user", "datetime", "request", "status", "bytes", "referer", "agent")
LOG_PATTERN = (
    r'(\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})? (\S+) (\S+) (\[.+?\]) "(.*?)" (\d{3}) (\S+) "(.*?)" "(.*?)"'
)


# Stands between the fields that one replacement writes; a control character that logs do not hold.
_MARK = "\x01"


def parse_log_line(df: DataFrame, line: str) -> DataFrame:
    """STR-09: ``df`` with the nine fields of a combined-format log line, and
    ``matched``, false where the line has another form (its fields are then '').

    The pattern runs once a line: one replacement writes all fields with a mark
    between them, and a split takes them apart. A line that holds the mark itself
    is read field by field instead.
    """
    whole = rf"\A(?s:.*?){LOG_PATTERN}(?s:.*)\z"
    once = F.split(F.regexp_replace(F.col(line), whole, "".join(f"{_MARK}${i + 1}" for i in range(len(LOG_FIELDS)))), _MARK)
    slow = F.array(F.when(F.col(line).rlike(LOG_PATTERN), F.lit("")).otherwise(F.lit(None)), *[F.regexp_extract(line, LOG_PATTERN, i + 1) for i in range(len(LOG_FIELDS))])
    out = df.withColumn("_parsed", F.when(F.col(line).contains(_MARK), slow).otherwise(once))
    ok = F.coalesce((F.size("_parsed") == len(LOG_FIELDS) + 1) & F.col("_parsed")[0].isNotNull(), F.lit(False))
    out = out.withColumn("matched", ok)
    fields = [F.when(F.col("matched"), F.get("_parsed", F.lit(i + 1))).when(F.col(line).isNotNull(), F.lit("")).alias(n) for i, n in enumerate(LOG_FIELDS)]
    return out.select(*df.columns, *fields, "matched")
