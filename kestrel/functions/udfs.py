"""The few Python functions the library registers (UDF-01, UDF-06).

They are Arrow-batched pandas UDFs: one call per batch of rows, string
parsing done by pandas' vectorised ``str.extract``. The column-expression
twin of the same parser is ``kestrel.functions.scalars.iso_duration_minutes``,
which is what the library's own jobs use.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import LongType

_ISO = r"^P(?:(?P<d>\d+)D)?(?:T(?:(?P<h>\d+)H)?(?:(?P<m>\d+)M)?(?:(?P<s>\d+)S)?)?$"


def _seconds(s: pd.Series) -> pd.Series:
    parts = s.str.extract(_ISO).fillna("0").astype("int64")
    return parts["d"] * 86400 + parts["h"] * 3600 + parts["m"] * 60 + parts["s"]


def cook_minutes(cook: pd.Series, prep: pd.Series) -> pd.Series:
    """(cook + prep) ISO-8601 durations in whole minutes."""
    return (_seconds(cook) + _seconds(prep)) // 60


def register_cook_minutes(spark: SparkSession, name: str = "total_cook_minutes"):
    """Register the pandas UDF for SQL (explicit bigint result, UDF-06).

    The UDF object is built here, not at import time, because executors
    import this module without a session."""
    udf = pandas_udf(cook_minutes, LongType())
    spark.udf.register(name, udf)
    return udf
