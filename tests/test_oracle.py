"""Every registered query against its DuckDB oracle on the smallest fixtures
(the driver does the same at sf0.01), plus property checks."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

from kestrel.plans.registry import ORACLE, QUERIES, load_all
from kestrel.sources.tables import TABLE_NAMES, Tables

from tests.settings import SMALL

load_all()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert len(QUERIES) >= 79


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    got = _rows(df.columns, df.collect())
    res = duck.execute(ORACLE[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert got == _rows(cols, res.fetchall())


def test_generated_and_physical_rows(spark):
    t = Tables(spark, SMALL)
    assert QUERIES["gen_user_activity"](spark, SMALL).count() == t.orders.count()
    assert QUERIES["partition_row_counts"](spark, SMALL).first()[:] == (t.customer.count(), 0)



def test_rejects_plus_accepted_is_input(spark):
    from kestrel.plans import q_match
    t = Tables(spark, SMALL)
    rejects = QUERIES["dq_reject_routing"](spark, SMALL).count()
    accepted = q_match.matched(t).filter(F.col("uhid") != "-1").count()
    assert rejects + accepted == t.customer.count()


def test_session_numbers_non_decreasing(spark):
    s = QUERIES["session_assign"](spark, SMALL)
    n = s.select("user_id", "logtime", F.split("session_id", "_")[1].cast("int").alias("n"))
    from pyspark.sql import Window
    w = Window.partitionBy("user_id").orderBy("logtime")
    bad = n.withColumn("p", F.lag("n").over(w)).filter(F.col("p") > F.col("n")).count()
    assert bad == 0


def test_scd2_one_current_row_per_key(spark):
    from kestrel.operators import scd
    assert scd.current_rows_check(QUERIES["scd2_merge"](spark, SMALL)).count() == 0
