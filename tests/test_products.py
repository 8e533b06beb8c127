"""Leave-one-out products against whole Python numbers."""

import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from kestrel.operators.windows import product_except_self


def check(spark, rows, kind="long"):
    """rows: (group, id, value)"""
    df = spark.createDataFrame(rows, "g string, id long, v long").withColumn("v", F.col("v").cast(kind))
    by = defaultdict(list)
    for g, i, v in rows:
        if v is not None:
            by[g].append((i, int(v)))
    want = {}
    for g, i, v in rows:
        p = math.prod(x for j, x in by[g] if j != i)
        want[i] = p if v is not None and -(2**63) <= p < 2**63 else None
    got = {r["id"]: r["product_others"] for r in product_except_self(df, "g", "v").collect()}
    assert got == want
    return got


def test_nineteen_factors_have_results(spark):
    got = check(spark, [("a", i, i) for i in range(1, 20)])
    assert got[19] == math.factorial(18) and None not in got.values()
    # 21! does not fit, but without one of its larger factors it does
    got = check(spark, [("a", i, i) for i in range(1, 22)])
    assert got[2] is None and got[21] == math.factorial(20)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_groups(spark, seed):
    rng, rows = random.Random(seed), []
    for i in range(1500):
        g = rng.choice([None, *map(str, range(150))])
        rows.append((g, i, rng.choice([None, 0, 1, -1, 2, -3, rng.randrange(-50, 50), rng.randrange(-10**9, 10**9), rng.choice([1, -1]) * rng.randrange(2**62)])))
    check(spark, rows)


def test_limits(spark):
    big = 2**63 - 1
    check(spark, [("a", 1, -(2**63)), ("a", 2, 1), ("b", 3, big), ("b", 4, big), ("c", 5, 2**31), ("c", 6, 2**32), ("c", 7, -1), ("d", 8, 2**62), ("d", 9, -2), ("d", 10, 1),
                  ("e", 11, None), ("e", 12, 5), ("f", 13, 0), ("g", 14, 0), ("g", 15, 0), ("h", 16, None)])
    hot = check(spark, [("hot", i, 2 if i % 2 else -2) for i in range(300)] + [("zero", 1000 + i, 2 if i else 0) for i in range(70)] + [("ones", 2000 + i, -1) for i in range(301)])
    assert hot[0] is None and hot[1000] is None and hot[1001] == 0 and hot[2000] == 1
    check(spark, [("x", i, 7) for i in range(5)], "decimal(5,0)")
    with pytest.raises(ValueError):
        product_except_self(spark.createDataFrame([("a", 1.5)], "g string, v double"), "g", "v")
    assert product_except_self(spark.createDataFrame([], "g string, v long"), "g", "v").count() == 0
