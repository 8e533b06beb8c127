"""The stored dimension: equal to the plain merge, writes no more than it must, and survives a crash before it publishes."""

import datetime as dt
import os
import random

import pytest

from kestrel.operators import dimension as D
from kestrel.operators import scd

DIM = "customerId long, address string, current boolean, effectiveDate date, endDate date, note string"
UPD = "customerId long, address string, effectiveDate date"
DAY = dt.date(2024, 1, 1)


def tables(spark, seed, keys=60):
    rng, rows = random.Random(seed), []
    for k in range(keys):
        if rng.random() < 0.5:
            rows.append((k, "old", False, DAY, DAY, "x"))
        if rng.random() < 0.7:
            rows.append((k, rng.choice(["a", "b", None]), True, DAY, None, "y"))
    rows.append((None, "nobody", True, DAY, None, None))
    sent = [(k, rng.choice(["a", "b", "c", None]), dt.date(2025, 1, 1 + seed)) for k in rng.sample(range(keys + 20), 30)] + [(None, "n", DAY)]
    return spark.createDataFrame(rows, DIM), spark.createDataFrame(sent, UPD)


def bag(df):
    return sorted(map(str, df.collect()))


def files(base):
    return {os.path.join(d, f) for d, _, names in os.walk(os.path.join(base, "data")) for f in names if f.startswith("part-")}


@pytest.mark.parametrize("seed, null_safe", [(1, False), (2, True), (3, False)])
def test_equals_the_plain_merge_over_several_versions(spark, tmp_path, seed, null_safe):
    base = str(tmp_path / "d")
    dim, _ = tables(spark, seed)
    D.create(dim, base, buckets=5)
    for i in range(3):
        _, upd = tables(spark, seed + 10 + i)
        want = bag(scd.scd2_merge(D.read(spark, base), upd, null_safe=null_safe))
        assert D.merge(spark, base, upd, null_safe=null_safe) == i + 1
        assert bag(D.read(spark, base)) == want
        assert all(r["current"] for r in D.read(spark, base, current=True).collect())
        assert not any(r["current"] for r in D.read(spark, base, current=False).collect())
    assert bag(D.read(spark, base, D.latest(spark, base, 0))) == bag(dim)  # old versions stay readable


def test_only_touched_buckets_of_current_rows_are_written(spark, tmp_path):
    base = str(tmp_path / "d")
    rows = [(k, "a", True, DAY, None, None) for k in range(200)] + [(k, "z", False, DAY, DAY, None) for k in range(200)]
    D.create(spark.createDataFrame(rows, DIM), base, buckets=16)
    v0, before = D.latest(spark, base), files(base)
    # one change, one that is none, one unknown value: only the first counts
    D.merge(spark, base, spark.createDataFrame([(7, "b", DAY), (8, "a", DAY), (9, None, DAY)], UPD))
    v1 = D.latest(spark, base)
    new = files(base) - before
    assert before <= files(base) and len(v0.folders - v1.folders) == 1 and len(v1.folders - v0.folders) == 2
    assert sorted(f.split("_cur=")[1].split("/")[0] for f in new) == ["false", "true"]
    assert {f.split("_bucket=")[1].split("/")[0] for f in new} == {str(b) for cur, b, _ in v0.folders - v1.folders}
    assert D.read(spark, base).count() == 401 and D.read(spark, base, current=True).count() == 200
    # nothing to change: no version, no files
    assert D.merge(spark, base, spark.createDataFrame([(7, "b", DAY)], UPD)) == 1 and files(base) == before | new
    assert D.merge(spark, base, spark.createDataFrame([], UPD)) == 1


def test_a_crash_before_the_swap_leaves_the_old_version(spark, tmp_path):
    base = str(tmp_path / "d")
    dim, upd = tables(spark, 4)
    D.create(dim, base, buckets=4)
    v, folders = D.stage_merge(spark, base, upd)
    assert bag(D.read(spark, base)) == bag(dim) and D.latest(spark, base).number == 0
    want = bag(scd.scd2_merge(dim, upd))
    assert D.merge(spark, base, upd) == 1 and bag(D.read(spark, base)) == want
    with pytest.raises(Exception, match="(?i)exist"):  # the one that comes late finds its version taken
        D.publish(spark, base, v.number + 1, v.buckets, v.schema, folders)
    assert bag(D.read(spark, base)) == want


def test_read_back_in_order_and_empty_tables(spark, tmp_path):
    base = str(tmp_path / "d")
    dim, upd = tables(spark, 5)
    D.create(dim, base, buckets=4)
    D.merge(spark, base, upd)
    rows = [(r["customerId"] is not None, r["customerId"] or 0, r["effectiveDate"]) for r in D.ordered(D.read(spark, base)).collect()]
    assert rows == sorted(rows)
    none = str(tmp_path / "e")
    D.create(dim.limit(0), none)
    assert D.read(spark, none).count() == 0
    assert D.merge(spark, none, upd) == 1 and bag(D.read(spark, none)) == bag(scd.scd2_merge(dim.limit(0), upd))
    with pytest.raises(ValueError):
        D.latest(spark, str(tmp_path / "nothing"))
