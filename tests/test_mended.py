"""Log lines in one pass, input layouts, the trigger of one second, and the write mode of a sink."""

import time

import pytest
from pyspark.sql import functions as F

from kestrel.functions import scalars as S
from kestrel.operators import matching
from kestrel.sinks import writers
from kestrel.streaming import streams


def test_log_lines_equal_nine_extractions(spark):
    good = '10.0.0.1 - u1 [01/Jan/2024:00:00:00 +0000] "GET /x HTTP/1.1" 200 17 "-" "agent/1"'
    lines = [good, good.replace("10.0.0.1 ", " "), "noise " + good + " more", good + "\nsecond line", "a\nb " + good, good.replace("u1", "u\x011"), "\x01", "", None,
             "nothing like it", good.replace('"-"', '"a "b" c"'), good.replace("200", "20"), good.replace("/x", "/$1\\2"), good + " " + good]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "id long, line string")
    want = df.select("id", *[F.regexp_extract("line", S.LOG_PATTERN, i + 1).alias(n) for i, n in enumerate(S.LOG_FIELDS)], F.coalesce(F.col("line").rlike(S.LOG_PATTERN), F.lit(False)).alias("matched"))
    got = S.parse_log_line(df, "line").drop("line")
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    plan = S.parse_log_line(df, "line")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_replace") <= 2  # once in the plan, and once where a long plan names it again


def test_layouts(spark):
    ddl = "file_name string, address string, city string, state string, zip string"
    rows = [("a", "1 elm", "x", "y", ""), ("a", "2 elm", "", None, "1"), ("i", " U1 ", "", " ", None), ("i", "u2", None, None, None)]
    addresses, only_ids = matching.by_layout(spark.createDataFrame(rows, ddl))
    assert sorted(r.address for r in addresses.collect()) == ["1 elm", "2 elm"] and sorted(r.address for r in only_ids.collect()) == [" U1 ", "u2"]
    with pytest.raises(ValueError, match="bad"):
        matching.by_layout(spark.createDataFrame([*rows, ("bad", "x", "city", "", "")], ddl))
    assert matching.by_layout(spark.createDataFrame([], ddl))[0].count() == 0


def test_a_running_stream_takes_files_as_they_come(spark, tmp_path):
    """The trigger of one second, which the drained runs do not use."""
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(5).write.parquet(src)
    q = streams.start(streams.file_stream(spark, src, "id long"), str(tmp_path / "ckpt"), path=out, available_now=False)
    try:
        for n in (5, 12):
            until = time.time() + 60
            while time.time() < until:
                try:
                    if spark.read.schema("id long").parquet(out).count() == n:
                        break
                except Exception:  # noqa: BLE001 - not there yet
                    pass
                time.sleep(0.5)
            assert spark.read.schema("id long").parquet(out).count() == n
            assert q.isActive
            if n == 5:
                spark.range(7).write.mode("append").parquet(src)
    finally:
        q.stop()


def test_overwrite_does_not_follow_the_session(spark, tmp_path):
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    rows = spark.range(6).select("id", (F.col("id") % 3).alias("p"))
    try:
        for mode in ("dynamic", "static"):
            spark.conf.set(key, mode)
            for overwrite, left in (("static", {1}), ("dynamic", {0, 1, 2})):
                conf = writers.SinkConfig(str(tmp_path / f"{mode}-{overwrite}"), partition_cols=["p"], overwrite=overwrite)
                writers.write(rows, conf)
                writers.write(rows.where("p = 1"), conf)
                assert {r.p for r in spark.read.parquet(conf.path).collect()} == left
    finally:
        spark.conf.set(key, before)
