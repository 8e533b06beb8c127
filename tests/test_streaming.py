"""Streams: the drained result equals the batch result, also across a restart
from the checkpoint with new files arriving in between."""

import uuid

from pyspark.sql import functions as F

from kestrel.session import scratch_path
from kestrel.sources.tables import Tables
from kestrel.streaming import streams

from tests.settings import SMALL

SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def test_restart_from_checkpoint_keeps_running_totals(spark):
    ev = Tables(spark, SMALL).events
    src = scratch_path(spark, "restart-in")
    first, second = ev.filter(F.col("event_id") % 2 == 0), ev.filter(F.col("event_id") % 2 == 1)
    first.repartition(2).write.parquet(src)
    out, ckpt = scratch_path(spark, "restart-out"), scratch_path(spark, "restart-ckpt")

    def run():
        s = streams.file_stream(spark, src, SCHEMA)
        agg = s.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("v"))
        q = streams.start(agg, ckpt, mode="complete", foreach_batch=streams.overwrite_each_batch(out),
                          name=f"restart_{uuid.uuid4().hex[:6]}")
        streams.run_until_drained(q)
        return {r.event_type: r.n for r in spark.read.parquet(out).collect()}

    half = run()
    assert sum(half.values()) == first.count()
    second.repartition(2).write.mode("append").parquet(src)
    full = run()
    want = {r.event_type: r[1] for r in ev.groupBy("event_type").count().collect()}
    assert full == want


def test_upsert_replay_is_skipped(spark):
    ev = Tables(spark, SMALL).events.select("user_id", "event_id", "ts", "event_type", "value")
    state = scratch_path(spark, "upsert-state")
    fn = streams.upsert_latest(state, "user_id", ["ts", "event_id"], buckets=8)
    fn(ev, 0)
    fn(ev, 0)  # replay of batch 0: no double counting
    total = spark.read.parquet(state).agg(F.sum("n_events")).first()[0]
    assert total == ev.count()


def test_sessions_keep_null_and_negative_users(spark, tmp_path):
    from kestrel.plans.registry import QUERIES, load_all

    load_all()
    rows = "SELECT * FROM VALUES (1L, timestamp_ntz'2024-01-01 00:00:00', -1L, 'a', 1.0D, '{}'), " \
           "(2L, timestamp_ntz'2024-01-01 00:00:10', CAST(NULL AS BIGINT), 'b', 1.0D, '{}'), " \
           "(3L, timestamp_ntz'2024-01-01 02:00:00', -1L, 'a', 1.0D, '{}') AS t(event_id, ts, user_id, event_type, value, props)"
    spark.sql(rows).write.parquet(str(tmp_path / "events.parquet"))
    got = [(r.user_id, r.n_events) for r in QUERIES["stream_session_windows"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == [(-1, 1), (-1, 1), (None, 1)]


def test_windows_of_several_months_are_whole(spark, tmp_path):
    from kestrel.plans.registry import QUERIES, load_all

    load_all()
    # 240 days; the early rows are long, so their range would be written last by parallel tasks
    ev = spark.range(2_400).select(
        F.col("id").alias("event_id"), F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, id * 144 div 60, id * 144 % 60)").alias("ts"),
        (F.col("id") % 7).alias("user_id"), F.lit("a").alias("event_type"), F.lit(1.0).alias("value"),
        F.when(F.col("id") < 600, F.expr("array_join(transform(sequence(1, 1500), i -> sha2(cast(id * 1500 + i as string), 256)), '')")).otherwise("{}").alias("props"))
    ev.write.parquet(str(tmp_path / "events.parquet"))
    for name in ("stream_tumbling_tag_counts", "stream_session_windows"):
        n = "count" if "tag" in name else "n_events"
        assert QUERIES[name](spark, str(tmp_path)).agg(F.sum(n)).first()[0] == 2_400
