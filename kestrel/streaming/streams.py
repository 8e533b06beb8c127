"""Structured Streaming operators (STM-*, SRC-14, SRC-16).

The reference's DStream jobs keep counters on the driver and use
processing-time windows with inverse reduce functions. Here state lives in
the state store (checkpointed in the shared folder), windows are on event
time with a watermark, and results go to file sinks or ``foreachBatch``
writers in the shared folder; nothing is collected to the driver.

Watermarks: Structured Streaming only drops state (and, in append mode,
only emits a window) once the watermark has passed it. ``delay`` is the
lateness the job tolerates; it must cover how far out of order the source
delivers events.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kestrel.session import Scope
from kestrel.sources.readers import read_if_there

# A batch interval of one second, as the reference's jobs use (STM-01).
DEFAULT_TRIGGER = "1 second"


def file_stream(spark: SparkSession, path: str, schema: str, fmt: str = "parquet",
                max_files: int | None = 1) -> DataFrame:
    """SRC-14 / SRC-16: newly arriving files of a folder as a stream."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path)


def start(df: DataFrame, checkpoint: str, *, path: str | None = None, fmt: str = "parquet",
          mode: str = "append", foreach_batch: Callable[[DataFrame, int], None] | None = None,
          available_now: bool = True, name: str | None = None) -> StreamingQuery:
    """STM-09 / STM-10: start a query with its checkpoint in the shared folder.

    ``available_now`` processes what has arrived, in micro-batches, and
    stops (tests, scheduled runs); otherwise the query runs on a 1 s trigger.
    """
    w = df.writeStream.option("checkpointLocation", checkpoint).outputMode(mode)
    if name:
        w = w.queryName(name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=DEFAULT_TRIGGER)
    if foreach_batch is not None:
        return w.foreachBatch(foreach_batch).start()
    return w.format(fmt).option("path", path).start()


def run_until_drained(q: StreamingQuery, timeout_s: int | None = None) -> None:
    """Wait for an ``availableNow`` query, without a limit unless one is given; fail loudly on error or timeout."""
    if timeout_s is None:
        q.awaitTermination()
    elif not q.awaitTermination(timeout_s):
        q.stop()
        raise TimeoutError(f"stream {q.name or q.id} did not finish in {timeout_s}s")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def event_time(ts: str) -> Column:
    """Watermarks need TIMESTAMP, not TIMESTAMP_NTZ (Q20)."""
    return F.to_timestamp(F.col(ts))


def overwrite_each_batch(path: str) -> Callable[[DataFrame, int], None]:
    """STM-03 / STM-08: complete-mode results replace the previous ones."""
    def run(batch: DataFrame, _batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(path)
    return run


def length_totals(stream: DataFrame, text: str) -> DataFrame:
    """STM-03 / AGG-16 / MTH-03 (+Q7): running message count, total length,
    integer-division average and exact average, as one global aggregate."""
    n = F.length(F.col(text))
    g = stream.groupBy().agg(F.count(F.lit(1)).alias("total_messages"), F.sum(n).cast("bigint").alias("total_chars"),
                             F.max(n).alias("max_length"))
    return g.select("total_messages", "total_chars", F.expr("total_chars div total_messages").alias("avg_length_int"),
                    (F.col("total_chars") / F.col("total_messages")).alias("avg_length"), "max_length")


def tokens(stream: DataFrame, text: str, out: str = "word") -> DataFrame:
    """ARR-01 (+Q9): blank-separated words, empty words dropped."""
    return stream.select("*", F.explode(F.split(F.col(text), " ")).alias(out)).filter(F.col(out) != "")


def tumbling_counts(stream: DataFrame, ts: Column, key: str, width: str, delay: str) -> DataFrame:
    """STM-06: count per (tumbling window, key); emitted once final."""
    s = stream.withColumn("_et", ts).withWatermark("_et", delay)
    g = s.groupBy(F.window("_et", width).alias("w"), F.col(key)).agg(F.count(F.lit(1)).alias("count"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), key, "count")


def sliding_counts(stream: DataFrame, ts: Column, key: str, width: str, slide: str, delay: str) -> DataFrame:
    """STM-05 (+Q8): count per (sliding window, key), no zero rows.

    An event lies in width/slide windows (300 at 300 s / 1 s). Counting per
    slide-sized bucket first and windowing the bucket counts keeps the state
    and the row copies proportional to buckets instead of events.
    """
    s = stream.withColumn("_et", ts).withWatermark("_et", delay)
    buckets = s.groupBy(F.window("_et", slide).alias("b"), F.col(key)).agg(F.count(F.lit(1)).alias("_n"))
    bt = buckets.select(F.window_time("b").alias("_bt"), key, "_n")
    g = bt.groupBy(F.window("_bt", width, slide).alias("w"), F.col(key)).agg(F.sum("_n").alias("count"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), key,
                    F.col("count").cast("bigint").alias("count"))


def session_windows(stream: DataFrame, key: str, ts: str, gap_seconds: int, delay: str) -> DataFrame:
    """STM-13 (+Q5): per-key sessions on whole seconds. A gap of exactly
    ``gap_seconds`` must open a new session, while ``session_window`` still
    merges at its gap, so the window gap is ``gap_seconds - 1`` seconds."""
    s = stream.withColumn("_et", F.date_trunc("second", event_time(ts))).withWatermark("_et", delay)
    g = s.groupBy(F.col(key), F.session_window("_et", f"{gap_seconds - 1} seconds").alias("s")).agg(
        F.count(F.lit(1)).alias("n_events"))
    return g.select(key, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "n_events")


def upsert_latest(state_path: str, key: str, order_cols: list[str], buckets: int = 64, run_id: str = "",
                  ) -> Callable[[DataFrame, int], None]:
    """STM-08: ``foreachBatch`` upsert of "latest row and running count per
    key" into a Parquet state table partitioned by key bucket.

    Only the buckets a batch touches are read (the others are pruned), merged
    and rewritten (dynamic partition overwrite). The merged rows are written to
    the shared folder first, because Spark cannot overwrite files it is still
    reading, and that folder is removed when the batch is in. Each bucket holds the batch id and the ``run_id`` (one per stream
    checkpoint) that wrote it last: a replayed batch skips the buckets that
    have it and writes those that a crash left out; another run starts its
    batch ids anew. Null keys are a key like any other.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = (batch.withColumn("_bucket", F.pmod(F.hash(F.col(key)), F.lit(buckets)))
                .withColumn("n_events", F.lit(1).cast("bigint")))
        with Scope(spark) as scope:
            rows = scope.persist(rows)
            # one number for each bucket: those of other keys are not read
            touched = [r["_bucket"] for r in rows.select("_bucket").distinct().collect()]
            old = read_if_there(spark, state_path)
            if old is not None:
                old = old.where(F.col("_bucket").isin(touched))
                done = [r["_bucket"] for r in old.where((F.col("_run") == run_id) & (F.col("_batch") >= batch_id)).select("_bucket").distinct().collect()]
                fresh = F.lit(True) if not done else ~F.col("_bucket").isin(done)
                old = old.where(fresh).drop("_batch", "_run")
                rows = old.unionByName(rows.where(fresh).select(*old.columns))
            cols = [c for c in rows.columns if c not in (key, "n_events")]
            best = F.max_by(F.struct(*cols), F.struct(*[F.col(c) for c in order_cols]))
            merged = rows.groupBy(key).agg(best.alias("_r"), F.sum("n_events").alias("n_events"))
            merged = merged.select(key, *[F.col("_r")[c].alias(c) for c in cols], "n_events", F.lit(batch_id).alias("_batch"), F.lit(run_id).alias("_run"))
            (scope.written(merged).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("_bucket").parquet(state_path))
    return run
