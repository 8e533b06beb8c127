"""Streaming queries. Each one stages its input table as several Parquet
pieces (time-ordered ranges) in the shared folder, runs the stream with
``availableNow`` until it has drained them, and returns the sink's content.
Windowed streams run twice from one checkpoint: first over all data, then over
a "sentinel" piece with one event far in the future, which moves the watermark
past every real window so append mode emits them all. The sentinel is told by
its time, so no key of the data is filtered out.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.functions.scalars import epoch_seconds
from kestrel.operators import arrivals, retail, windows
from kestrel.plans.q_windows import DEPOSITS, LEDGER_SQL, WITHDRAWALS
from kestrel.plans.registry import query
from kestrel.session import scratch_path
from kestrel.sources.tables import Tables
from kestrel.streaming import keyed, streams

PIECES = 4
EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
CONV_SCHEMA = "conv_id bigint, turn bigint, role string, text string"
SENTINEL_TS = dt.datetime(2100, 1, 1)
SENTINEL_KIND = "__sentinel__"
# Lateness tolerated. The pieces are staged in time order and a batch is a piece,
# so every row comes after those of the batches before, whatever the period.
DELAY = "10 minutes"
# Rows that a staged file holds at least, if there are several in a piece.
FILE_ROWS = 250_000


def stage(df: DataFrame, path: str, order: str | None, pieces: int = PIECES) -> int:
    """Writes ``pieces`` ranges of ``order`` one after another (a file stream takes
    its files by modification time), each with as many files as its rows need.
    Returns the number of files in a piece: that many make a batch."""
    files = max(1, df.count() // (2 * pieces * FILE_ROWS))
    if not order:
        df.repartition(pieces * files).write.mode("overwrite").parquet(path)
        return files
    spark, apart = df.sparkSession, f"{path}-ranges"
    df.repartitionByRange(pieces * files, order).withColumn("_piece", F.floor(F.spark_partition_id() / files).cast("int")).write.mode("overwrite").partitionBy("_piece").parquet(apart)
    ranges = spark.read.schema(df.withColumn("_piece", F.lit(0)).schema).parquet(apart)
    for i in range(pieces):
        ranges.where(F.col("_piece") == i).drop("_piece").repartition(files).write.mode("append" if i else "overwrite").parquet(path)
    return files


def add_sentinel(spark: SparkSession, path: str, kind: str = SENTINEL_KIND) -> None:
    row = [(-1, SENTINEL_TS, -1, kind, 0.0, "{}")]
    spark.createDataFrame(row, EVENTS_SCHEMA).write.mode("append").parquet(path)


def _events_stream(spark, sf, name: str):
    """(the events as a stream, the folder it reads)"""
    src = scratch_path(spark, f"{name}-in")
    files = stage(Tables(spark, sf).events, src, "ts")
    return streams.file_stream(spark, src, EVENTS_SCHEMA, max_files=files), src


def _drain_to_files(df: DataFrame, spark, name: str, mode: str = "append") -> DataFrame:
    out, ckpt = scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-ckpt")
    streams.run_until_drained(streams.start(df, ckpt, path=out, mode=mode))
    return spark.read.parquet(out)


def _drain_windows(df: DataFrame, spark, name: str, src: str, begin: str, kind: str = SENTINEL_KIND) -> DataFrame:
    """All windows of a windowed stream: the data to its end, then the sentinel in a run of its own."""
    out, ckpt = scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-ckpt")
    streams.run_until_drained(streams.start(df, ckpt, path=out))
    add_sentinel(spark, src, kind)
    streams.run_until_drained(streams.start(df, ckpt, path=out))
    return spark.read.parquet(out).filter(F.col(begin) < F.lit(SENTINEL_TS - dt.timedelta(days=1)))


def _drain_foreach(df: DataFrame, spark, name: str, fn_of_path, mode: str) -> DataFrame:
    out, ckpt = scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-ckpt")
    streams.run_until_drained(streams.start(df, ckpt, mode=mode, foreach_batch=fn_of_path(out)))
    return spark.read.parquet(out)


def _ntz(c: str):
    return F.col(c).cast("timestamp_ntz").alias(c)


@query("stream_passthrough", "SELECT event_id, ts, user_id, event_type FROM events")
def stream_passthrough(spark, sf):
    """STM-02: stateless map of the stream, appended to a Parquet sink."""
    s = _events_stream(spark, sf, "passthrough")[0].select("event_id", "ts", "user_id", "event_type")
    return _drain_to_files(s, spark, "passthrough")


# Four measures of an event, as the daily files of a job have them.
MEASURES = {"value": "value", "n_props": "length(props)", "bought": "CASE WHEN event_type = 'purchase' THEN value END", "hour": "hour(ts)"}


@query("stream_file_arrival", f"""
WITH e AS (SELECT event_id, event_type, user_id, ts, CAST(ts AS DATE) AS file_day, {", ".join(f"{x} AS m_{m}" for m, x in MEASURES.items())} FROM events)
SELECT event_id, event_type, user_id, ts, file_day,
       {", ".join(f"CAST(sum(CAST(m_{m} AS DECIMAL(28,10))) OVER w AS DOUBLE) / CAST(nullif(count(m_{m}) OVER w, 0) AS DOUBLE) AS {m}_ma" for m in MEASURES)}
FROM e WINDOW w AS (PARTITION BY file_day, event_type, user_id ORDER BY ts, event_id ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)""")
def stream_file_arrival(spark, sf):
    """SRC-16 / STM-12 / PIP-14: files arrive in a folder named by the day
    (MM-dd-yyyy), two a day here; each micro-batch takes the new files, reads
    the days from their paths, computes the 3-row moving averages of four measures
    over all files that the touched days have so far, and overwrites those days'
    output partitions. So a later file of a day adds to it and does not replace it."""
    ev = Tables(spark, sf).events
    src = scratch_path(spark, "arrival-in")
    (ev.withColumn("arrival", F.date_format("ts", "MM-dd-yyyy")).repartition("arrival", F.col("event_id") % 2)
     .write.mode("overwrite").partitionBy("arrival").parquet(src))
    s = (spark.readStream.schema(EVENTS_SCHEMA).option("maxFilesPerTrigger", 16)
         .option("recursiveFileLookup", "true").parquet(src))
    day = F.regexp_extract(F.input_file_name(), r"arrival=([0-9]{2}-[0-9]{2}-[0-9]{4})", 1)
    s = s.withColumn("file_day", F.to_date(day, "MM-dd-yyyy"))

    def fn_of_path(out: str):
        def run(batch: DataFrame, _batch_id: int) -> None:
            days = batch.select(F.date_format("file_day", "MM-dd-yyyy").alias("arrival"), "file_day").distinct()
            # one row for each touched day; the folders of other days are pruned
            b = batch.sparkSession.read.parquet(src).join(F.broadcast(days), "arrival")
            b = b.select("event_id", "event_type", "user_id", "ts", "file_day", *[F.expr(x).alias(m) for m, x in MEASURES.items()])
            ma = windows.centered_moving_avg(b, ["file_day", "event_type", "user_id"], "ts", "event_id", list(MEASURES))
            (ma.hint("rebalance", "file_day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("file_day").parquet(out))
        return run

    out = _drain_foreach(s, spark, "arrival", fn_of_path, "append")
    return out.select("event_id", "event_type", "user_id", "ts", "file_day", *[f"{m}_ma" for m in MEASURES])


GATE_BEFORE, GATE_AFTER, GATE_NEED = 6, 1, 7
# Arrives after all others; until then its own day and the days that need it wait.
LATE_DAY = 12


@query("stream_gated_averages", f"""
WITH e AS (SELECT event_id, event_type, user_id, ts, CAST(ts AS DATE) AS day, CAST(floor(epoch(ts)) AS BIGINT) AS sec,
                  {", ".join(f"{x} AS m_{m}" for m, x in MEASURES.items())} FROM events),
days AS (SELECT DISTINCT day FROM e),
gate AS (SELECT a.day FROM days a JOIN days b ON b.day BETWEEN a.day - {GATE_BEFORE} AND a.day + {GATE_AFTER}
         GROUP BY a.day HAVING count(*) >= {GATE_NEED})
SELECT a.event_id, a.event_type, a.user_id, a.ts, a.day,
       {", ".join(f"CAST(sum(CAST(b.m_{m} AS DECIMAL(28,10))) AS DOUBLE) / CAST(nullif(count(b.m_{m}), 0) AS DOUBLE) AS {m}_avg" for m in MEASURES)}
FROM e a JOIN gate ON a.day = gate.day
JOIN e b ON a.event_type IS NOT DISTINCT FROM b.event_type AND a.user_id IS NOT DISTINCT FROM b.user_id
        AND b.day BETWEEN a.day - {GATE_BEFORE} AND a.day AND b.sec <= a.sec
GROUP BY ALL""")
def stream_gated_averages(spark, sf):
    """PIP-15 with AGG-18, PIP-14's partition write: day files arrive as a
    stream, one of them after all others; four running averages over the last
    week of a key, written by the day once its gate is open. Days before the
    arrived ones enter by their stored totals and are not read."""
    ev = Tables(spark, sf).events.select("event_id", "event_type", "user_id", "ts", F.to_date("ts").alias("arrival_day"), *[F.expr(x).alias(m) for m, x in MEASURES.items()])
    src, late = scratch_path(spark, "gated-in"), F.dayofmonth("arrival_day") == LATE_DAY
    staged = [ev.where(~late), ev.where(late)]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ev.drop("arrival_day").schema.fields)
    job = arrivals.Job(scratch_path(spark, "gated"), ["event_type", "user_id"], list(MEASURES), epoch_seconds("ts"), F.date_trunc("hour", F.col("ts")),
                       GATE_BEFORE, GATE_AFTER, GATE_NEED)

    def rows_of(days: list) -> DataFrame:
        all_ = spark.read.schema(f"{schema}, arrival_day date").parquet(src)
        return all_.where(F.col("arrival_day").isin(days)).withColumnRenamed("arrival_day", "day")

    def run(batch: DataFrame, _batch_id: int) -> None:
        # one row for each day that has come
        arrivals.process(spark, [r["day"] for r in batch.select("day").distinct().collect()], rows_of, job)

    name = F.regexp_extract(F.input_file_name(), r"arrival_day=([0-9]{4}-[0-9]{2}-[0-9]{2})", 1)
    ckpt = scratch_path(spark, "gated-ckpt")
    for part in staged:
        part.hint("rebalance", "arrival_day").write.mode("append").partitionBy("arrival_day").parquet(src)
        s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 16).option("recursiveFileLookup", "true").parquet(src)
        streams.run_until_drained(streams.start(s.select(name.cast("date").alias("day")), ckpt, foreach_batch=run))
    return arrivals.output(spark, job).select("event_id", "event_type", "user_id", "ts", "day", *[f"{m}_avg" for m in MEASURES])


_LENGTH_SQL = """
SELECT CAST(count(*) AS BIGINT) AS total_messages, CAST(sum(length(text)) AS BIGINT) AS total_chars,
       CAST(sum(length(text)) // count(*) AS BIGINT) AS avg_length_int,
       CAST(sum(length(text)) AS DOUBLE) / count(*) AS avg_length, max(length(text)) AS max_length
FROM conversations"""


def _length_totals(spark, sf, name: str) -> DataFrame:
    src = scratch_path(spark, f"{name}-in")
    s = streams.file_stream(spark, src, CONV_SCHEMA, max_files=stage(Tables(spark, sf).conversations, src, None))
    return _drain_foreach(streams.length_totals(s, "text"), spark, name, streams.overwrite_each_batch, "complete")


@query("stream_running_avg_length", _LENGTH_SQL)
def stream_running_avg_length(spark, sf):
    """STM-03 (+Q7): running count, total and average message length over
    all batches; the state is the engine's, not driver counters."""
    return _length_totals(spark, sf, "avg-length")


@query("stream_running_max_length", """
SELECT CAST(count(*) AS BIGINT) AS total_messages, max(length(text)) AS max_length FROM conversations""")
def stream_running_max_length(spark, sf):
    """STM-04 (+Q6): the true running maximum of message length."""
    return _length_totals(spark, sf, "max-length").select("total_messages", "max_length")


SLIDE_WIDTH, SLIDE_STEP = "5 minutes", "1 minute"


@query("stream_sliding_word_counts", """
WITH b AS (SELECT time_bucket(INTERVAL '1 minute', ts) AS bt, event_type AS word FROM events),
w AS (SELECT bt - to_minutes(i) AS window_start, word FROM b, range(5) r(i))
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, word, CAST(count(*) AS BIGINT) AS count
FROM w GROUP BY 1, 2, 3""")
def stream_sliding_word_counts(spark, sf):
    """STM-05 / STM-07 (+Q8, Q9): words (event types) counted per sliding
    window of 5 minutes every minute (the width and slide are parameters;
    the reference's 300 s / 1 s works the same way)."""
    s, src = _events_stream(spark, sf, "sliding")
    words = streams.tokens(s, "event_type")
    c = streams.sliding_counts(words, streams.event_time("ts"), "word", SLIDE_WIDTH, SLIDE_STEP, DELAY)
    out = _drain_windows(c, spark, "sliding", src, "window_start")
    return out.select(_ntz("window_start"), _ntz("window_end"), "word", "count")


TAG_WIDTH = "10 minutes"
TOP_TAGS = 10

TAG_COUNTS_SQL = """
SELECT time_bucket(INTERVAL '10 minutes', ts) AS window_start,
       time_bucket(INTERVAL '10 minutes', ts) + INTERVAL 10 MINUTE AS window_end, tag, CAST(count(*) AS BIGINT) AS count
FROM (SELECT ts, unnest(string_split('saw #' || event_type || ' by u' || CAST(user_id AS VARCHAR), ' ')) AS tag FROM events)
WHERE starts_with(tag, '#') GROUP BY 1, 2, 3"""


@query("stream_tumbling_tag_counts", TAG_COUNTS_SQL)
def stream_tumbling_tag_counts(spark, sf):
    """STM-06 / FLT-06 / STR-07: hashtags of message text counted per
    tumbling window (width is a parameter)."""
    s, src = _events_stream(spark, sf, "tags")
    msgs = s.select("ts", F.concat(F.lit("saw #"), F.col("event_type"), F.lit(" by u"),
                                   F.col("user_id").cast("string")).alias("text"))
    tags = streams.tokens(msgs, "text", "tag").filter(F.col("tag").startswith("#"))
    c = streams.tumbling_counts(tags, streams.event_time("ts"), "tag", TAG_WIDTH, DELAY)
    out = _drain_windows(c, spark, "tags", src, "window_start")
    return out.select(_ntz("window_start"), _ntz("window_end"), "tag", "count")


@query("stream_top_tags", f"""
SELECT window_start, window_end, tag, count, rank
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY window_start ORDER BY count DESC, tag) AS INTEGER) AS rank
      FROM ({TAG_COUNTS_SQL}))
WHERE rank <= {TOP_TAGS}""")
def stream_top_tags(spark, sf):
    """STM-07 / SRT-03: the most frequent hashtags of each tumbling window,
    ranked by count, ties by name (``TOP_TAGS`` of them: a top-k report). A
    stream in append mode cannot sort, so the closed windows are ranked as
    the sink holds them."""
    return retail.top_n_per_group(stream_tumbling_tag_counts(spark, sf), "window_start", "count", TOP_TAGS, "tag")


@query("stream_foreach_batch_upsert", """
SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, max(ts) AS ts,
       arg_max(event_type, (ts, event_id)) AS event_type, arg_max(value, (ts, event_id)) AS value,
       CAST(count(*) AS BIGINT) AS n_events
FROM events GROUP BY user_id""")
def stream_foreach_batch_upsert(spark, sf):
    """STM-08: per-batch upsert of the latest event and the running event
    count per user into a bucketed Parquet state table."""
    s = _events_stream(spark, sf, "upsert")[0].select("user_id", "event_id", "ts", "event_type", "value")
    out = _drain_foreach(s, spark, "upsert",
                         lambda p: streams.upsert_latest(p, "user_id", ["ts", "event_id"], run_id=p), "append")
    return out.select("user_id", "event_id", "ts", "event_type", "value", "n_events")


@query("stream_session_windows", """
WITH g AS (
  SELECT user_id, event_id, date_trunc('second', ts) AS t,
         CAST(floor(epoch(ts)) AS BIGINT) - lag(CAST(floor(epoch(ts)) AS BIGINT))
           OVER (PARTITION BY user_id ORDER BY ts, event_id) AS gap
  FROM events),
s AS (SELECT *, sum(CASE WHEN gap >= 1800 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY t, event_id) AS sid
      FROM g)
SELECT user_id, min(t) AS session_start, max(t) + INTERVAL 1799 SECOND AS session_end, CAST(count(*) AS BIGINT) AS n_events
FROM s GROUP BY user_id, sid""")
def stream_session_windows(spark, sf):
    """STM-13 / PIP-05 in streaming form: per-user sessions, a gap of 1800 s
    or more opens a new one, emitted when the watermark closes them."""
    s, src = _events_stream(spark, sf, "sessions")
    c = streams.session_windows(s, "user_id", "ts", 1800, DELAY)
    out = _drain_windows(c, spark, "sessions", src, "session_start")
    return out.select("user_id", _ntz("session_start"), _ntz("session_end"), "n_events")


@query("stream_ledger", LEDGER_SQL + """
SELECT user_id, event_id, ts, applied, balance FROM led""")
def stream_ledger(spark, sf):
    """STM-11: the ledger's refused-withdrawal rule on a stream, with one state
    for each account in RocksDB; the stream stops and starts anew before the
    sentinel, and goes on with the balances of its checkpoint."""
    s, src = _events_stream(spark, sf, "ledger")
    with keyed.rocksdb_state(spark):
        led = keyed.stream_ledger(s, "user_id", streams.event_time("ts"), "event_id", "event_type", "value", DEPOSITS, WITHDRAWALS, DELAY)
        # the sentinel must be a movement to get as far as the watermark
        out = _drain_windows(led, spark, "ledger", src, "ts", DEPOSITS[0])
    return out.select("user_id", F.col("id").alias("event_id"), _ntz("ts"), "applied", "balance")


RUN_WIDTH, RUN_SLIDE = 300, 1


@query("stream_sliding_runs", f"""
WITH b AS (SELECT event_type AS word, CAST(floor(epoch(ts)) AS BIGINT) AS sec FROM events),
change AS (SELECT word, t, sum(d) AS d FROM (
  SELECT word, sec + {RUN_SLIDE} - {RUN_WIDTH} AS t, 1 AS d FROM b UNION ALL SELECT word, sec + {RUN_SLIDE}, -1 FROM b) GROUP BY 1, 2 HAVING sum(d) <> 0),
run AS (SELECT word, t, lead(t) OVER w AS until, sum(d) OVER w AS n FROM change WINDOW w AS (PARTITION BY word ORDER BY t))
SELECT word, CAST(make_timestamp(t * 1000000) AS TIMESTAMP) AS first_start, CAST(make_timestamp((until - {RUN_SLIDE}) * 1000000) AS TIMESTAMP) AS last_start,
       CAST(n AS BIGINT) AS count
FROM run WHERE n > 0""")
def stream_sliding_runs(spark, sf):
    """STM-05 at the reference's 300 s every 1 s: word (event type) counts by
    difference, as runs of windows with one count; an event makes two changes and
    not 300 rows."""
    s, src = _events_stream(spark, sf, "runs")
    with keyed.rocksdb_state(spark):
        runs = keyed.sliding_runs(streams.tokens(s, "event_type"), streams.event_time("ts"), "word", RUN_WIDTH, RUN_SLIDE, DELAY)
        out = _drain_windows(runs, spark, "runs", src, "first_start")
    return out.select("word", _ntz("first_start"), _ntz("last_start"), "count")
