"""Session settings and the shared scratch location.

Every operator in this package is a plain DataFrame transformation; the
settings below only make sure Catalyst/AQE are allowed to do their job
(adaptive re-planning, skew-join splitting, partition coalescing) and that
timestamps are compared in UTC.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# Settings every session of ours wants, whatever the cluster size.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "kestrel",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or fetch) a session with our settings.

    On a cluster leave ``master`` None so spark-submit decides; the shuffle
    partition count should then be sized from the input (AQE coalesces the
    surplus). Locally it defaults to twice the core count.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", os.environ.get("KESTREL_DRIVER_MEMORY", "16g"))
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Apply the SQL settings that may change on a live session."""
    for k, v in BASE_CONF.items():
        if k.startswith("spark.sql."):
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf on this session: keep the cluster's value
                pass


def _is_local(spark: SparkSession) -> bool:
    try:
        return spark.sparkContext.master.startswith("local")
    except Exception:
        return False


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Used for ``DataFrame.checkpoint()``, for stream checkpoints and for the
    tables our write/read-back jobs produce. If the session has none (a
    local test run) we set one under the system temp folder; on a cluster an
    unset checkpoint dir is an error, because a machine-local folder would be
    lost with its executor.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d.rstrip("/")
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir().rstrip("/")
    if not _is_local(spark):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    local = tempfile.mkdtemp(prefix="kestrel-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location below the shared folder (never reused)."""
    return f"{shared_dir(spark)}/kestrel/{name}-{uuid.uuid4().hex[:12]}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Removes a folder of ours through Spark's file system, whichever that is; nothing if it is not there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


class Scope:
    """PRT-05: frames kept for a while, and given back together.

        with Scope(spark) as scope:
            rows = scope.persist(frame)        # kept by the executors, recomputed if one is lost
            cut = scope.written(other)         # written below ``scope.folder`` in the shared folder, lineage cut
            ...

    On leaving, also by an error, every frame is unpersisted and the folder
    removed with all that lies in it. Results must be written elsewhere before.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.frames = spark, []
        self.folder = scratch_path(spark, "scope")

    def persist(self, df: DataFrame) -> DataFrame:
        self.frames.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return self.frames[-1]

    def written(self, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/{len(self.frames)}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> Scope:
        return self

    def __exit__(self, *_error) -> None:
        for df in self.frames:
            df.unpersist()
        self.frames.clear()
        remove_folder(self.spark, self.folder)
