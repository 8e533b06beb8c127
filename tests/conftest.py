import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    scratch = tempfile.mkdtemp(prefix="kestrel-tests-")
    s = (SparkSession.builder.master("local[4]").appName("kestrel-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.checkpoint.dir", f"{scratch}/checkpoints")
         .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    from kestrel.session import apply_runtime_conf
    apply_runtime_conf(s)
    yield s
    s.stop()
