import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from revlens.session import BASE_CONF, ensure_checkpoint_dir
    builder = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "8")
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="revlens-test-ckpt-"))
    ensure_checkpoint_dir(s)
    yield s
    s.stop()
