import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    ckpt = tempfile.mkdtemp(prefix="attrition-test-", dir="/tmp")
    s = (SparkSession.builder.master("local[4]").appName("attrition-tests")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", ckpt)
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    from attrition.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF_SMALL
