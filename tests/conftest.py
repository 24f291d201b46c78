import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from chainflow import session as S
    builder = SparkSession.builder.master("local[4]").appName("chainflow-tests")
    for k, v in S._DEFAULTS.items():
        builder = builder.config(k, v)
    spark = (builder.config("spark.sql.shuffle.partitions", "8")
             .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="cf-test-ckpt-"))
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="cf-test-")
