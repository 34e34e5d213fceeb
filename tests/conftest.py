import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from quillspark.session import BASE_CONF, ensure_checkpoint_dir

    builder = SparkSession.builder.master("local[4]").appName("quillspark-tests")
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "8g")
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(session)
    yield session


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="quillspark-test-")
