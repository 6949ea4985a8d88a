import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from cartwheel.session import SQL_SETTINGS, checkpoint_dir

    builder = (SparkSession.builder.master("local[4]").appName("cartwheel-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false")
               .config("spark.driver.memory", "4g"))
    for k, v in SQL_SETTINGS.items():
        builder = builder.config(k, v)
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cartwheel-test-ckpt-"))
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture(autouse=True, scope="module")
def nothing_stays_cached(spark):
    """A table that one module caches would replace the same plan in the next."""
    yield
    spark.catalog.clearCache()


@pytest.fixture
def tmp_out():
    return tempfile.mkdtemp(prefix="cartwheel-test-out-")
