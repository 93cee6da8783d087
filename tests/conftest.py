import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from nestwork.session import ensure_checkpoint_dir

    s = (SparkSession.builder.master("local[4]").appName("nestwork-tests")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s


@pytest.fixture
def scratch(spark):
    from nestwork.session import scratch_path

    return scratch_path(spark, "test-" + uuid.uuid4().hex[:6])


SF_SMALL = "/root/testdata/sf0.001"
