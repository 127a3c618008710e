import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    builder = (SparkSession.builder.master("local[*]").appName("tessera-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.session.timeZone", "UTC"))
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    # tests set their own shared folder only where the cluster names none
    if not s.conf.get("spark.checkpoint.dir", None) and not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-tests-"))
    yield s


@pytest.fixture()
def table_name(spark):
    from tessera.session import unique_name
    return unique_name("t")


@pytest.fixture()
def scratch(spark):
    from tessera.session import scratch_path
    return lambda label="s": scratch_path(spark, label)
