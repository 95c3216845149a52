import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    builder = (SparkSession.builder.master("local[*]").appName("staylens-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    # Tests only: a private shared folder when the session names none.
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="staylens-test-ckpt-"))
    yield session


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="staylens-test-")
