import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ledgerlake.session import build_session
    extra = {}
    from pyspark.sql import SparkSession
    if SparkSession.getActiveSession() is None:
        # tests only: a local shared folder when the session names none
        extra["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="ledgerlake-test-")
    s = build_session("local[4]", shuffle_partitions=8, extra=extra)
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def sf():
    return SF_SMALL
