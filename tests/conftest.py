import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from funnelforge.session import build_session
    ckpt = tempfile.mkdtemp(prefix="ff-test-ckpt-")
    s = build_session("local[4]", app_name="funnelforge-tests", shuffle_partitions=4,
                      extra={"spark.driver.memory": "6g", "spark.checkpoint.dir": ckpt})
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture
def raw_events(spark):
    def make(docs):
        return spark.createDataFrame([(d,) for d in docs], "raw_json string").selectExpr(
            "raw_json", "TIMESTAMP_NTZ'2026-01-01 00:00:00' AS _loaded_at")
    return make
