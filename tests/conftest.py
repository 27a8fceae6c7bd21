import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from leadwright.session import build_session

    session = build_session("tests", "local[8]", spark_sql_shuffle_partitions="8", spark_driver_memory="8g",
                            spark_checkpoint_dir=str(tmp_path_factory.mktemp("stages")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
