import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidewright.session import build_session

    folder = tmp_path_factory.mktemp("spark")
    session = build_session("tests", "local[4]", 4, **{"spark.ui.enabled": "false", "spark.sql.warehouse.dir": f"file:{folder}/warehouse", "spark.checkpoint.dir": f"file:{folder}/shared", "spark.driver.memory": "4g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
