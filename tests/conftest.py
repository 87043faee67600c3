import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
os.environ["PYSPARK_PYTHON"] = sys.executable


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from causeway.session import session

    shared = tmp_path_factory.mktemp("shared")
    out = session(
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.checkpoint.dir": f"file://{shared}",
            "spark.sql.warehouse.dir": str(shared / "warehouse"), "spark.ui.showConsoleProgress": "false",
        },
    )
    out.sparkContext.setLogLevel("ERROR")
    yield out
    out.stop()


@pytest.fixture(scope="session")
def sf():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
