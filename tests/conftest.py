import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)


@pytest.fixture(scope="session")
def spark():
    from laminae.session import build_session

    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    session = build_session(
        "laminae-tests",
        "local[8]",
        {
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.sql.warehouse.dir": f"{scratch}/warehouse",
            "spark.checkpoint.dir": f"{scratch}/checkpoints",
            "spark.driver.extraJavaOptions": f"-Dderby.system.home={scratch}/derby",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def run_dir():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")
