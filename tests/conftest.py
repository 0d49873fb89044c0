import os
import tempfile
import time

import pytest

os.environ["TZ"] = "Asia/Kolkata"  # results must not depend on the driver's zone
time.tzset()

from tidemark.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        **{
            "spark.master": "local[8]",
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tidemark-tests-"),
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="tidemark-warehouse-"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    """Makes paths of new folders."""
    return lambda name: str(tmp_path / name)
