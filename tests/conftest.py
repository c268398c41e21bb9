import logging
import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lapsekit.session import build_session  # noqa: E402

SF_DIR = os.environ.get("LAPSEKIT_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": f"file://{shared}",
            "spark.sql.warehouse.dir": f"file://{shared}/warehouse",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("FATAL")
    logging.getLogger("SQLQueryContextLogger").disabled = True
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def duck(sf_dir):
    from tests.compare import connect

    return connect(sf_dir)
