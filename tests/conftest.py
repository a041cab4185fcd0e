from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from questlog.session import build_session  # noqa: E402

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "questlog-tests",
        master="local[8]",
        shuffle_partitions=4,
        **{"spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return f"{TESTDATA}/sf0.001"
