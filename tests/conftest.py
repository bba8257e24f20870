from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parent), str(Path(__file__).resolve().parents[1])]

from gramledger.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = build_session(
        "gramledger-tests",
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": 8,
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(shared),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
