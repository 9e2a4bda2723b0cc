"""One local session for all tests."""

from __future__ import annotations

import tempfile

import pytest

from tablebridge.session import build_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="tablebridge-tests-")
    session = build_session(
        "tests",
        "local[8]",
        {
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "8",
            "spark.default.parallelism": "4",
            "spark.python.sql.dataFrameDebugging.enabled": "false",
            "spark.checkpoint.dir": scratch,
            "spark.sql.warehouse.dir": f"{scratch}/warehouse",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
