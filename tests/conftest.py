from __future__ import annotations

import pytest

from riskflow.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "riskflow-tests",
        spark__master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"
