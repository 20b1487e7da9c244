import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from counterfoil.session import build_session

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        master="local[4]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="session")
def medium():
    return f"{TESTDATA}/sf0.01"
