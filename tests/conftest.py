import functools
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from wordloom.session import build_session

    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="6g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session", autouse=True)
def shared_inputs():
    """Build each staged hand-off once for all tests."""
    from wordloom.plans import inputs

    for name in ("dataset", "candidates", "dictionary", "encoded", "prepared", "rule_predictions"):
        setattr(inputs, name, functools.cache(getattr(inputs, name)))


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def duck():
    from check import connect

    return connect(SF)
