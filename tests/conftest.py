from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session

    session = build_session(
        "tidemark-tests",
        master="local[*]",
        shuffle_partitions=4,
        spark__ui__enabled="false",
        spark__driver__memory="4g",
        # Tests are short: the first compiler tier alone starts them sooner.
        spark__driver__extraJavaOptions="-XX:TieredStopAtLevel=1",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf() -> str:
    return SMALL
