import os
import sys
from pathlib import Path

import pytest

_TESTS = Path(__file__).resolve().parent
sys.path.insert(0, str(_TESTS.parent))
# Python workers import what the tests hand to Spark.
os.environ["PYTHONPATH"] = os.pathsep.join([str(_TESTS.parent), str(_TESTS), os.environ.get("PYTHONPATH", "")])

from corpusflow.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
