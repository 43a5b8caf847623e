import tempfile

import pytest

from perilscope.session import build_session


@pytest.fixture(scope="session")
def spark():
    shared = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    session = build_session("tests", cores=8, memory="8g", settings={"spark.checkpoint.dir": f"{shared}/shared"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")
