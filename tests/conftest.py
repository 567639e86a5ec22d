import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))


@pytest.fixture(scope="session")
def spark():
    from gleaner.session import local_session

    session = local_session(cpus=8, memory="8g", app="tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
