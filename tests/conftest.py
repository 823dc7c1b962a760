import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidewire.session import build_session

    s = build_session(app="tests", cpus=4, memory="4g", partitions=4, shared=f"file://{tmp_path_factory.mktemp('shared')}")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
