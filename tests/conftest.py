import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from colloquy.session import get_session

    s = get_session("local[4]", app="colloquy-tests", shuffle_partitions=4)
    if not (s.conf.get("spark.checkpoint.dir", None) or s.sparkContext.getCheckpointDir()):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="colloquy-test-ckpt-"))
    yield s


def msgs(*pairs):
    return [{"role": r, "content": c} for r, c in pairs]
