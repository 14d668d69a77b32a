import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from citystream.session import build_session
    ckpt = tempfile.mkdtemp(prefix="citystream-test-")
    s = build_session("local[*]", "citystream-tests", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": f"file://{ckpt}"})
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
