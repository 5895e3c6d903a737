import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

# Oracle tests run on this scale factor (the driver checks sf0.01 itself).
SF_DIR = os.environ.get("POSTFLOW_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from postflow.session import drop_scratch, local_session
    session = local_session(8, app="postflow-tests", shuffle_partitions=8)
    yield session
    drop_scratch(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture()
def tmp_base(tmp_path):
    """A fresh folder per test (tests are local; the library itself uses the shared work dir)."""
    return str(tmp_path)
