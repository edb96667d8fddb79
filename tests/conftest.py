import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tallysheet.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = os.environ.get("TALLYSHEET_TEST_SF", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    # Tests run without a cluster-provided checkpoint folder: use a private one.
    os.environ.setdefault("TALLYSHEET_DRIVER_MEMORY", "4g")
    session = build_session("local[4]", shuffle_partitions=8, app="tallysheet-tests")
    yield session
    session.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="tallysheet-test-")
