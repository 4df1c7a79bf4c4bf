import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wharf.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    # Tests run without a cluster: give the session its own checkpoint folder
    # (only because none is set) and its own warehouse.
    scratch = tempfile.mkdtemp(prefix="wharf-test-")
    extra = {"spark.sql.warehouse.dir": os.path.join(scratch, "warehouse")}
    s = get_session("local[4]", app_name="wharf-tests", shuffle_partitions=8, extra=extra)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(os.path.join(scratch, "checkpoints"))
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
