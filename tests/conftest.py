import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from servicelake.session import get_session

    s = get_session(
        "servicelake-tests",
        master="local[4]",
        shuffle_partitions=8,
        conf={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="servicelake-test-ckpt-")},
    )
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="servicelake-test-")
