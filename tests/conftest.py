import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMALL_SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ledgerlens.session import local_session
    s = local_session(cores=4, shuffle_partitions=4, app="ledgerlens-tests", memory="4g",
                      conf={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="ledgerlens-tests-")})
    yield s
    s.stop()
