import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from hopgraph.session import build_session
    ckpt = str(tmp_path_factory.mktemp("checkpoints"))
    s = build_session("local[4]", 8, app_name="hopgraph-tests")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(ckpt)   # tests only: a cluster names its own
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from hopgraph.session import fresh_path
    return lambda name: fresh_path(spark, name)
