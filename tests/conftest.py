import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from evhist.session import build_session, shared_dir

    s = build_session("local[4]", shuffle_partitions=8)
    # tests have no cluster: point the (unset) shared folder at a fresh temp dir
    shared_dir(s, tempfile.mkdtemp(prefix="evhist-tests-", dir="/tmp"))
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark, request):
    from evhist.session import scratch_path

    return scratch_path(spark, request.node.name.replace("[", "_").replace("]", ""))
