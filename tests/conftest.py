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
    from tiergrain.session import build_session
    extra = {}
    # tests set their own shared folder only where the session names none
    if not os.environ.get("SPARK_CHECKPOINT_DIR"):
        extra["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="tiergrain-test-")
    s = build_session("local[*]", app="tiergrain-tests", shuffle_partitions=8, extra=extra)
    yield s


@pytest.fixture(scope="session")
def duck01():
    from tiergrain.plans.check import duck_connection
    return duck_connection(SF01)
