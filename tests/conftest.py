import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH", "")]))


@pytest.fixture(scope="session")
def spark():
    from lodestrand.plans.session import local_session

    s = local_session(4, "tests", **{"spark.sql.shuffle.partitions": "4"})
    s.sparkContext.environment["PYTHONPATH"] = os.environ["PYTHONPATH"]
    yield s
    s.stop()


@pytest.fixture(scope="session")
def data():
    return "/root/testdata/sf0.001"
