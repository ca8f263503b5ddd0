import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from landroll.session import build_session
    s = build_session("local[*]", 8, app_name="landroll-tests",
                      extra={"spark.driver.memory": "4g", "spark.sql.shuffle.partitions": "8"})
    yield s
    s.stop()


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="landroll-test-")
