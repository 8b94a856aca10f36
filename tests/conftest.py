import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from strata.session import build_session
    wh = tempfile.mkdtemp(prefix="strata-wh-")
    s = build_session("local[4]", app="strata-tests", shuffle_partitions=8,
                      extra={"spark.sql.warehouse.dir": wh,
                             "spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture()
def tmp_root():
    return tempfile.mkdtemp(prefix="strata-test-")
