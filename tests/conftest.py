import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from nestmart.session import local_session
    s = local_session(4, shuffle_partitions=4, app="nestmart-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_SMALL


@pytest.fixture()
def scratch_db(spark):
    from nestmart.session import new_id, scratch_path
    from nestmart.sources.tables import ensure_database
    name = f"t_{new_id()}"
    ensure_database(spark, name, scratch_path(spark, "testdb"))
    return name
