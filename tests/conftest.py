import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMALL_SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from strata.session import build_session

    warehouse = str(tmp_path_factory.mktemp("warehouse"))
    session = build_session("local[*]", shuffle_partitions=8, app_name="strata-tests",
                            extra={"spark.sql.warehouse.dir": warehouse})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small_sf():
    return SMALL_SF
