import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from lexgrid.session import build, ship

    folder = tmp_path_factory.mktemp("shared")
    session = build("4", 4, **{"spark.checkpoint.dir": f"file://{folder}", "spark.sql.warehouse.dir": f"{folder}/warehouse", "spark.driver.memory": "4g"})
    session.sparkContext.setLogLevel("ERROR")
    ship(session)
    return session


@pytest.fixture(scope="session")
def sf():
    return DATA
