import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from tallgrass.session import local_session, ship_package

    session = local_session(4, "6g", "tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    ship_package(session)
    return session
