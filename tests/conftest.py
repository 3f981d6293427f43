import pytest

from quarrystone.session import local_session, ship_package


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, 4, **{"spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"})
    session.sparkContext.setLogLevel("ERROR")
    ship_package(session)
    return session
