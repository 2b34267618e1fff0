import pytest

from kithlink.session import local_session, ship


@pytest.fixture(scope="session")
def spark():
    session = ship(local_session(4, "tests"))
    session.conf.set("spark.sql.shuffle.partitions", "4")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
