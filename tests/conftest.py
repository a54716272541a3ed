import pytest

from ledgerlake.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, "tests", "6g")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set SQL settings for one test."""
    before = {}

    def put(**settings):
        for name, value in settings.items():
            key = "spark.sql." + name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield put
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)
