import pytest

from tessera.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, 4, **{"spark.driver.memory": "4g", "spark.sql.adaptive.enabled": "true"})
    yield session
    session.stop()
