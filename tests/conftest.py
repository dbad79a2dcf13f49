import pytest

from workload.check import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "4")
    # Hundreds of tiny plans: compiling each would take longer than running it.
    session.conf.set("spark.sql.codegen.wholeStage", "false")
    yield session
    session.stop()
