import tempfile

import pytest

from marea.session import local_session


@pytest.fixture(scope="session")
def spark():
    home = tempfile.mkdtemp(prefix="marea-tests-")
    session = local_session(4, shuffle_partitions=4, memory="6g", conf={
        "spark.sql.warehouse.dir": f"{home}/warehouse", "spark.checkpoint.dir": f"{home}/shared"})
    yield session
    session.stop()
