import tempfile

import pytest

from wardline.session import local_session


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="wardline-warehouse-")
    folder = tempfile.mkdtemp(prefix="wardline-intermediate-")
    extra = {"spark.sql.warehouse.dir": warehouse, "spark.checkpoint.dir": f"file://{folder}"}
    session = local_session("tests", 8, partitions=4, memory="4g", extra=extra)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"
