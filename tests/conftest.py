from __future__ import annotations

import tempfile

import pytest

from millsight.session import local_session


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    session = local_session(4, **{"spark.sql.warehouse.dir": warehouse})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """frame("a int, b string", (1, "x"), ...) -> DataFrame"""

    def build(schema: str, *rows: tuple):
        return spark.createDataFrame(list(rows), schema)

    return build
