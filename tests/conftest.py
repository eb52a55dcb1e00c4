import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from palate.session import local_session  # noqa: E402

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 8, {"spark.driver.memory": "8g"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture(scope="session")
def ratings(spark, folder):
    from palate.sources import tables
    return tables.ratings(spark, folder).cache()


@pytest.fixture(scope="session")
def items(spark, folder):
    from palate.sources import tables
    return tables.items(spark, folder).cache()


@pytest.fixture
def frame(spark):
    """Build a ratings-like frame from tuples."""
    def build(rows, schema="userId int, movieId int, rating float"):
        return spark.createDataFrame(rows, schema)
    return build
