import pytest

from mailtriage.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Tiny literal frames: frame('a string, b int', (..), (..))."""
    return lambda schema, *rows: spark.createDataFrame([tuple(r) for r in rows], schema)
