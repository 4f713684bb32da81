import pytest

from millrace.session import local_session

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, **{"spark.sql.shuffle.partitions": "3"})
    yield session
    session.stop()


@pytest.fixture
def cut_small(spark):
    """Cut every key with more than 40 rows, so that tests go through the split path."""
    spark.conf.set("spark.millrace.segmentRows", "40")
    yield
    spark.conf.unset("spark.millrace.segmentRows")
