import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from sievemark.session import local_session

    folder = tmp_path_factory.mktemp("spark")
    session = local_session(
        "tests",
        spark__sql__shuffle__partitions="4",
        spark__checkpoint__dir=f"{folder}/checkpoints",
        spark__sql__warehouse__dir=f"{folder}/warehouse",
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def refs(spark):
    from sievemark.sources.catalog import sample_catalog

    return sample_catalog(spark, SMALL)


@pytest.fixture(scope="session")
def con():
    from oracle.compare import connect
    from sievemark.sources.sample_views import BASE_TABLES

    return connect(SMALL, BASE_TABLES)


def rows(df):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
