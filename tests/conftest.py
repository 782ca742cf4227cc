import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from gridscope.session import local_session

    return local_session("4", "6g")


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def table(spark):
    """Small frames from rows and a DDL schema."""
    return lambda schema, *rows: spark.createDataFrame(list(rows), schema)
