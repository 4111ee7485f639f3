"""Every registered query against its SQL on the smallest tables."""

from pathlib import Path

import pytest

from checks.compare import compare, database
from checks.oracles import ORACLES
from checks.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return database(FOLDER)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, connection, name):
    assert compare(spark, connection, FOLDER, name) == ""
