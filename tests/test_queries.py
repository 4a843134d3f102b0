"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

from tools.compare import differences, duck
from workload import ORACLES, QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    return duck(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    found, _ = differences(spark, db, FOLDER, name, QUERIES[name], ORACLES.get(name))
    assert not found
