"""Every registered query against its SQL counterpart."""

import pytest

from tests.compare import connect, difference
from workloads.oracles import ORACLES
from workloads.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


def test_each_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_sql(spark, db, name):
    assert difference(QUERIES[name](spark, SF_DIR), db, ORACLES[name]) is None
