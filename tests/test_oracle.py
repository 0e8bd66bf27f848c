"""Every registered query against its SQL twin, on whole tables."""

import os

import pytest
from compare import difference, views

import __spark_entry__ as entry

SF_DIR = os.environ.get("CASEFLOW_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return views(SF_DIR)


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    frame = QUERIES[name](spark, SF_DIR)
    if name in ORACLES:
        assert difference(frame, con, ORACLES[name]) is None
    else:
        assert frame.count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
