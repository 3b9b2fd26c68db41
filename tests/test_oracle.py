"""Every registered query against the SQL engine on the smallest tables."""

import pytest

import __spark_entry__ as entry
import compare
from pulseframe.catalog import oracle as statements
from test_plans import QUERIES

SF = "/root/testdata/sf0.001"
# The smallest table of events is too small to tell whether late rows are taken.
LARGER = {"stream_late_data": "/root/testdata/sf0.01", "stream_late_rows": "/root/testdata/sf0.01"}


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


@pytest.fixture(scope="module")
def oracle():
    return statements.statements()


def test_every_query_has_an_oracle(oracle):
    assert set(oracle) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries())
    assert set(oracle) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, con, oracle, name):
    sf = LARGER.get(name, SF)
    df = QUERIES[name](spark, sf)
    assert compare.difference(df, con if sf == SF else compare.connect(sf), oracle[name]) is None
