"""Queries of this package that have SQL, against the SQL engine."""

import compare
import pytest

from pulseframe.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_same_rows(spark, name):
    df = queries.QUERIES[name](spark, SF)
    assert compare.difference(df, compare.connect(SF), queries.ORACLE[name]) is None
