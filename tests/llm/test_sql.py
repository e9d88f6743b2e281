"""Queries with SQL beside them."""

import os

import pytest

from storelens.catalog import check
from storelens.llm import catalog

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_its_sql(spark, name):
    problem, n = check.compare(spark, check.connect(SF), SF, catalog.QUERIES[name], catalog.SQL[name])
    assert not problem and n
