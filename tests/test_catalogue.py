from __future__ import annotations

import pytest
from check_oracles import compare

from __spark_entry__ import entry, oracle_sql, queries
from quayside.plans import catalogue

SMALL = "/root/testdata/sf0.001"


def test_every_query_has_its_sql():
    assert set(catalogue.QUERIES) == set(catalogue.ORACLES)
    assert set(catalogue.QUERIES) <= set(queries()) and set(catalogue.ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_query_equals_its_sql(spark, name):
    same, rows, _ = compare(spark, SMALL, name)
    assert same and rows


def test_entry(spark):
    assert entry(spark).count() > 0
