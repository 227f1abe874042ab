"""Every query of the table operators against its SQL."""

import pytest

import checks.queries
from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import difference
from checks.oracle import ORACLE

REGISTERED = queries()
QUERIES = {name: REGISTERED[name] for name in checks.queries.QUERIES}


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE) <= set(oracle_sql()) <= set(REGISTERED)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), sf_dir, ORACLE[name]) is None


def test_entry(spark):
    df = entry(spark)
    assert df.columns[-1] == "o_year" and df.count() > 0
