"""Every catalog query against its DuckDB oracle (sf0.001), and the entry."""

import pytest

import __spark_entry__ as E
from aerowx.plans import catalog
from conftest import SF_SMALL
from oracle_harness import compare

SQL = E.oracle_sql()


KEYS = sorted(catalog.QUERIES)


def test_every_query_has_an_oracle():
    qs = E.queries()
    assert set(SQL) <= set(qs)
    assert set(KEYS) <= set(SQL)


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() == 1333
    assert df.columns[0] == "WO_11H" and df.columns[-1] == "Class"


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, key):
    res = compare(spark, SF_SMALL, [key], verbose=False)[key]
    assert res[0] == "OK", res
