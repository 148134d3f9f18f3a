"""Every query against the equivalent SQL in another engine."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
import oracle

QUERIES = driver.queries()
ORACLE = driver.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return oracle.connect(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf, con):
    df = QUERIES[name](spark, sf)
    if name in ORACLE:
        assert oracle.compare(df, con, ORACLE[name]) is None
    else:
        assert df.count() > 0


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
