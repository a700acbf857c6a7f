"""Every registered rail query against its SQL on the smallest tables, and rows-only runs of those without SQL."""

import os

import pytest
from oracle import compare, connect

from railtable.plans import registry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    sql = registry.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        compare(df, duck, sql)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(registry.oracle_sql()) <= set(registry.queries())
