"""Every query with SQL equals it; the others give rows."""

import pytest
from compare import duck_rows, spark_rows

from panelyard.plans import registry


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, sf, duck, name):
    got = registry.QUERIES[name](spark, sf)
    if name not in registry.ORACLES:
        assert got.count() > 0
        return
    want = duck.sql(registry.ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert spark_rows(got) == duck_rows(want)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
