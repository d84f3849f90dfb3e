"""The driver contract."""

import __spark_entry__ as e


def test_contract(spark):
    q, o = e.queries(), e.oracle_sql()
    assert len(q) > 80 and set(o) <= set(q)
    assert e.entry(spark).count() > 0
