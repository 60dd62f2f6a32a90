import __spark_entry__ as e


def test_contract():
    q, o = e.queries(), e.oracle_sql()
    assert set(o) <= set(q) and {"p3_found", "p6_found"} <= set(q)


def test_entry(spark):
    assert e.entry(spark).count() > 0
