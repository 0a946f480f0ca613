"""Driver contract: entry() runs on sf0.001; every oracle has a query."""

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 5
    assert df.columns == ["feature", "chi2", "dof", "p_value"]


def test_registry_consistent():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 60
    for name in qs:
        assert name.isidentifier()
