import pytest

from rowkin.plans import hot_queries, record_queries, table_queries

BOTH = [(m, k) for m in (record_queries, hot_queries, table_queries) for k in m.QUERIES if k in m.SQL]


@pytest.mark.parametrize("module,name", BOTH, ids=[k for _, k in BOTH])
def test_same_rows_as_sql(module, name, same_as_sql):
    same_as_sql(module.QUERIES[name], module.SQL[name])


def test_entry(spark, sf):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
