"""Every query with SQL gives the same rows as DuckDB; the others give rows."""

import pytest

from loamworks import registry

from .oracle import differences

SF = "/root/testdata/sf0.001"
QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, SF)
    if name in SQL:
        assert not differences(df, SQL[name], SF)
    else:
        assert df.count() > 0


def test_entry_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
