"""Every query of the weather operators against its SQL."""

import pytest

from compare import same
from gridloom import queries

SQL = queries.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, data, name):
    same(queries.queries()[name], SQL[name], spark, data)


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - set(SQL)))
def test_query_without_sql_has_rows(spark, data, name):
    assert queries.queries()[name](spark, data).count() > 0


def test_entry(spark):
    import __spark_entry__

    out = __spark_entry__.entry(spark)
    assert out.count() > 0 and "si10" in out.columns
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
