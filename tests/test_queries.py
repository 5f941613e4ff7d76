"""Every registered query of the core equals its SQL on the smallest tables."""

import pytest

from tidelog.plans import registry


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_sql(name, same_as_sql):
    same_as_sql(registry.QUERIES[name], registry.ORACLE_SQL[name])


def test_entry_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(registry.QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
