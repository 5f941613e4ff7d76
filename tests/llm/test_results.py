"""The registered corpus queries against their SQL."""

import pytest

from tidelog.llm import registry


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(name, same_as_sql):
    same_as_sql(registry.queries()[name], registry.oracle_sql()[name])


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.queries() if n.startswith("op")) == list(range(1, 14))
    assert "pipeline" in registry.queries()
