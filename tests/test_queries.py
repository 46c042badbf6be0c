import pytest

from fluelake.plans import registry
from tests.compare import connection, difference


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_sql(spark, small, name):
    assert difference(registry.queries()[name](spark, small), connection(small), registry.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_query_without_sql_runs(spark, small, name):
    assert registry.queries()[name](spark, small).count() >= 0
