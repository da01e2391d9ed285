import pytest

from corpusmill.plans.queries import oracle_sql, queries
from tests.oracle import same_rows


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, small, name):
    same_rows(spark, small, queries()[name], oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_query_runs(spark, small, name):
    assert queries()[name](spark, small).columns


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 12
    assert set(entry.oracle_sql()) <= set(entry.queries())
