"""Every registered query outside the llm subpackage against its SQL."""

import pytest

from fundlens.plans import registry

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, duck, same, name):
    got = QUERIES[name](spark, sf).toPandas()
    if name in SQL:
        same(got, duck.execute(SQL[name]).df())
    else:
        assert len(got.columns) > 0


def test_sql_has_queries():
    assert set(SQL) <= set(QUERIES)
