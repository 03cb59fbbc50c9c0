"""Every registered llm query runs; those with SQL agree with it."""

import pytest

from fundlens.llm import registry

QUERIES, SQL = registry.queries(), registry.oracle_sql()
COLUMNS = {
    "p1_found": ["name_a", "name_b"], "p4_found": ["table_name", "row_id", "noise"], "p5_found": ["first_id", "copy_id"], "p7_found": ["kind", "raw_id", "canon_id"],
    "p9_found": ["doc_id", "item_id"], "p10_found": ["doc_id", "start_pos"],
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, duck, same, name):
    df = QUERIES[name](spark, sf)
    got = df.toPandas()
    if name in COLUMNS:
        assert list(df.columns) == COLUMNS[name] and not got.duplicated().any()
    if name in SQL:
        same(got, duck.execute(SQL[name]).df())
