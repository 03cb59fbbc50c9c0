"""Cells with line breaks, quotes and blanks through the round trips of files."""

import duckdb
import pytest

from fundlens.plans import round_trips as R

TITLES = ["plain", "x-\ny, z", 'q "quoted"\nline', "cr\rcr", "crlf\r\nend", "\n", "tail\n", '"', "\r", "a,b\n\nc", " blanks ", " y\x85", "back\\slash\\", 'back\\"q\n', "", None]


@pytest.mark.parametrize("name", ["csv_lenient_round_trip"])
def test_cells_of_any_text(spark, tmp_path, same, name):
    rows = [(i, t, t) for i, t in enumerate(TITLES)]
    spark.createDataFrame(rows, "project_id bigint, agency string, title string").coalesce(1).write.parquet(str(tmp_path / "capital.parquet"))
    c = duckdb.connect()
    c.execute(f"create view capital as select * from '{tmp_path}/capital.parquet/*.parquet'")
    same(R.QUERIES[name](spark, str(tmp_path)).toPandas(), c.execute(R.ORACLES[name]).df())
