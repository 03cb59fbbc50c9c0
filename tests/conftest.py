import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints"))).getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    from fundlens.session import ship_package

    ship_package(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("no test data")
    return SF


@pytest.fixture(scope="session")
def duck(sf):
    c = duckdb.connect()
    c.execute("set timezone = 'UTC'")
    for f in os.listdir(sf):
        c.execute(f"create view {f[:-8]} as select * from '{sf}/{f}'")
    return c


def _plain(v):
    if v is None or v != v:
        return None
    if hasattr(v, "isoformat"):
        return str(v)
    if hasattr(v, "item"):
        v = v.item()
    return round(v, 6) if isinstance(v, float) else v


def rows_of(pdf):
    import pandas as pd

    pdf = pdf[sorted(pdf.columns)]
    return sorted((tuple(None if (not isinstance(v, (list, tuple)) and pd.isna(v)) else _plain(v) for v in r) for r in pdf.itertuples(index=False, name=None)), key=repr)


@pytest.fixture(scope="session")
def same():
    def check(a, b):
        assert sorted(a.columns) == sorted(b.columns)
        assert rows_of(a) == rows_of(b)

    return check
