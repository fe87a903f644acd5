import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
DATA = os.environ.get("QUERN_TEST_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return DATA


@pytest.fixture(scope="session")
def oracle(sf):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for p in Path(sf).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}{'/*.parquet' if p.is_dir() else ''}'")
    return lambda sql: con.sql(sql).df()


@pytest.fixture(scope="session")
def same():
    def compare(a, b):
        columns = sorted(a.columns)
        assert columns == sorted(b.columns)
        assert len(a) == len(b)
        text = lambda d: d[columns].astype(str).sort_values(columns).reset_index(drop=True)
        x, y = text(a), text(b)
        bad = (x != y).any(axis=1)
        assert not bad.any(), f"{bad.sum()} rows differ:\n{x[bad].head(3)}\n{y[bad].head(3)}"

    return compare
