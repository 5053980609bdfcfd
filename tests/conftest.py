import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from passante.session import apply_runtime_conf
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="passante-test-ckpt-"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    apply_runtime_conf(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from passante.sources.testdata import Tables
    return Tables(spark, SF_SMALL)


@pytest.fixture(scope="session")
def star(tables):
    from passante.sources.fixtures import fixture_star
    return fixture_star(tables)


@pytest.fixture(scope="session")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in ("region nation customer supplier events conversations embeddings").split():
        con.sql(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="passante-test-")
