import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.codegen.wholeStage", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("test tables are not here")
    return SF


@pytest.fixture(scope="session")
def same_as_sql(spark, sf):
    """Runs a query and its SQL on the same tables and compares the rows."""
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in os.listdir(sf):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{sf}/{f}')")

    def check(query, sql):
        got, want = query(spark, sf).toPandas(), con.execute(sql).df()
        columns = sorted(got.columns)
        assert columns == sorted(want.columns)
        text = lambda d: sorted(tuple("" if v is None or v != v else str(v) for v in r) for r in d[columns].itertuples(index=False))
        assert text(got) == text(want)

    return check
