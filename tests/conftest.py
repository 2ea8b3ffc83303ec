import os

import pytest
from pyspark.sql import SparkSession

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    os.environ.setdefault("PYTHONHASHSEED", "0")
    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{DATA}/{name}.parquet')")
    return con


def normal(value) -> str:
    if isinstance(value, float):
        return f"{value:.9g}"
    return str(value)


@pytest.fixture(scope="session")
def agree(spark, duck):
    """Compare a query's rows with its SQL's, in any order, columns by name."""

    def check(query, sql: str) -> int:
        df = query(spark, DATA)
        columns = sorted(df.columns)
        ours = sorted(tuple(normal(r[c]) for c in columns) for r in df.collect())
        result = duck.execute(sql)
        names = [d[0] for d in result.description]
        assert sorted(names) == columns
        theirs = sorted(tuple(normal(r[names.index(c)]) for c in columns) for r in result.fetchall())
        assert ours == theirs
        return len(ours)

    return check
