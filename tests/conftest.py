import os
import sys

os.environ.setdefault("TZ", "UTC")
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = os.path.dirname(os.path.dirname(os.path.abspath(__file__))) + os.pathsep + os.environ.get("PYTHONPATH", "")

import pytest
from pyspark.sql import SparkSession

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    builder = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.driver.memory", "4g")
    found = builder.config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    found.sparkContext.setLogLevel("ERROR")
    yield found
    found.stop()


@pytest.fixture(scope="session")
def duck():
    import glob

    import duckdb

    c = duckdb.connect()
    for t in glob.glob(f"{DATA}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(t)[:-8]} AS SELECT * FROM '{t}'")
    return c


def rows(df) -> tuple[list[str], list[str]]:
    names = sorted(df.columns)
    return names, sorted(repr(tuple(r[n] for n in names)) for r in df.collect())


def oracle_rows(duck, sql: str) -> tuple[list[str], list[str]]:
    found = duck.execute(sql)
    have = [x[0] for x in found.description]
    names = sorted(have)
    return names, sorted(repr(tuple(r[have.index(n)] for n in names)) for r in found.fetchall())
